import os
import random

import pytest

from segmill.functions import text as T
from segmill.plans import mining
from segmill.sources.config import JobConfig
from segmill.sources.scripts import (
    read_lines,
    read_packed,
    read_scripts,
    render_statements,
    split_lines,
    write_files,
    write_packed,
    write_statements,
)
from segmill.sources.staging import discard_staged, stage, stage_root, staged_run
from segmill.sources.tables import as_view, read_table, sql_from_file, sql_template

CFG = JobConfig(env="dev", release="r2", layer="gold", database="${env}_segmill")


def test_placeholders_and_file_list():
    cfg = JobConfig(env="e", release="r", layer="l", environment="/jobs",
                    query_map={"first": "a.sql", "second": "b.sql,c.sql"})
    assert cfg.fill("${env}/${release}/${layer}/${other}") == "e/r/l/${other}"
    assert cfg.sql_files == ["b.sql", "c.sql"]
    assert cfg.sql_path(1) == "/jobs/c.sql"
    assert JobConfig().sql_files == []


def test_table_of_the_configured_database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS dev_segmill")
    spark.range(3).write.mode("overwrite").saveAsTable("dev_segmill.three")
    assert read_table(spark, CFG, "THREE").count() == 3
    assert sql_template(spark, "SELECT * FROM ${env}_segmill.three WHERE id >= :low", CFG,
                        {"low": 1}).count() == 2


def test_sql_file_and_view(spark, tmp_path):
    (tmp_path / "q.sql").write_text("SELECT n + 1 AS n,\n '${layer}' AS layer\nFROM ones")
    as_view(spark.sql("SELECT 1 AS n"), "ones")
    cfg = JobConfig(layer="gold", environment=str(tmp_path), query_map={"x": "q.sql"})
    assert sql_from_file(spark, cfg, 0).collect() == [(2, "gold")]


def test_stage_keeps_rows_and_uses_the_shared_folder(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "cast(null as string) as s")
    staged = stage(df, JobConfig(run_id="run"), "numbers")
    assert staged.dtypes == df.dtypes and staged.exceptAll(df).isEmpty()
    shared = spark.conf.get("spark.checkpoint.dir")
    assert all(f.startswith(f"file://{shared}/run/numbers/") for f in staged.inputFiles())
    discard_staged(spark, JobConfig(run_id="run"))
    assert not os.path.exists(f"{shared}/run") and os.path.exists(shared)
    assert stage_root(spark, JobConfig(stage_dir="/shared/x/")) == "/shared/x"


def test_a_run_leaves_nothing_staged(spark):
    cfg = JobConfig()
    with staged_run(spark, cfg):
        assert stage(spark.range(10).toDF("n"), cfg, "numbers").count() == 10
    assert not os.path.exists(f"{spark.conf.get('spark.checkpoint.dir')}/{cfg.run_id}")


class _Session:
    """A session that knows its checkpoint folder from the conf, the context, or not at all."""

    def __init__(self, conf=None, context=None):
        self.conf = {"spark.checkpoint.dir": conf} if conf else {}
        self.sparkContext = self
        self.getCheckpointDir = lambda: context


def test_a_shared_folder_is_demanded():
    with pytest.raises(ValueError):
        stage_root(_Session(), JobConfig())
    assert stage_root(_Session(conf="hdfs:/c"), JobConfig()) == "hdfs:/c"
    assert stage_root(_Session(context="hdfs:/d/"), JobConfig()) == "hdfs:/d"


@pytest.fixture
def scripts(tmp_path):
    folder = tmp_path / "scripts"
    folder.mkdir()
    (folder / "a.txt").write_bytes(b'x.select(a,\r\n b)\r\nrest')
    (folder / "b.txt").write_bytes(b'y.where(c);\n')
    return str(folder)


def test_read_scripts(spark, scripts):
    files = read_scripts(spark, scripts).orderBy("script_id").collect()
    assert [f.text for f in files] == ["x.select(a,\n b)\nrest", "y.where(c);\n"]
    lines = read_scripts(spark, scripts, by="line").orderBy("script_id", "line_no").collect()
    assert [(r.line_no, r.text) for r in lines] == [
        (0, "x.select(a,"), (1, " b)"), (2, "rest"), (0, "y.where(c);"),
    ]


def test_large_files_are_an_error_not_a_cut(spark, scripts):
    with pytest.raises(ValueError, match="a.txt"):
        read_scripts(spark, scripts, max_bytes=20)
    assert sorted(r.text for r in read_lines(spark, scripts).collect()) == [
        " b)", "rest", "x.select(a,", "y.where(c);",
    ]


def test_render_and_write(spark, scripts, tmp_path):
    arrays = mining.extract_arrays(
        read_scripts(spark, scripts), "script_id", "text", T.normalised_blocks
    )
    between = render_statements(arrays, "script_id", "statements").orderBy("script_id")
    assert [r.text for r in between.collect()] == ["x(a, b)", "ywhere(c);"]
    out = str(tmp_path / "out")
    write_statements(arrays, out, "script_id", "statements", ";\n\n", terminal=True)
    assert len([d for d in os.listdir(out) if d.startswith("script_id=")]) == 2
    written = sorted(r[0] for r in spark.read.text(f"{out}/*").collect() if r[0])
    assert written == ["x(a, b);", "ywhere(c);;"]


def test_scripts_are_written_by_many_tasks_one_file_each(spark, tmp_path):
    """Rows that come in one partition, as many short texts do."""
    arrays = spark.range(60).selectExpr("id AS k", "array(concat('s', id), 't') AS a").coalesce(1)
    out = tmp_path / "out"
    write_statements(arrays, str(out), "k", "a", ";\n", terminal=True)
    files = [list(d.glob("part-*")) for d in out.glob("k=*")]
    assert len(files) == 60 and all(len(f) == 1 for f in files)
    assert len({f.name[:10] for [f] in files}) == 4
    assert sorted(r.text for r in read_lines(spark, f"{out}/k=7").collect() if r.text) == ["s7;", "t;"]


def test_scripts_come_without_files_of_checksums(spark, tmp_path):
    """Each would cost a process on a local disk."""
    out = tmp_path / "out"
    write_files(spark.range(20).selectExpr("id AS k", "concat('x', id) AS t"), str(out), "k")
    assert len([f for f in out.rglob("*") if f.is_file() and f.parent != out]) == 20
    assert sorted(r.text for r in read_lines(spark, f"{out}/*").collect()) == sorted(f"x{k}" for k in range(20))
    # Only files of one script each are written so.
    spark.range(3).write.parquet(str(tmp_path / "rows"))
    assert list((tmp_path / "rows").glob(".*.crc"))


def test_many_folders_are_listed_by_a_few_tasks(spark, tmp_path):
    write_files(spark.range(50).selectExpr("id AS k", "'x' AS t"), str(tmp_path / "out"), "k")
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(setting)
    tracker, group = spark.sparkContext.statusTracker(), "listing-of-folders"
    spark.sparkContext.setJobGroup(group, group)
    try:
        lines = read_lines(spark, f"{tmp_path}/out/*")
        stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
        tasks = [tracker.getStageInfo(s).numTasks for s in stages]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tasks) == 1 and tasks[0] <= 16 and lines.count() == 50
    assert spark.conf.get(setting) == before


@pytest.mark.parametrize("split", ["7", "64", "1m"])
def test_lines_of_files_cut_into_many_splits(spark, tmp_path, split):
    """Line ends of every kind, lines that cross splits, empty lines; numbers as if read whole."""
    rng = random.Random(int(split.strip("m")))
    folder = tmp_path / "files"
    folder.mkdir()
    for k in range(4):
        line = lambda: "".join(rng.choice("ab é;λ") for _ in range(rng.randrange(0, 40)))
        text = "".join(line() + rng.choice(["\n", "\r\n"]) for _ in range(40)) + ("open end" if k % 2 else "")
        (folder / f"{k}.txt").write_bytes(text.encode())
    (folder / "empty.txt").write_bytes(b"")
    settings = {"spark.sql.files.maxPartitionBytes": split, "spark.sql.files.openCostInBytes": "1"}
    whole = split_lines(read_scripts(spark, str(folder)).where("text <> ''"), "script_id", "text")
    want = sorted(map(tuple, whole.collect()))
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        tasks = spark.read.text(str(folder)).rdd.getNumPartitions()
        got = sorted(map(tuple, read_scripts(spark, str(folder), by="line").collect()))
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert got == want and (tasks > 100) == (split == "7")


def test_packed_texts(spark, tmp_path):
    rng = random.Random(5)
    text = lambda: "".join(rng.choice("ab\n\r é;λ\u2028") for _ in range(rng.randrange(0, 60)))
    rows = [(k % 50, text()) for k in range(400)] + [(None, "of none"), (7, None), (60, "x" * 5_000)]
    df = spark.createDataFrame(rows, "k int, t string").repartition(6)
    path = str(tmp_path / "packed")
    write_packed(df, path, "k", "t", CFG, pack_bytes=4_000)
    size = sum(len((t or "").encode()) + 1 for _, t in rows)
    files = [f for _, _, names in os.walk(f"{path}/texts") for f in names if f.startswith("part")]
    assert 1 < len(files) <= -(-size // 4_000)
    by_value = lambda rows: sorted((-1 if k is None else k, t or "") for k, t in rows)
    assert by_value(map(tuple, read_packed(spark, path).collect())) == by_value(rows)
    wanted = spark.createDataFrame([(7,), (8,), (8,), (99,), (None,)], "id int")
    some = read_packed(spark, path, wanted).collect()
    assert by_value(map(tuple, some)) == by_value(r for r in rows if r[0] in (7, 8))
    with pytest.raises(Exception, match="already exists"):
        write_packed(df, path, "k", "t", CFG)
    write_packed(df.where("false"), str(tmp_path / "none"), "k", "t", CFG)
    assert spark.read.parquet(str(tmp_path / "none/index")).count() == 0


def test_a_staged_step_leaves_no_shuffle_files(spark):
    import time

    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f for f in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = files(), spark.conf.get(setting)
    staged = stage(spark.range(1000).repartition(3, "id"), JobConfig(), "dealt")
    for _ in range(50):
        left = files() - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and staged.count() == 1000 and spark.conf.get(setting) == was
