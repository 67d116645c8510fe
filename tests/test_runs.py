"""Runs that are cut off and taken up again, and frames staged in buckets."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from segmill.catalog.segments import segmentation_inputs
from segmill.operators.joins import left_lookup
from segmill.operators.windows import window_max
from segmill.plans import segmentation
from segmill.plans.segmentation import segment_members
from segmill.sources import staging
from segmill.sources.config import JobConfig

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def times(folder):
    paths = (os.path.join(d, f) for d, _, names in os.walk(folder) for f in names)
    return {os.path.relpath(p, folder): os.stat(p).st_mtime_ns for p in paths}


def steps(spark, cfg):
    """Two steps over given files."""
    items = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select("l_orderkey", "l_tax")
    first = staging.stage(items.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n")), cfg, "first")
    return staging.stage(first.where("n > 2"), cfg, "second")


def test_a_killed_run_goes_on_after_its_last_whole_step(spark, tmp_path):
    cfg = JobConfig(run_id="night", resume=True, stage_dir=str(tmp_path))
    killed = f"""
import os, sys
sys.path[:0] = [{ROOT!r}, {os.path.join(ROOT, "tests")!r}]
from segmill.session import build_session
from segmill.sources import staging
from segmill.sources.config import JobConfig
spark = build_session("killed", "local[2]", spark__ui__enabled="false", spark__sql__shuffle__partitions="2")
dumps, calls = staging.json.dumps, []
def last_words(x):
    calls.append(x)
    if len(calls) == 2:
        os._exit(9)  # the second step's rows are there, its manifest is not
    return dumps(x)
staging.json = type(sys)("json")
staging.json.dumps, staging.json.loads = last_words, __import__("json").loads
import test_runs
test_runs.steps(spark, JobConfig(run_id="night", resume=True, stage_dir={str(tmp_path)!r}))
"""
    done = subprocess.run([sys.executable, "-c", killed], capture_output=True, text=True, cwd=tmp_path)
    assert done.returncode == 9, done.stderr
    assert os.path.exists(tmp_path / "night/second/_SUCCESS")
    items = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    assert staging.read_manifest(spark, cfg, "first")["rows"] == items.select("l_orderkey").distinct().count()
    assert staging.read_manifest(spark, cfg, "second") is None
    before = times(tmp_path / "night/first"), times(tmp_path / "night/second")
    out = steps(spark, cfg)
    plain = steps(spark, JobConfig())
    assert out.exceptAll(plain).isEmpty() and plain.exceptAll(out).isEmpty() and out.count() > 0
    assert times(tmp_path / "night/first") == before[0]
    assert not times(tmp_path / "night/second").items() & before[1].items()
    # Whole now: a third time nothing is written.
    before = times(tmp_path / "night")
    steps(spark, cfg)
    assert times(tmp_path / "night") == before
    staging.discard_staged(spark, cfg)
    assert not os.path.exists(tmp_path / "night")


def test_only_what_would_be_written_again_is_taken_over(spark, tmp_path, monkeypatch):
    cfg = JobConfig(run_id="r", resume=True, stage_dir=str(tmp_path))
    spark.range(5).write.parquet(str(tmp_path / "in"))
    rows = lambda: spark.read.parquet(str(tmp_path / "in"))
    step = lambda df: (staging.stage(df, cfg, "s").count(), times(tmp_path / "r/s"))
    first = step(rows())
    assert step(rows()) == first
    # Another plan, other inputs, other code, lost files: written anew.
    other = step(rows().where("id > 1"))
    assert other[0] == 3 and other[1] != first[1]
    second = step(rows())
    spark.range(2).write.mode("append").parquet(str(tmp_path / "in"))
    third = step(rows())
    assert third[0] == 7 and third[1] != second[1]
    monkeypatch.setattr(staging, "code_version", lambda: "next")
    fourth = step(rows())
    assert fourth[0] == 7 and fourth[1] != third[1]
    part = next(f for f in os.listdir(tmp_path / "r/s") if f.startswith("part"))
    os.remove(tmp_path / "r/s" / part)
    assert step(rows())[0] == 7
    # A plan that only differs in the side a column is from is another plan.
    left, right = rows().toDF("x").alias("l"), rows().toDF("x").alias("r")
    both = left.join(right, F.col("l.x") < F.col("r.x"))
    prints = {staging.plan_fingerprint(both.select(c)) for c in ("l.x", "r.x", "l.x")}
    assert len(prints) == 2 and None not in prints
    # Rows of the driver's cannot be told from others, so they are never taken over.
    assert staging.plan_fingerprint(spark.createDataFrame([(1,)], "a int")) is None
    one = step(spark.createDataFrame([(1,)], "a int"))
    assert step(spark.createDataFrame([(2,)], "a int")) != one


def test_a_failed_run_keeps_its_steps_only_if_it_may_be_resumed(spark, tmp_path):
    for resume in (True, False):
        cfg = JobConfig(run_id=f"r{resume}", resume=resume, stage_dir=str(tmp_path))
        with pytest.raises(ZeroDivisionError), staging.staged_run(spark, cfg):
            staging.stage_bucketed(spark.range(9).toDF("n"), cfg, "n", ["n"], 2)
            1 / 0  # noqa: B018
        assert os.path.exists(tmp_path / f"r{resume}") == resume
        assert any(t.name.startswith("stage_r") for t in spark.catalog.listTables()) == resume
        staging.discard_staged(spark, cfg)


def test_segmentation_cut_off_between_steps(spark, sf_dir, tmp_path, monkeypatch):
    cfg = JobConfig(run_id="seg", resume=True, stage_dir=str(tmp_path))
    whole = segment_members(segmentation_inputs(spark, sf_dir), JobConfig(), bucketed=True)

    def failing(df, cfg, name):
        if name == "products":
            raise ConnectionError
        return staging.stage(df, cfg, name)

    with monkeypatch.context() as m:
        m.setattr(segmentation, "stage", failing)
        with pytest.raises(ConnectionError):
            segment_members(segmentation_inputs(spark, sf_dir), cfg, bucketed=True)
    before = times(tmp_path / "seg")
    assert {"members", "coordination", "links"} <= {f.split("/")[0] for f in before}
    # Another session does not know the bucketed table yet.
    spark.sql("DROP TABLE stage_seg_members")
    out = segment_members(segmentation_inputs(spark, sf_dir), cfg, bucketed=True)
    assert before.items() <= times(tmp_path / "seg").items()
    assert out.exceptAll(whole).isEmpty() and whole.exceptAll(out).isEmpty() and out.count() > 0
    staging.discard_staged(spark, cfg)


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("\n") if "Exchange" in line]


def test_bucketed_frames_meet_without_an_exchange(spark):
    cfg = JobConfig()
    rows = spark.range(3000).selectExpr("id % 70 AS member", "id % 4 AS source", "id % 9 AS org", "id AS v").withColumn(
        "month", F.expr("date_add(date'2024-01-31', cast(v % 3 as int))"))
    members = staging.stage_bucketed(rows, cfg, "members", ["member", "month"], 4)
    dim = staging.stage_bucketed(
        rows.groupBy("member", "month").agg(F.max("org").alias("top")), cfg, "dim", ["member", "month"], 4)
    departments = staging.stage_bucketed(
        rows.select("member", "month", "source", "org").distinct(), cfg, "departments", ["member", "month"], 4)
    limit = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(limit, "-1")
    try:
        # W1, J8 and J6 on the same frame: their keys contain the buckets'.
        out = left_lookup(members, dim, [("member", "member"), ("month", "month")], {"top": "top"})
        out = left_lookup(out, departments, [("member", "member"), ("source", "source"), ("org", "org"), ("month", "month")],
                          {"found": "org"})
        out = window_max(out, ["member", "month", "source"], "v", "most")
        assert exchanges(out) == []
        # An unstaged side is dealt to the buckets, the staged frame stays.
        plain = rows.groupBy("member", "month").agg(F.min("org").alias("low"))
        mixed = left_lookup(members, plain, [("member", "member"), ("month", "month")], {"low": "low"})
        assert len(exchanges(mixed)) == 1
        assert out.count() == 3000 and out.where("found IS NULL OR most IS NULL").isEmpty()
        expected = rows.groupBy("member", "month", "source").agg(F.max("v").alias("most"))
        got = out.select("member", "month", "source", "most").distinct()
        assert got.exceptAll(expected.select(*got.columns)).isEmpty()
    finally:
        spark.conf.unset(limit)
    files = [f for f in os.listdir(f"{spark.conf.get('spark.checkpoint.dir')}/{cfg.run_id}/members") if f.startswith("part")]
    assert len(files) == 4
    staging.discard_staged(spark, cfg)
    assert not [t for t in spark.catalog.listTables() if cfg.run_id in t.name]
