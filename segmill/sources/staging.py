"""Staging: write a frame to shared storage and go on from there.

Every step ends with a manifest: schema, number of rows, and a fingerprint of the
plan, the input files and this library's code.  It is written after the rows, so
a step without one was cut off.  A run that is told to ``resume`` takes over the
steps whose manifest fits what it is about to write, and writes all others anew.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import cache
from importlib import resources

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter
from pyspark.sql.types import StructType

from segmill.sources.config import JobConfig

# Without it shuffle files stay until the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Staged rows are read a few times and take disk all the while.
COMPRESSION = "zstd"


def stage_root(spark: SparkSession, cfg: JobConfig) -> str:
    """The shared folder for staged frames.

    The configured folder, else the cluster's ``spark.checkpoint.dir``, else the
    context's checkpoint folder.  There is no other: on a cluster the executors
    would each write to a disk of their own.
    """
    root = cfg.stage_dir or spark.conf.get("spark.checkpoint.dir", None)
    root = root or spark.sparkContext.getCheckpointDir()
    if root is None:
        raise ValueError("set spark.checkpoint.dir (or stage_dir) to a shared folder")
    return root.rstrip("/")


def run_folder(spark: SparkSession, cfg: JobConfig) -> str:
    """The run's folder; it goes when the run is discarded, or else when the session ends.

    The folder of a run that may be resumed stays until it is discarded.
    """
    run, fs = _at(spark, f"{stage_root(spark, cfg)}/{cfg.run_id}")
    if not cfg.resume:
        fs.deleteOnExit(run)
    return f"{stage_root(spark, cfg)}/{cfg.run_id}"


def stage(df: DataFrame, cfg: JobConfig, name: str) -> DataFrame:
    """Write ``df`` under the run's folder and read it back.

    Cuts the lineage, survives lost executors, and gives a frame whose size can
    be measured cheaply, which decides later whether it may be broadcast.  The
    shuffle files of the step go once it is written.
    """
    spark = df.sparkSession
    path = f"{run_folder(spark, cfg)}/{name}"
    fingerprint = plan_fingerprint(df) if cfg.resume else None
    if not _taken_over(spark, cfg, name, df, fingerprint, path):
        _commit(df, cfg, name, fingerprint, lambda counted: _writer(counted).parquet(path))
    return spark.read.schema(df.schema).parquet(path)


def stage_parts(df: DataFrame, cfg: JobConfig, name: str, part: Column, parts: int) -> list[DataFrame]:
    """``stage``, and a frame for each of the ``parts`` numbers that ``part`` gives the rows.

    The rows are written once, and a part's frame reads no others.  Rows whose number
    is not in ``range(parts)`` are left out.
    """
    spark = df.sparkSession
    path = f"{run_folder(spark, cfg)}/{name}"
    numbered = df.withColumn("_part", part.cast("int")).where(F.col("_part").between(0, parts - 1))
    fingerprint = plan_fingerprint(numbered, f"{parts} parts") if cfg.resume else None
    if not _taken_over(spark, cfg, name, numbered, fingerprint, path):
        _commit(numbered, cfg, name, fingerprint, lambda counted: _writer(counted).partitionBy("_part").parquet(path))
    frames = []
    for k in range(parts):
        at, fs = _at(spark, f"{path}/_part={k}")
        # A part without rows is a folder without files.
        fs.mkdirs(at)
        frames.append(spark.read.schema(df.schema).parquet(f"{path}/_part={k}"))
    return frames


def read_staged(spark: SparkSession, cfg: JobConfig, names: Sequence[str], schema: StructType) -> DataFrame:
    """The rows of several staged steps of one schema, read as one."""
    return spark.read.schema(schema).parquet(*[f"{run_folder(spark, cfg)}/{name}" for name in names])


def drop_staged(spark: SparkSession, cfg: JobConfig, *names: str) -> None:
    """Delete steps (or ``<step>/_part=<k>``) that no frame will read again.

    A run that may be resumed keeps them: what follows is known by the files it was made from.
    """
    if cfg.resume:
        return
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {_table(cfg, name)}")
        at, fs = _at(spark, f"{run_folder(spark, cfg)}/{name}")
        fs.delete(at, True)


def stage_bucketed(
    df: DataFrame, cfg: JobConfig, name: str, keys: Sequence[str], buckets: int | None = None
) -> DataFrame:
    """``stage`` into buckets by ``keys``, each one file, sorted by them.

    Joins, aggregations and windows whose keys contain ``keys`` need no exchange
    of the staged frame, however often it is used; of two frames staged with the
    same keys and number of buckets neither does.  (With keys beyond ``keys``, for
    joins, under ``spark.sql.requireAllClusterKeysForCoPartition=false``, which
    ``build_session`` sets.)  A key's rows are one task's work, here and later:
    find out about heavy keys first (``windows.heavy_keys``).

    ``buckets``: the session's number of shuffle partitions by default.  The
    frame is a table of the session's catalog until the run is discarded.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path, table = f"{run_folder(spark, cfg)}/{name}", _table(cfg, name)
    layout = f"{buckets} buckets by {list(keys)}"
    fingerprint = plan_fingerprint(df, layout) if cfg.resume else None
    if _taken_over(spark, cfg, name, df, fingerprint, path):
        by, columns = ", ".join(f"`{k}`" for k in keys), _columns(df)
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
            f"INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        return spark.table(table)
    spark.sql(f"DROP TABLE IF EXISTS {table}")

    def write(counted: DataFrame) -> None:
        # Dealt as the buckets are, so that each bucket is one file of one task.
        dealt = _writer(counted.repartition(buckets, *keys)).format("parquet")
        dealt.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)

    _commit(df, cfg, name, fingerprint, write)
    return spark.table(table)


def staged_name(df: DataFrame, cfg: JobConfig, name: str) -> str:
    """A name of its own for a step that several parts of a run may take.

    In a run that resumes it follows from the plan, so that it is found again.
    """
    fingerprint = plan_fingerprint(df) if cfg.resume else None
    return f"{name}-{fingerprint[:32] if fingerprint else uuid.uuid4().hex}"


def discard_staged(spark: SparkSession, cfg: JobConfig) -> None:
    """Delete what a run has staged, once its results are written."""
    prefix = _table(cfg, "")
    for t in spark.catalog.listTables():
        if t.name.startswith(prefix):
            spark.sql(f"DROP TABLE IF EXISTS {t.name}")
    run, fs = _at(spark, f"{stage_root(spark, cfg)}/{cfg.run_id}")
    fs.delete(run, True)


@contextmanager
def staged_run(spark: SparkSession, cfg: JobConfig) -> Iterator[JobConfig]:
    """A run that leaves nothing staged: write its result before the block ends.

    A run that may be resumed keeps what it has staged if it fails.
    """
    try:
        yield cfg
    except BaseException:
        if not cfg.resume:
            discard_staged(spark, cfg)
        raise
    discard_staged(spark, cfg)


def read_manifest(spark: SparkSession, cfg: JobConfig, name: str) -> dict | None:
    """The manifest of a step, or None if the step has not ended."""
    path = _manifest(spark, cfg, name)
    at, fs = _at(spark, path)
    return json.loads(spark.read.text(path, wholetext=True).first()[0]) if fs.exists(at) else None


def plan_fingerprint(df: DataFrame, layout: str = "") -> str | None:
    """Identifies what a frame computes: plan, input files with size and time, and code.

    None if the frame has an input whose rows cannot be identified, such as rows
    handed over by the driver: then nothing is ever taken over.
    """
    spark, plan = df.sparkSession, df._jdf.queryExecution().analyzed()
    files: list[str] = []
    if not _input_files(plan, files):
        return None
    fields = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(fields)
    spark.conf.set(fields, str((1 << 31) - 1))
    try:
        text = plan.toString()
    finally:
        spark.conf.set(fields, before)
    parts = [_renumbered(text), *files, df.schema.json(), layout, code_version()]
    return hashlib.sha256("\x00".join(parts).encode()).hexdigest()


def _renumbered(plan: str) -> str:
    """A plan's text without what differs between sessions.

    Expression ids are numbered by first mention, so what is the same column stays
    so.  Lambda variables, and views that stand for a frame, get numbers of their own.
    """
    ids: dict[str, str] = {}
    plan = re.sub(r"#\d+", lambda m: ids.setdefault(m[0], f"#{len(ids)}"), plan)
    return re.sub(r"\b([a-z])_\d+(?=#)", r"\1", re.sub(r"_pyspark_[0-9a-f]{32}", "_pyspark", plan))


@cache
def code_version() -> str:
    """A digest of the library's own sources."""
    digest = hashlib.sha256()

    def visit(folder) -> None:
        for entry in sorted(folder.iterdir(), key=lambda e: e.name):
            if entry.is_dir():
                visit(entry)
            elif entry.name.endswith(".py"):
                digest.update(entry.name.encode() + b"\x00" + entry.read_bytes())

    visit(resources.files("segmill"))
    return digest.hexdigest()


def _input_files(plan, files: list[str]) -> bool:
    """Collect the plan's input files as their listings have them; False if there are other inputs."""
    leaves = plan.collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        kind = leaf.nodeName().split(" ")[0]
        if kind in ("Range", "OneRowRelation"):
            continue
        if not kind.startswith(("LogicalRelation", "Relation")) or not hasattr(leaf.relation(), "location"):
            return False
        listing = leaf.relation().location()
        # The listing is in memory; times of access are no part of a file's content.
        text = listing.allFiles().mkString("\n") if hasattr(listing, "allFiles") else None
        if text is None:
            return False
        files.append(re.sub(r"access_time=\d+", "", text))
    nested = plan.subqueriesAll()
    return all(_input_files(nested.apply(i), files) for i in range(nested.size()))


def _taken_over(
    spark: SparkSession, cfg: JobConfig, name: str, df: DataFrame, fingerprint: str | None, path: str
) -> bool:
    """Whether the run has this step already, whole and as it would be written now."""
    found = read_manifest(spark, cfg, name) if fingerprint else None
    if found is None or found["fingerprint"] != fingerprint or found["schema"] != df.schema.json():
        return False
    at, fs = _at(spark, path)
    return fs.exists(at) and spark.read.schema(df.schema).parquet(path).count() == found["rows"]


def _commit(df: DataFrame, cfg: JobConfig, name: str, fingerprint: str | None, write) -> None:
    """Write a step's rows, counted on the way, and then its manifest."""
    spark, path = df.sparkSession, _manifest(df.sparkSession, cfg, name)
    at, fs = _at(spark, path)
    fs.delete(at, False)
    rows = Observation()
    with without_shuffles(spark):
        write(df.observe(rows, F.count(F.lit(1)).alias("rows")))
    manifest = {
        "step": name, "rows": rows.get["rows"], "schema": df.schema.json(),
        "fingerprint": fingerprint, "code": code_version(),
    }
    part, _ = _at(spark, path + ".part")
    out = fs.create(part, True)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    fs.rename(part, at)


@contextmanager
def without_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries inside leave no shuffle files: nothing reads them once the rows are written."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def _writer(df: DataFrame) -> DataFrameWriter:
    return df.write.mode("overwrite").option("compression", COMPRESSION)


def _columns(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _table(cfg: JobConfig, name: str) -> str:
    return re.sub(r"\W", "_", f"stage_{cfg.run_id}_{name}").lower()


def _manifest(spark: SparkSession, cfg: JobConfig, name: str) -> str:
    return f"{stage_root(spark, cfg)}/{cfg.run_id}/manifests/{name}.json"


def _at(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
