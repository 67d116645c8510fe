"""Registry and shared storage of the subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from segmill.sources.staging import without_shuffles

# name -> (Spark query, SQL text or None)
REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def check(sql: str | None = None):
    """Register a query under its function's name."""

    def register(query):
        REGISTRY[query.__name__] = (query, sql)
        return query

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spelled(df: DataFrame, name: str) -> str:
    """A column's name as the frame spells it: Spark does not tell cases apart, Arrow does."""
    return next((c for c in df.columns if c.lower() == name.lower()), name)


def unused(df: DataFrame, name: str) -> str:
    """The name, with as many underscores after it as no column of the frame has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from the session's settings."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return root.rstrip("/")


class Scratch:
    """Intermediate tables of one run, in the shared folder.

    ``put`` writes a frame and reads it back: the lineage is cut, a lost executor
    costs no recomputation, and the step's shuffle files go.  ``drop`` deletes a table that no later
    frame reads, ``keep_only`` all but those that the result still reads; these go
    when the session's file systems close.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        path, fs = self._at(self.path)
        fs.deleteOnExit(path)

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}"
        with without_shuffles(self.spark):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            path, fs = self._at(f"{self.path}/{name}")
            fs.delete(path, True)

    def keep_only(self, *names: str) -> None:
        """Delete every table of the run but these."""
        path, fs = self._at(self.path)
        for entry in fs.listStatus(path) if fs.exists(path) else []:
            if entry.getPath().getName() not in names:
                fs.delete(entry.getPath(), True)

    def _at(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop, hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration())
