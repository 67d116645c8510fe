"""Spreading small inputs over the cores."""

from __future__ import annotations

from pyspark.sql import DataFrame

from segmill.operators.joins import file_bytes

SPREAD_LIMIT = 1 << 30
BYTES_PER_TASK = 1 << 20


def spread_small(df: DataFrame, limit: int = SPREAD_LIMIT) -> DataFrame:
    """Repartition a small frame for work that is heavy per byte, such as text scans.

    A small file is often a single row group, hence a single task.  Large
    inputs come in many splits already and are left where they are.
    """
    size = file_bytes(df)
    if size is None or size > limit:
        return df
    tasks = min(df.sparkSession.sparkContext.defaultParallelism, size // BYTES_PER_TASK)
    return df.repartition(tasks) if tasks > 1 else df
