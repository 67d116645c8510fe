"""Left lookups into dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest size that bounded_broadcast() hints, in bytes of rows in memory.
BROADCAST_LIMIT = 32 * 1024 * 1024

# Plan nodes that read files and work row by row.
_ROW_LOCAL = ("Project", "Filter", "Union", "LogicalRelation", "Relation", "View", "SubqueryAlias")


def file_bytes(df: DataFrame) -> int | None:
    """Bytes of the files a row-local plan reads; None for any other plan.

    A lower bound of its work, and no bound of its rows: files are compressed.
    """
    jdf = getattr(df, "_jdf", None)
    if jdf is None:
        return None
    total, nodes = 0, [jdf.queryExecution().optimizedPlan()]
    while nodes:
        node = nodes.pop()
        if not node.nodeName().startswith(_ROW_LOCAL):
            return None
        children = node.children()
        if children.isEmpty():
            total += int(node.stats().sizeInBytes())
        nodes.extend(children.apply(i) for i in range(children.size()))
    return total


def measured_bytes(df: DataFrame) -> int | None:
    """The size of the frame's rows in memory, by one pass over them.

    None if a column is nested, as its size is not that of a plain value.
    """
    fixed, texts = 8, []
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if kind in ("array", "map", "struct", "variant"):
            return None
        fixed += 8
        if kind in ("string", "binary", "varchar", "char"):
            texts.append(F.col(f"`{field.name}`"))
        elif kind == "decimal":
            fixed += 16
    # Texts take whole words.
    width = F.lit(fixed)
    for text in texts:
        width = width + F.coalesce(F.octet_length(text), F.lit(0)) + 7
    return df.select(width.cast("long").alias("w")).agg(F.sum("w")).first()[0] or 0


def bounded_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Hint a broadcast only for a frame whose rows were measured to be within ``limit`` bytes.

    Measured are frames that read files row by row (such as staged ones), and
    only if the files themselves are within the limit: one pass over little data,
    run when called.  All other frames go unhinted: the planner decides, and
    adaptive execution still broadcasts what turns out small.
    """
    return F.broadcast(df) if is_small(df, limit) else df


def is_small(df: DataFrame, limit: int) -> bool:
    """Whether the frame was measured to be within ``limit`` bytes (see ``bounded_broadcast``)."""
    files = file_bytes(df)
    if files is None or files > limit:
        return False
    size = measured_bytes(df)
    return size is not None and size <= limit


def left_lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Sequence[tuple[Column | str, Column | str]],
    take: Mapping[str, Column | str],
    matched: str | None = None,
) -> DataFrame:
    """Left outer equi join that adds ``take`` (new name: dimension column).

    ``on`` pairs a key of ``df`` with one of ``dim``.  Keys are compared as
    given; wrap one in ``trim`` for a one-sided trim.  ``matched`` names an
    extra boolean that tells matched rows.  Several matches multiply the row.
    """
    right = dim.select(
        *[_col(r).alias(f"_right_key_{i}") for i, (_, r) in enumerate(on)],
        *[_col(c).alias(name) for name, c in take.items()],
    )
    condition = reduce(
        Column.__and__, [_col(left) == F.col(f"_right_key_{i}") for i, (left, _) in enumerate(on)]
    )
    joined = df.join(right, condition, "left")
    if matched:
        joined = joined.withColumn(matched, F.col("_right_key_0").isNotNull())
    return joined.drop(*[f"_right_key_{i}" for i in range(len(on))])


def duplicate_keys(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys a dimension holds more than once, with their counts (each multiplies rows)."""
    return dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [left[k].eqNullSafe(right[k]) for k in keys])


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
