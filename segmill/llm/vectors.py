"""Columns of vectors as seen by the operators on embeddings.

A vector takes part if it is not null and holds no null or non-finite component.
A vector shorter than the longest one that takes part is extended by zeros, so
tables of mixed lengths have a defined result and no row is dropped for its length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def longest(df: DataFrame, vector: str) -> int:
    """The length of the longest vector; 0 for an empty table."""
    return df.agg(F.coalesce(F.max(F.size(vector)), F.lit(0))).first()[0]


def of_length(vector: Column, d: int, zero: Column) -> Column:
    """The vector extended by ``zero`` to length ``d``."""
    return F.concat(vector, F.array_repeat(zero, F.lit(d) - F.size(vector)))


def matrix(column: pa.Array | pa.ChunkedArray, d: int) -> np.ndarray:
    """A column of vectors of length ``d`` as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Rows as a column of lists."""
    offsets = np.arange(len(rows) + 1, dtype=np.int64) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(rows.reshape(-1), kind))
