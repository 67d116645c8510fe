"""Row filters.  All follow SQL's three-valued logic: an undecided row is dropped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def where_code(df: DataFrame, col: str, value: str) -> DataFrame:
    """Rows whose trimmed code equals ``value``."""
    return df.where(F.trim(col) == value)


def where_in(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.where(F.col(col).isin(*values))


def exclude_status(
    df: DataFrame, col: str, status: str = "DEL", *, trim: bool = True
) -> DataFrame:
    """Drop rows of a status, and rows whose status is NULL."""
    value = F.trim(col) if trim else F.col(col)
    return df.where(value != status)


def exclude_codes(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Drop rows of the listed codes, and rows whose code is NULL."""
    return df.where(~F.col(col).isin(*values))


def exclude_prefixes(df: DataFrame, col: str, prefixes: Sequence[str]) -> DataFrame:
    for prefix in prefixes:
        df = df.where(~F.col(col).like(f"{prefix}%"))
    return df


def split_by(df: DataFrame, col: str, values: Sequence) -> dict[object, DataFrame]:
    """One filtered frame per value."""
    return {value: df.where(F.col(col) == value) for value in values}
