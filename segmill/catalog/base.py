"""Registry, table access and inputs shared by Spark and SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from segmill.functions.codes import MISSING, MISSING_EMPLOYEE, MISSING_OR_NA
from segmill.operators.partitioning import spread_small

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


def text_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table for text work: the given files hold one row group each."""
    return spread_small(table(spark, sf_dir, name))


@dataclass(frozen=True)
class Derived:
    """An input both engines derive from the given tables with the same SQL.

    The tables carry no missing codes, carets or padded keys; the text puts
    them in by fixed rules.  Table names stand in braces.
    """

    text: str

    def df(self, spark: SparkSession, sf_dir: str, read=table) -> DataFrame:
        names = set(re.findall(r"{(\w+)}", self.text))
        return spark.sql(self.text, **{n: read(spark, sf_dir, n) for n in names})

    @property
    def sql(self) -> str:
        return "(" + re.sub(r"{(\w+)}", r"\1", self.text) + ")"


def sql_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


V7, V8, VE = sql_list(MISSING), sql_list(MISSING_OR_NA), sql_list(MISSING_EMPLOYEE)


def sql_caret(x: str) -> str:
    return f"upper(trim(replace({x}, '^', 's')))"


def sql_clean(x: str, sentinels: str = V7, result: str | None = None, null: bool = True) -> str:
    """SQL of ``clean_code``; ``result`` is the SQL of the transformed value."""
    missing = f"{x} IN ({sentinels})" + (f" OR {x} IS NULL" if null else "")
    return f"CASE WHEN {missing} THEN 'NA' ELSE {result or x} END"
