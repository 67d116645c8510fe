"""Compare a Spark result with DuckDB's as bags of rows."""

from __future__ import annotations

import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def spark_bag(df) -> tuple[list[str], Counter]:
    order = sorted(range(len(df.columns)), key=lambda i: df.columns[i].lower())
    names = [df.columns[i] for i in order]
    return names, Counter(tuple(_plain(row[i]) for i in order) for row in df.collect())


def duckdb_bag(con, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i].lower())
    names = [columns[i] for i in order]
    return names, Counter(tuple(_plain(row[i]) for i in order) for row in cursor.fetchall())


def _plain(value):
    return round(value, 9) if isinstance(value, float) else value


def difference(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    left_names, left = spark_bag(df)
    right_names, right = duckdb_bag(con, sql)
    if left_names != right_names:
        return f"columns {left_names} / {right_names}"
    if left == right:
        return None
    return (
        f"rows {left.total()} / {right.total()}; only Spark {list((left - right).items())[:3]}; "
        f"only SQL {list((right - left).items())[:3]}"
    )
