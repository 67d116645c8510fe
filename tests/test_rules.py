"""Truth tables: all combinations of the interesting values, in Spark and as plain SQL."""

from itertools import product

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from segmill.catalog.base import V7, V8, sql_caret
from segmill.functions import rules
from segmill.functions.codes import MISSING, clean_code

CODES = (None, "", "~01", "UNK", "NA", "med", "a^b ")


def both(spark, columns, values, expression, sql):
    """``(row, Spark value, SQL value)`` for every combination of ``values``."""
    rows = list(product(*values))
    types = ", ".join(f"{c} {_type(v)}" for c, v in zip(columns, values, strict=True))
    got = spark.createDataFrame(rows, types).select(*columns, expression.alias("out")).collect()
    table = pa.table({c: [r[i] for r in rows] for i, c in enumerate(columns)})
    con = duckdb.connect()
    con.register("t", table)
    expected = {r[:-1]: r[-1] for r in con.execute(f"SELECT *, {sql} FROM t").fetchall()}
    assert len(got) == len(expected) == len(rows)
    for row in got:
        assert row[-1] == expected[tuple(row)[:-1]], row


def _type(values):
    kinds = {type(v) for v in values if v is not None}
    return {bool: "boolean", int: "int", str: "string"}[kinds.pop()]


def c(*names):
    return [F.col(n) for n in names]


def test_plan_group_cascade(spark):
    columns = ["in_plans", "plan", "in_products", "prod"]
    sql = (
        f"CASE WHEN in_plans THEN plan WHEN in_products AND (prod IN ({V8}) OR prod IS NULL) "
        f"THEN 'NA' WHEN in_products THEN {sql_caret('prod')} ELSE 'NA' END"
    )
    both(spark, columns, [(True, False), CODES, (True, False), CODES],
         rules.plan_group_id(*c(*columns)), sql)


def test_service_types(spark):
    columns = ["dental", "vision", "plan_type", "product_type"]
    values = [(None, 0, 1, 2), (None, 0, 1), CODES, CODES]
    raw = (
        "CASE WHEN dental <> 0 THEN 'DEN' WHEN vision <> 0 THEN 'VIS' "
        f"WHEN plan_type IN ({V7}) OR plan_type IS NULL THEN coalesce(product_type, 'NA') "
        "ELSE upper(plan_type) END"
    )
    both(spark, columns, values, rules.service_type(*c(*columns)),
         f"CASE WHEN {raw} IN ({V7}) THEN 'NA' ELSE {raw} END")
    original = (
        f"CASE WHEN product_type IN ({V7}) OR plan_type IS NULL "
        "THEN coalesce(product_type, 'NA') ELSE upper(plan_type) END"
    )
    both(spark, columns[2:], values[2:], rules.original_service_type(*c(*columns[2:])),
         f"CASE WHEN {original} IN ({V7}) THEN 'NA' ELSE {original} END")


def test_plan_sentinel_decides_differently_in_the_two_service_types(spark):
    row = spark.createDataFrame([(0, 0, "~02", "phr")], "d int, v int, plan string, prod string")
    out = row.select(
        rules.service_type(*c("d", "v", "plan", "prod")),
        rules.original_service_type(*c("plan", "prod")),
    ).first()
    assert tuple(out) == ("phr", "NA")


def test_plan_id(spark):
    columns = ["matched", "by_id", "by_number"]
    flags = (None, "Y")
    sql = (
        "CASE WHEN matched AND by_id IS NOT NULL AND by_number IS NOT NULL THEN 'id' "
        "WHEN matched AND by_id IS NOT NULL AND by_number IS NULL THEN 'id' "
        "WHEN matched AND by_id IS NULL AND by_number IS NOT NULL THEN 'number' "
        "WHEN matched AND by_id IS NULL AND by_number IS NULL THEN 'id' ELSE 'id' END"
    )
    both(spark, columns, [(True, False), flags, flags],
         rules.plan_id(*c(*columns), F.lit("id"), F.lit("number")), sql)


def test_override_flag(spark):
    columns = ["flag", "matched", "principal", "source", "admin", "product"]
    values = [
        (None, "Y", "N"), (True, False), (None, "06", "05"),
        (None, "886", "868", "867", "878", "823"), (None, "UNK", "LUM", "X"),
        (None, "PPOIHAPMCMHS", "PPONHSKMPVHA", "PPONSMKMPVHS", "HM1", "RX1", "PPFS", "PPXH",
         "OTHER"),
    ]
    excluded = ", ".join(f"'{p}'" for p in rules.OverrideRule().excluded_products)
    sql = (
        "CASE WHEN flag = 'Y' AND matched AND principal = '06' AND source IN ('886', '868') "
        "AND ((admin = 'UNK' AND NOT product IN ('PPOIHAPMCMHS')) "
        "OR (admin = 'LUM' AND product IN ('PPONHSKMPVHA', 'PPONSMKMPVHS')) OR admin <> 'LUM') "
        "THEN 'Y' WHEN flag = 'Y' AND matched AND principal = '06' "
        "AND source IN ('867', '878') AND NOT product LIKE 'HM%' AND NOT product LIKE 'RX%' "
        f"AND NOT product IN ({excluded}) THEN 'Y' ELSE 'N' END"
    )
    both(spark, columns, values, rules.override_flag(*c(*columns)), sql)
    assert len(rules.OverrideRule().excluded_products) == 32


@pytest.mark.parametrize("wanted", ["06", "02"])
def test_linked_org(spark, wanted):
    columns = ["matched", "kind", "org"]
    sql = (
        f"CASE WHEN matched AND trim(kind) = '{wanted}' THEN {sql_caret('org')} ELSE 'NA' END"
    )
    both(spark, columns, [(True, False), (None, "06", " 06 ", "02"), CODES],
         rules.linked_org(*c(*columns), wanted), sql)


def test_coverage_flags(spark):
    columns = ["code", "ord", "kind"]
    values = [(None, "P", "PA", "X", "UNK", "NA"), (None, 1, 2), (None, "MDCR", "MEDCR", "X")]
    both(spark, columns, values, rules.primary_coverage(*c("code", "ord")),
         f"CASE WHEN code IN ({V8}) OR code IS NULL OR NOT code IN ('P', 'PA') OR ord = 1 "
         "THEN 'N' ELSE 'Y' END")
    both(spark, columns, values, rules.medicare(*c("kind", "ord")),
         "CASE WHEN kind IN ('MDCR', 'MEDCR') AND ord = 1 THEN 'Y' ELSE 'N' END")


def test_funding_and_matched_defaults(spark):
    columns = ["matched", "value"]
    values = [(True, False), (None, "ab")]
    both(spark, columns, values, rules.funding_code(*c(*columns)),
         "CASE WHEN matched AND value IS NOT NULL THEN upper(value) ELSE 'I' END")
    both(spark, columns, values, rules.when_matched(*c(*columns)),
         "CASE WHEN matched THEN value ELSE 'N' END")


def test_subgroup_id_is_null_without_org(spark):
    columns = ["related", "org"]
    both(spark, columns, [CODES, (None, "g")], rules.subgroup_id(*c(*columns)),
         f"CASE WHEN related IN ({V8}) OR related IS NULL THEN org || '~UNK' ELSE related END")


def test_keeping_clean_code_is_idempotent(spark):
    rows = [(x,) for x in (*MISSING, None, " ~01", "unk", "NA", "^x")]
    df = spark.createDataFrame(rows, "x string").select(clean_code(F.col("x")).alias("x"))
    assert df.collect() == df.select(clean_code(F.col("x")).alias("x")).collect()
    # Near misses are no sentinels.
    assert [r.x for r in df.collect()][-4:] == [" ~01", "unk", "NA", "^x"]
