"""Projections, filters, predicates, schemas, sets and windows."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as TY

from segmill.catalog.base import Derived, check, table
from segmill.operators import filters as flt
from segmill.operators.schema import conform, with_audit
from segmill.operators.sets import distinct_rows, group_max, union_bag, union_set
from segmill.operators.windows import partition_max
from segmill.sources.config import JobConfig

ORDERS = Derived("""
    SELECT o_orderkey,
           CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN o_orderstatus || '  '
                WHEN 2 THEN ' ' || o_orderstatus ELSE o_orderstatus END AS status
    FROM {orders}
""")


@check(
    "SELECT c_custkey AS member_key, c_name AS member_name, c_mktsegment AS segment_cd, "
    "c_mktsegment AS segment_cd_fltr FROM customer"
)
def p1_renamed_projection(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("member_key"), F.col("c_name").alias("member_name"),
        F.col("c_mktsegment").alias("segment_cd"), F.col("c_mktsegment").alias("segment_cd_fltr"),
    )


@check(
    "SELECT c_custkey, upper(trim(c_mktsegment)) AS segment, substring(c_name, 1, 3) AS prefix, "
    "c_name || '~UNK' AS tagged, coalesce(NULLIF(c_mktsegment, 'BUILDING'), 'NA') AS defaulted "
    "FROM customer"
)
def p2_derived_columns(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.upper(F.trim("c_mktsegment")).alias("segment"),
        F.substring("c_name", 1, 3).alias("prefix"),
        F.concat("c_name", F.lit("~UNK")).alias("tagged"),
        F.coalesce(F.nullif("c_mktsegment", F.lit("BUILDING")), F.lit("NA")).alias("defaulted"),
    )


@check(f"SELECT o_orderkey, status FROM {ORDERS.sql} WHERE trim(status) = 'P'")
def p5_trimmed_equality(spark, sf):
    return flt.where_code(ORDERS.df(spark, sf), "status", "P")


@check(
    "SELECT o_orderkey, o_orderpriority FROM orders "
    "WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')"
)
def p6_inclusion(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return flt.where_in(orders, "o_orderpriority", ["1-URGENT", "2-HIGH"])


@check(
    f"SELECT o_orderkey, status, 'trimmed' AS how FROM {ORDERS.sql} WHERE trim(status) <> 'F' "
    f"UNION ALL SELECT o_orderkey, status, 'raw' AS how FROM {ORDERS.sql} WHERE status <> 'F'"
)
def p7_status_exclusion(spark, sf):
    orders = ORDERS.df(spark, sf)
    return union_bag(
        flt.exclude_status(orders, "status", "F").withColumn("how", F.lit("trimmed")),
        flt.exclude_status(orders, "status", "F", trim=False).withColumn("how", F.lit("raw")),
    )


SUPPLIED = Derived("""
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE WHEN l_suppkey % 10 = 3 THEN NULL ELSE CAST(l_suppkey AS STRING) END AS source
    FROM {lineitem}
""")


@check(f"SELECT * FROM {SUPPLIED.sql} WHERE source NOT IN ('1', '2', '4', '8', '16', '32', '64')")
def p8_code_exclusion(spark, sf):
    return flt.exclude_codes(
        SUPPLIED.df(spark, sf), "source", ["1", "2", "4", "8", "16", "32", "64"]
    )


@check(
    "SELECT p_partkey, p_name FROM part WHERE p_name NOT LIKE 'red%' AND p_name NOT LIKE 'small%'"
)
def p9_prefix_exclusion(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_name")
    return flt.exclude_prefixes(parts, "p_name", ["red", "small"])


FLAGGED = Derived("""
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE l_returnflag END AS flag,
           CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_linestatus END AS state
    FROM {lineitem}
""")


@check(
    f"SELECT * FROM {FLAGGED.sql} WHERE (flag = 'A' AND NOT (state IS NULL)) "
    "OR (flag IS NULL AND state <> 'F') OR (flag IN ('N', 'R') AND state = 'O')"
)
def p10_nested_predicate(spark, sf):
    flag, state = F.col("flag"), F.col("state")
    return FLAGGED.df(spark, sf).where(
        ((flag == "A") & ~state.isNull())
        | (flag.isNull() & (state != "F"))
        | (flag.isin("N", "R") & (state == "O"))
    )


@check(
    "SELECT l_returnflag AS part_of, count(*) AS n FROM lineitem "
    "WHERE l_returnflag IN ('A', 'N', 'R') GROUP BY l_returnflag"
)
def p11_disjoint_subsets(spark, sf):
    parts = flt.split_by(table(spark, sf, "lineitem"), "l_returnflag", ["A", "N", "R"])
    counts = [
        df.agg(F.first("l_returnflag").alias("part_of"), F.count(F.lit(1)).alias("n"))
        for df in parts.values()
    ]
    return union_bag(*counts)


@check("SELECT n_nationkey, n_name, '42' AS load_log_key, TRUE AS stamped_once FROM nation")
def p12_audit_columns(spark, sf):
    audited = with_audit(table(spark, sf, "nation"), "42")
    once = F.col("load_dtm") == F.current_timestamp()
    return audited.select("n_nationkey", "n_name", "load_log_key", once.alias("stamped_once"))


LOOSE = Derived("""
    SELECT l_orderkey, CAST(l_linenumber AS STRING) AS line_no,
           CASE WHEN l_suppkey % 6 = 0 THEN 'n/a' ELSE CAST(l_suppkey AS STRING) END AS supplier,
           CAST(l_quantity AS STRING) AS quantity,
           CASE WHEN l_partkey % 8 = 0 THEN '2024-13-01'
                ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS shipped
    FROM {lineitem}
""")


@check(
    "SELECT l_orderkey, TRY_CAST(line_no AS INTEGER) AS line_no, "
    "TRY_CAST(supplier AS BIGINT) AS supplier, TRY_CAST(quantity AS DOUBLE) AS quantity, "
    f"CAST(TRY_CAST(shipped AS DATE) AS VARCHAR) AS shipped FROM {LOOSE.sql}"
)
def p13_conformed_schema(spark, sf):
    schema = TY.StructType([
        TY.StructField("LINE_NO", TY.IntegerType()),
        TY.StructField("SUPPLIER", TY.LongType()),
        TY.StructField("QUANTITY", TY.DoubleType()),
        TY.StructField("SHIPPED", TY.DateType()),
        TY.StructField("L_ORDERKEY", TY.LongType()),
    ])
    out = conform(LOOSE.df(spark, sf), schema)
    out = out.withColumn("SHIPPED", F.col("SHIPPED").cast("string"))
    return out.toDF(*[c.lower() for c in out.columns])


@check("SELECT DISTINCT l_returnflag, l_linestatus, CAST(l_shipdate AS VARCHAR) AS l_shipdate FROM lineitem")
def a1_full_row_distinct(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .select("l_returnflag", "l_linestatus", "l_shipdate").distinct()
        .withColumn("l_shipdate", F.col("l_shipdate").cast("string"))
    )


@check("SELECT * REPLACE (CAST(l_shipdate AS VARCHAR) AS l_shipdate) FROM (" + " UNION ".join(
    f"SELECT * FROM lineitem WHERE {w}" for w in ("l_returnflag = 'A'", "l_returnflag <> 'R'", "l_linenumber = 1")
) + ")")
def a1_distinct_by_fingerprint(spark, sf):
    """Whole rows of overlapping slices, each once: only repeated ones are shuffled whole."""
    items = table(spark, sf, "lineitem")
    slices = [items.where(w) for w in ("l_returnflag = 'A'", "l_returnflag <> 'R'", "l_linenumber = 1")]
    rows = distinct_rows(union_bag(*slices), JobConfig())
    return rows.withColumn("l_shipdate", F.col("l_shipdate").cast("string"))


@check(
    "SELECT l_partkey, l_suppkey, CAST(max(CAST(l_shipdate AS DATE)) AS VARCHAR) AS last_ship "
    "FROM lineitem GROUP BY l_partkey, l_suppkey"
)
def a2_group_max(spark, sf):
    items = table(spark, sf, "lineitem").withColumn("day", F.to_date("l_shipdate"))
    grouped = group_max(items, ["l_partkey", "l_suppkey"], "day", "last_ship")
    return grouped.withColumn("last_ship", F.col("last_ship").cast("string"))


WINDOWED = Derived("""
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE l_suppkey END AS supplier,
           CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_returnflag END AS funding
    FROM {lineitem}
""")


@check(
    "SELECT *, max(funding) OVER (PARTITION BY l_partkey, supplier) AS max_funding "
    f"FROM {WINDOWED.sql}"
)
def w1_partition_max(spark, sf):
    rows = WINDOWED.df(spark, sf)
    return partition_max(rows, ["l_partkey", "supplier"], "funding", "max_funding", JobConfig())


@check(
    "SELECT *, max(funding) OVER (PARTITION BY supplier) AS max_funding "
    f"FROM {WINDOWED.sql}"
)
def w1_partition_max_heavy_keys(spark, sf):
    """A third of the rows share the NULL key, so it takes the pre-aggregated way."""
    rows = WINDOWED.df(spark, sf)
    return partition_max(
        rows, ["supplier"], "funding", "max_funding", JobConfig(), min_rows=1500
    )


SLICES = {
    "A": "l_returnflag = 'A'", "cheap": "l_extendedprice < 30000", "late": "l_linestatus = 'O'",
}


@check(
    " UNION ALL ".join(
        f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE {w}"
        for w in SLICES.values()
    )
)
def u1_bag_union(spark, sf):
    items = table(spark, sf, "lineitem")
    ids = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return union_bag(*[items.where(w).select(*ids) for w in SLICES.values()])


@check(
    " UNION ".join(
        f"SELECT l_orderkey, l_suppkey FROM lineitem WHERE {w}" for w in SLICES.values()
    )
)
def u2_set_union(spark, sf):
    items = table(spark, sf, "lineitem")
    return union_set(*[items.where(w).select("l_orderkey", "l_suppkey") for w in SLICES.values()])
