"""Joins and the month expansion."""

from __future__ import annotations

from pyspark.sql import functions as F

from segmill.catalog.base import Derived, check, table
from segmill.functions.rules import when_matched
from segmill.operators.filters import where_code, where_in
from segmill.operators.joins import bounded_broadcast, duplicate_keys, left_lookup
from segmill.operators.months import month_ends, period_lookup, value_range

NATIONS = Derived("""
    SELECT n_nationkey, ' ' || n_name || ' ' AS name, n_regionkey,
           CASE WHEN n_nationkey % 3 = 0 THEN 'WAC ' ELSE 'OTH' END AS kind,
           CASE n_nationkey % 4 WHEN 0 THEN 'GRP' WHEN 1 THEN 'CLNT' WHEN 2 THEN 'ASSN'
                ELSE 'XXX' END AS related
    FROM {nation}
""")


@check(
    "SELECT trim(name) AS name, trim(related) AS related, r_name "
    f"FROM {NATIONS.sql} JOIN region ON r_regionkey = n_regionkey "
    "WHERE trim(kind) = 'WAC' AND related IN ('GRP', 'CLNT', 'ASSN')"
)
def j1_filtered_inner(spark, sf):
    kept = where_in(
        where_code(NATIONS.df(spark, sf), "kind", "WAC"), "related", ["GRP", "CLNT", "ASSN"]
    )
    regions = bounded_broadcast(table(spark, sf, "region"))
    return kept.join(regions, F.col("r_regionkey") == F.col("n_regionkey")).select(
        F.trim("name").alias("name"), F.trim("related").alias("related"), "r_name"
    )


KNOWN = Derived("""
    SELECT CASE WHEN c_acctbal > 2000 THEN c_custkey ELSE c_custkey + 100000000 END AS known_key,
           CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS level
    FROM {customer}
""")


@check(
    "SELECT o_orderkey, CASE WHEN known_key IS NOT NULL THEN level ELSE 'N' END AS level "
    f"FROM orders LEFT JOIN {KNOWN.sql} ON o_custkey = known_key"
)
def j3_left_with_default(spark, sf):
    rows = left_lookup(
        table(spark, sf, "orders"), bounded_broadcast(KNOWN.df(spark, sf)),
        on=[("o_custkey", "known_key")], take={"level": "level"}, matched="known",
    )
    return rows.select("o_orderkey", when_matched(F.col("known"), F.col("level")).alias("level"))


PADDED_ITEMS = Derived("""
    SELECT l_linenumber,
           CASE WHEN l_partkey % 2 = 0 THEN CAST(l_orderkey AS STRING) || ' '
                ELSE CAST(l_orderkey AS STRING) END AS order_key,
           CASE l_linenumber % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE 'P ' END AS status,
           l_quantity
    FROM {lineitem}
""")
PADDED_ORDERS = Derived("""
    SELECT ' ' || CAST(o_orderkey AS STRING) AS order_key, o_orderstatus || '  ' AS status,
           o_orderpriority AS priority
    FROM {orders}
""")


@check(
    "SELECT i.order_key, i.l_linenumber, i.status, o.priority "
    f"FROM {PADDED_ITEMS.sql} i LEFT JOIN {PADDED_ORDERS.sql} o "
    "ON trim(i.order_key) = trim(o.order_key) AND i.status = trim(o.status)"
)
def j4_one_sided_trim(spark, sf):
    return left_lookup(
        PADDED_ITEMS.df(spark, sf), PADDED_ORDERS.df(spark, sf),
        on=[(F.trim("order_key"), F.trim("order_key")), ("status", F.trim("status"))],
        take={"priority": "priority"},
    ).select("order_key", "l_linenumber", "status", "priority")


@check(
    "SELECT l_orderkey, l_linenumber, p_brand, s_name, o_orderstatus FROM lineitem "
    "LEFT JOIN part ON l_partkey = p_partkey AND l_linenumber = p_size "
    "LEFT JOIN supplier ON l_suppkey = s_suppkey "
    "LEFT JOIN orders ON l_orderkey = o_orderkey"
)
def j5_left_chain(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )
    rows = left_lookup(
        rows, table(spark, sf, "part"),
        on=[("l_partkey", "p_partkey"), ("l_linenumber", "p_size")], take={"p_brand": "p_brand"},
    )
    rows = left_lookup(
        rows, table(spark, sf, "supplier"),
        on=[("l_suppkey", "s_suppkey")], take={"s_name": "s_name"},
    )
    rows = left_lookup(
        rows, table(spark, sf, "orders"),
        on=[("l_orderkey", "o_orderkey")], take={"o_orderstatus": "o_orderstatus"},
    )
    return rows.drop("l_partkey", "l_suppkey")


MONTHLY_ITEMS = Derived("""
    SELECT CAST(l_orderkey AS STRING) AS member, CAST(l_suppkey % 3 AS STRING) AS source,
           CAST(l_suppkey AS STRING) AS org, last_day(CAST(l_shipdate AS DATE)) AS month_end,
           l_linenumber
    FROM {lineitem}
""")
MONTHLY_DEPARTMENTS = Derived("""
    SELECT CAST(l_orderkey AS STRING) || CASE WHEN l_linestatus = 'O' THEN '' ELSE '+' END AS member,
           CAST(l_suppkey % 3 AS STRING) AS source,
           CAST(l_suppkey AS STRING) AS org, last_day(CAST(l_shipdate AS DATE)) AS month_end,
           max(l_returnflag) AS department
    FROM {lineitem} GROUP BY 1, 2, 3, 4
""")


@check(
    "SELECT i.member, i.org, CAST(i.month_end AS VARCHAR) AS month_end, i.l_linenumber, "
    f"d.department FROM {MONTHLY_ITEMS.sql} i LEFT JOIN {MONTHLY_DEPARTMENTS.sql} d "
    "ON i.member = d.member AND i.source = d.source AND i.org = d.org "
    "AND i.month_end = d.month_end"
)
def j6_four_key_left(spark, sf):
    keys = ["member", "source", "org", "month_end"]
    rows = left_lookup(
        MONTHLY_ITEMS.df(spark, sf), MONTHLY_DEPARTMENTS.df(spark, sf),
        on=[(k, k) for k in keys], take={"department": "department"},
    )
    month = F.col("month_end").cast("string").alias("month_end")
    return rows.select("member", "org", month, "l_linenumber", "department")


@check(
    "SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY p_brand, p_size HAVING count(*) > 1"
)
def j_duplicate_key_report(spark, sf):
    return duplicate_keys(table(spark, sf, "part"), ["p_brand", "p_size"])


@check(
    "SELECT l_orderkey, l_linenumber, n_name FROM lineitem "
    "LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey"
)
def j9_bounded_broadcast(spark, sf):
    suppliers = bounded_broadcast(table(spark, sf, "supplier").select("s_suppkey", "s_nationkey"))
    nations = bounded_broadcast(table(spark, sf, "nation"))
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    rows = left_lookup(
        items, suppliers, on=[("l_suppkey", "s_suppkey")], take={"s_nationkey": "s_nationkey"}
    )
    rows = left_lookup(
        rows, nations, on=[("s_nationkey", "n_nationkey")], take={"n_name": "n_name"}
    )
    return rows.select("l_orderkey", "l_linenumber", "n_name")


SPANS = Derived("""
    SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS first_day,
           CASE WHEN o_custkey % 4 = 0 THEN last_day(max(CAST(o_orderdate AS DATE)))
                WHEN o_custkey % 4 = 1 THEN NULL
                ELSE max(CAST(o_orderdate AS DATE)) END AS last_day_in
    FROM {orders} GROUP BY o_custkey
""")


@check(
    f"""
    WITH spans AS {SPANS.sql},
    months AS (
      SELECT o_custkey, first_day, last_day_in,
             unnest(generate_series(CAST(date_trunc('month', first_day) AS TIMESTAMP),
                                    CAST(last_day_in AS TIMESTAMP), INTERVAL 1 MONTH)) AS m
      FROM spans
    )
    SELECT o_custkey, CAST(last_day(CAST(m AS DATE)) AS VARCHAR) AS month_end
    FROM months WHERE last_day(CAST(m AS DATE)) BETWEEN first_day AND last_day_in
    """
)
def j10_month_ends(spark, sf):
    rows = month_ends(SPANS.df(spark, sf), "first_day", "last_day_in")
    return rows.select("o_custkey", F.col("month_end").cast("string").alias("month_end"))


PERIODS = Derived("""
    SELECT p_partkey, 'n^' || CAST(p_size AS STRING) AS network,
           CAST('1995-01-15' AS DATE) AS starts,
           CASE WHEN p_partkey % 2 = 0 THEN CAST('9999-12-31' AS DATE)
                ELSE CAST('2000-06-30' AS DATE) END AS ends
    FROM {part}
""")


@check(
    "SELECT l_orderkey, l_linenumber, network FROM lineitem "
    f"LEFT JOIN {PERIODS.sql} ON l_partkey = p_partkey "
    "AND last_day(CAST(l_shipdate AS DATE)) BETWEEN starts AND ends"
)
def j10_open_ended_periods(spark, sf):
    """Open-ended periods, expanded over the items' months and joined on the month."""
    items = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.last_day(F.to_date("l_shipdate")).alias("month_end"),
    )
    networks = month_ends(
        PERIODS.df(spark, sf), "starts", "ends", calendar=value_range(items, "month_end")
    )
    rows = left_lookup(
        items, networks, on=[("l_partkey", "p_partkey"), ("month_end", "month_end")],
        take={"network": "network"},
    )
    return rows.select("l_orderkey", "l_linenumber", "network")


@check(
    "SELECT l_orderkey, l_linenumber, network FROM lineitem "
    f"LEFT JOIN {PERIODS.sql} ON l_partkey = p_partkey "
    "AND last_day(CAST(l_shipdate AS DATE)) BETWEEN starts AND ends"
)
def j10_period_lookup(spark, sf):
    """The same periods looked up without a row per month."""
    items = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.last_day(F.to_date("l_shipdate")).alias("month_end"),
    )
    rows = period_lookup(
        items, PERIODS.df(spark, sf), [("l_partkey", "p_partkey")], "month_end", "starts", "ends",
        {"network": "network"}, calendar=value_range(items, "month_end"),
    )
    return rows.select("l_orderkey", "l_linenumber", "network")
