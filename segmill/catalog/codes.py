"""Code cleaning and segmentation rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from segmill.catalog.base import V7, V8, VE, Derived, check, sql_caret, sql_clean, sql_list
from segmill.functions import rules
from segmill.functions.codes import (
    MISSING,
    MISSING_EMPLOYEE,
    MISSING_OR_NA,
    caret_fix,
    clean_code,
    or_unknown,
    upper_trim,
)
from segmill.operators.joins import left_lookup
from segmill.operators.windows import partition_max
from segmill.sources.config import JobConfig

CODES = Derived("""
    SELECT o_orderkey,
           CASE o_orderkey % 17
                WHEN 0 THEN '' WHEN 1 THEN '~01' WHEN 2 THEN '~02' WHEN 3 THEN '~03'
                WHEN 4 THEN '~NA' WHEN 5 THEN '~DV' WHEN 6 THEN 'UNK' WHEN 7 THEN 'NA'
                WHEN 8 THEN NULL WHEN 9 THEN ' ~01' WHEN 10 THEN 'unk' WHEN 11 THEN '^a^b^'
                WHEN 12 THEN '~EZ' WHEN 13 THEN ' ~ud ' WHEN 14 THEN '  '
                ELSE ' ' || lower(o_orderpriority) || '^ ' END AS code
    FROM {orders}
""")


@check(
    f"SELECT o_orderkey, code, {sql_clean('code')} AS kept, "
    f"{sql_clean('code', V7, sql_caret('code'))} AS fixed, "
    f"{sql_clean('code', V7, null=False)} AS null_kept, "
    f"{sql_clean('code', V8, sql_caret('code'))} AS with_na, "
    f"{sql_clean('code', VE, 'upper(trim(code))')} AS employee FROM {CODES.sql}"
)
def d1_clean_code(spark, sf):
    code = F.col("code")
    return CODES.df(spark, sf).select(
        "o_orderkey", "code",
        clean_code(code).alias("kept"),
        clean_code(code, MISSING, transform=caret_fix).alias("fixed"),
        clean_code(code, MISSING, null_is_missing=False).alias("null_kept"),
        clean_code(code, MISSING_OR_NA, transform=caret_fix).alias("with_na"),
        clean_code(code, MISSING_EMPLOYEE, transform=upper_trim).alias("employee"),
    )


CARETS = Derived("""
    SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '^' || p_name WHEN 1 THEN p_name || '^ '
           WHEN 2 THEN NULL ELSE replace(p_name, ' ', '^') END AS name
    FROM {part}
""")


@check(
    f"SELECT p_partkey, {sql_caret('name')} AS letter, "
    f"upper(trim(replace(name, '^', ' '))) AS spaced FROM {CARETS.sql}"
)
def d2_caret_fix(spark, sf):
    return CARETS.df(spark, sf).select(
        "p_partkey", caret_fix(F.col("name")).alias("letter"),
        caret_fix(F.col("name"), "space").alias("spaced"),
    )


ORGS = Derived("""
    SELECT p_partkey,
           CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE 'g' || CAST(p_size AS STRING) END AS org,
           CASE p_partkey % 9 WHEN 0 THEN '~01' WHEN 1 THEN 'NA' WHEN 2 THEN NULL WHEN 3 THEN ''
                ELSE p_brand END AS related,
           CASE p_partkey % 3 WHEN 0 THEN '823' WHEN 1 THEN '886' ELSE NULL END AS source,
           CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_type END AS product
    FROM {part}
""")


@check(
    f"SELECT p_partkey, CASE WHEN related IN ({V8}) OR related IS NULL THEN org || '~UNK' "
    f"ELSE related END AS subgroup FROM {ORGS.sql}"
)
def d3_subgroup_id(spark, sf):
    return ORGS.df(spark, sf).select(
        "p_partkey", rules.subgroup_id(F.col("related"), F.col("org")).alias("subgroup")
    )


NULLED = Derived("""
    SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS product,
           CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE lower(c_mktsegment) END AS source
    FROM {customer}
""")


@check(
    "SELECT c_custkey, coalesce(product, 'UNK') AS prod_id1, "
    f"coalesce(upper(source), 'UNK') AS source_cd FROM {NULLED.sql}"
)
def d4_null_to_unknown(spark, sf):
    return NULLED.df(spark, sf).select(
        "c_custkey", or_unknown(F.col("product")).alias("prod_id1"),
        or_unknown(F.col("source"), F.upper).alias("source_cd"),
    )


STATUSES = Derived("""
    SELECT CASE WHEN c_acctbal > 0 THEN c_custkey ELSE c_custkey + 100000000 END AS org, CASE c_custkey % 6 WHEN 0 THEN 'UNK' WHEN 1 THEN NULL
           WHEN 2 THEN '~DV' ELSE lower(c_mktsegment) END AS category
    FROM {customer}
""")


@check(
    f"SELECT o_orderkey, {sql_clean('category')} AS status "
    f"FROM orders LEFT JOIN {STATUSES.sql} ON o_custkey = org"
)
def d5_group_status(spark, sf):
    orders = Derived("SELECT o_orderkey, o_custkey FROM {orders}").df(spark, sf)
    rows = left_lookup(
        orders, STATUSES.df(spark, sf), on=[("o_custkey", "org")], take={"category": "category"}
    )
    return rows.select("o_orderkey", clean_code(F.col("category")).alias("status"))


@check(
    "SELECT p_partkey, CASE WHEN source IN ('823') THEN substring(product, 1, 3) ELSE product "
    f"END AS plan_code FROM {ORGS.sql}"
)
def d6_group_plan_code(spark, sf):
    return ORGS.df(spark, sf).select(
        "p_partkey", rules.group_plan_code(F.col("source"), F.col("product")).alias("plan_code")
    )


OWN = Derived("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CASE l_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'NA' WHEN 2 THEN '~03'
                ELSE lower(l_returnflag) || '^x ' END AS own
    FROM {lineitem}
""")
PLANS = Derived("""
    SELECT CASE WHEN p_size <= 25 THEN p_partkey ELSE p_partkey + 100000000 END AS plan_key,
           CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '~01' ELSE 'pg^' || p_brand END AS grp,
           CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'NA' ELSE ' c^' || p_type END AS cat
    FROM {part}
""")
PRODUCTS = Derived("""
    SELECT CASE WHEN s_acctbal > 0 THEN s_suppkey ELSE s_suppkey + 100000000 END AS product_key,
           CASE s_suppkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'NA' WHEN 2 THEN '~NA'
                ELSE 's^' || s_name END AS grp
    FROM {supplier}
""")


def _cascade(spark, sf):
    rows = left_lookup(
        OWN.df(spark, sf), PLANS.df(spark, sf), on=[("l_partkey", "plan_key")],
        take={"plan_grp": "grp", "plan_cat": "cat"}, matched="in_plans",
    )
    return left_lookup(
        rows, PRODUCTS.df(spark, sf), on=[("l_suppkey", "product_key")],
        take={"product_grp": "grp"}, matched="in_products",
    )


CASCADE_SQL = (
    f"FROM {OWN.sql} o LEFT JOIN {PLANS.sql} a ON o.l_partkey = a.plan_key "
    f"LEFT JOIN {PRODUCTS.sql} b ON o.l_suppkey = b.product_key"
)


@check(
    "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN plan_key IS NOT NULL THEN a.grp "
    f"WHEN product_key IS NOT NULL AND (b.grp IN ({V8}) OR b.grp IS NULL) THEN 'NA' "
    f"WHEN product_key IS NOT NULL THEN {sql_caret('b.grp')} ELSE 'NA' END AS plan_group "
    + CASCADE_SQL
)
def d7_plan_group_cascade(spark, sf):
    group = rules.plan_group_id(
        F.col("in_plans"), F.col("plan_grp"), F.col("in_products"), F.col("product_grp")
    )
    return _cascade(spark, sf).select(
        "l_orderkey", "l_linenumber", "l_partkey", group.alias("plan_group")
    )


@check(
    "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN plan_key IS NOT NULL "
    f"THEN {sql_caret('a.cat')} ELSE {sql_clean('own', V8, sql_caret('own'))} END AS category "
    + CASCADE_SQL
)
def d8_plan_category(spark, sf):
    category = rules.plan_category(F.col("in_plans"), F.col("plan_cat"), F.col("own"))
    return _cascade(spark, sf).select(
        "l_orderkey", "l_linenumber", "l_partkey", category.alias("category")
    )


NETWORKS = Derived("""
    SELECT CASE WHEN p_size > 10 THEN p_partkey ELSE p_partkey + 100000000 END AS offering, CASE p_partkey % 6 WHEN 0 THEN 'NA' WHEN 1 THEN '' WHEN 2 THEN NULL
           ELSE 'net^' || p_brand END AS network
    FROM {part}
""")


@check(
    f"SELECT l_orderkey, l_linenumber, {sql_clean('network', V8, sql_caret('network'))} AS network_id "
    f"FROM lineitem LEFT JOIN {NETWORKS.sql} ON l_partkey = offering"
)
def d9_network_id(spark, sf):
    items = Derived("SELECT l_orderkey, l_linenumber, l_partkey FROM {lineitem}").df(spark, sf)
    rows = left_lookup(
        items, NETWORKS.df(spark, sf), on=[("l_partkey", "offering")], take={"network": "network"}
    )
    return rows.select(
        "l_orderkey", "l_linenumber", rules.network_id(F.col("network")).alias("network_id")
    )


TYPED = Derived("""
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE l_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 1 ELSE 0 END AS dental,
           CASE l_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 2 ELSE 0 END AS vision,
           CASE l_partkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '~02' WHEN 2 THEN '' WHEN 3 THEN 'unk'
                ELSE 'med' END AS plan_type,
           CASE l_suppkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'UNK' WHEN 2 THEN '~DV'
                ELSE 'phr' END AS product_type
    FROM {lineitem}
""")


@check(
    f"SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN t IN ({V7}) THEN 'NA' ELSE t END AS "
    "service_type FROM (SELECT *, CASE WHEN dental <> 0 THEN 'DEN' WHEN vision <> 0 THEN 'VIS' "
    f"WHEN plan_type IN ({V7}) OR plan_type IS NULL THEN coalesce(product_type, 'NA') "
    f"ELSE upper(plan_type) END AS t FROM {TYPED.sql})"
)
def d10_service_type(spark, sf):
    kind = rules.service_type(
        F.col("dental"), F.col("vision"), F.col("plan_type"), F.col("product_type")
    )
    return TYPED.df(spark, sf).select(
        "l_orderkey", "l_linenumber", "l_partkey", kind.alias("service_type")
    )


@check(
    f"SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN t IN ({V7}) THEN 'NA' ELSE t END AS "
    f"service_type FROM (SELECT *, CASE WHEN product_type IN ({V7}) OR plan_type IS NULL "
    f"THEN coalesce(product_type, 'NA') ELSE upper(plan_type) END AS t FROM {TYPED.sql})"
)
def d11_original_service_type(spark, sf):
    kind = rules.original_service_type(F.col("plan_type"), F.col("product_type"))
    return TYPED.df(spark, sf).select(
        "l_orderkey", "l_linenumber", "l_partkey", kind.alias("service_type")
    )


PACKAGES = Derived("""
    SELECT CASE WHEN s_acctbal > 1000 THEN s_suppkey ELSE s_suppkey + 100000000 END AS ref_key, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'Y' END AS by_id,
           CASE WHEN s_suppkey % 2 = 0 THEN NULL ELSE 'Y' END AS by_number
    FROM {supplier}
""")


@check(
    "SELECT l_orderkey, l_linenumber, CASE "
    "WHEN ref_key IS NOT NULL AND by_id IS NOT NULL AND by_number IS NOT NULL THEN 'id' "
    "WHEN ref_key IS NOT NULL AND by_id IS NOT NULL AND by_number IS NULL THEN 'id' "
    "WHEN ref_key IS NOT NULL AND by_id IS NULL AND by_number IS NOT NULL THEN 'number' "
    "WHEN ref_key IS NOT NULL AND by_id IS NULL AND by_number IS NULL THEN 'id' "
    f"ELSE 'id' END AS plan_id FROM lineitem LEFT JOIN {PACKAGES.sql} ON l_suppkey = ref_key"
)
def d12_plan_id(spark, sf):
    items = Derived("SELECT l_orderkey, l_linenumber, l_suppkey FROM {lineitem}").df(spark, sf)
    rows = left_lookup(
        items, PACKAGES.df(spark, sf), on=[("l_suppkey", "ref_key")],
        take={"by_id": "by_id", "by_number": "by_number"}, matched="known",
    )
    plan = rules.plan_id(
        F.col("known"), F.col("by_id"), F.col("by_number"), F.lit("id"), F.lit("number")
    )
    return rows.select("l_orderkey", "l_linenumber", plan.alias("plan_id"))


OVERRIDES = Derived("""
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE l_orderkey % 9 WHEN 0 THEN 'N' WHEN 1 THEN NULL ELSE 'Y' END AS flag,
           CASE WHEN l_linenumber = 7 THEN '05' ELSE '06' END AS principal,
           CASE l_suppkey % 6 WHEN 0 THEN '886' WHEN 1 THEN '868' WHEN 2 THEN '867'
                WHEN 3 THEN '878' WHEN 4 THEN '823' ELSE NULL END AS source,
           CASE l_partkey % 11 WHEN 0 THEN 'HM12' WHEN 1 THEN 'RX9' WHEN 2 THEN 'PPFS'
                WHEN 3 THEN 'PPXH' WHEN 4 THEN 'PPOIHAPMCMHS' WHEN 5 THEN 'PPONHSKMPVHA'
                WHEN 6 THEN 'PPONSMKMPVHS' WHEN 7 THEN NULL WHEN 8 THEN 'hm1'
                ELSE 'PP77' END AS product
    FROM {lineitem}
""")
ADMINS = Derived("""
    SELECT CASE WHEN p_size > 5 THEN p_partkey ELSE p_partkey + 100000000 END AS product_key, CASE p_partkey % 4 WHEN 0 THEN 'UNK' WHEN 1 THEN 'LUM'
           WHEN 2 THEN NULL ELSE 'ABC' END AS admin
    FROM {part}
""")
_EXCLUDED = sql_list(rules.OverrideRule().excluded_products)


@check(
    "SELECT l_orderkey, l_linenumber, l_partkey, CASE "
    "WHEN flag = 'Y' AND product_key IS NOT NULL AND principal = '06' "
    "AND source IN ('886', '868') AND ((admin = 'UNK' AND NOT product IN ('PPOIHAPMCMHS')) "
    "OR (admin = 'LUM' AND product IN ('PPONHSKMPVHA', 'PPONSMKMPVHS')) OR admin <> 'LUM') "
    "THEN 'Y' WHEN flag = 'Y' AND product_key IS NOT NULL AND principal = '06' "
    "AND source IN ('867', '878') AND product NOT LIKE 'HM%' AND product NOT LIKE 'RX%' "
    f"AND product NOT IN ({_EXCLUDED}) THEN 'Y' ELSE 'N' END AS override_flag "
    f"FROM {OVERRIDES.sql} LEFT JOIN {ADMINS.sql} ON l_partkey = product_key"
)
def d13_override_flag(spark, sf):
    rows = left_lookup(
        OVERRIDES.df(spark, sf), ADMINS.df(spark, sf), on=[("l_partkey", "product_key")],
        take={"admin": "admin"}, matched="known",
    )
    flag = rules.override_flag(
        F.col("flag"), F.col("known"), F.col("principal"), F.col("source"), F.col("admin"),
        F.col("product"),
    )
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", flag.alias("override_flag"))


TEXTS = Derived("""
    SELECT o_orderkey,
           CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '~DV' ELSE ' d^' || lower(o_orderpriority) END AS dept,
           CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE ' t^' || lower(o_orderstatus) END AS claim,
           CASE o_orderkey % 7 WHEN 0 THEN '~EZ' WHEN 1 THEN '~AL' WHEN 2 THEN NULL WHEN 3 THEN '~01'
                ELSE ' e^' || lower(o_orderstatus) || ' ' END AS employee
    FROM {orders}
""")


@check(
    f"SELECT o_orderkey, trim({sql_clean('dept', V7, 'upper(dept)')}) AS dept, "
    f"{sql_clean('claim', V7, sql_caret('claim'))} AS claim, "
    f"{sql_clean('employee', VE, 'upper(trim(employee))')} AS employee FROM {TEXTS.sql}"
)
def d14_department_codes(spark, sf):
    return TEXTS.df(spark, sf).select(
        "o_orderkey",
        F.trim(clean_code(F.col("dept"), transform=F.upper)).alias("dept"),
        clean_code(F.col("claim"), transform=caret_fix).alias("claim"),
        clean_code(F.col("employee"), MISSING_EMPLOYEE, transform=upper_trim).alias("employee"),
    )


MONTHLY = Derived("""
    SELECT o_orderkey, o_custkey, last_day(CAST(o_orderdate AS DATE)) AS month_end FROM {orders}
""")
LINKS = Derived("""
    SELECT CASE WHEN o_orderstatus <> 'F' THEN o_custkey ELSE o_custkey + 100000000 END AS related, last_day(CAST(o_orderdate AS DATE)) AS month_end,
           CASE o_orderkey % 4 WHEN 0 THEN '06 ' WHEN 1 THEN '02' WHEN 2 THEN NULL
                ELSE ' 06' END AS kind,
           CASE o_orderkey % 9 WHEN 0 THEN NULL
                ELSE 'o^' || CAST(o_orderkey AS STRING) END AS org
    FROM {orders}
""")


def _linked_sql(wanted: str) -> str:
    return (
        "SELECT o_orderkey, CASE "
        f"WHEN NOT (l.related IS NULL) AND trim(l.kind) = '{wanted}' THEN {sql_caret('l.org')} "
        f"WHEN l.related IS NULL AND trim(l.kind) = '{wanted}' THEN 'UNK' ELSE 'NA' END AS org "
        f"FROM {MONTHLY.sql} m LEFT JOIN {LINKS.sql} l "
        "ON m.o_custkey = l.related AND m.month_end = l.month_end"
    )


def _linked(spark, sf, wanted):
    rows = left_lookup(
        MONTHLY.df(spark, sf), LINKS.df(spark, sf),
        on=[("o_custkey", "related"), ("month_end", "month_end")],
        take={"kind": "kind", "org": "org"}, matched="linked",
    )
    org = rules.linked_org(F.col("linked"), F.col("kind"), F.col("org"), wanted)
    return rows.select("o_orderkey", org.alias("org"))


@check(_linked_sql("06"))
def d15_association_id(spark, sf):
    return _linked(spark, sf, "06")


@check(_linked_sql("02"))
def d15_client_id(spark, sf):
    return _linked(spark, sf, "02")


ROLLUPS = Derived("""
    SELECT CASE WHEN r_regionkey < 4 THEN r_name ELSE r_name || '+' END AS funding, CASE r_regionkey % 3 WHEN 0 THEN NULL ELSE lower(r_name) END AS rollup_cd
    FROM {region}
""")
FUNDED = Derived("""
    SELECT n_nationkey, CASE WHEN n_nationkey % 6 = 0 THEN NULL ELSE r_name END AS funding_cd
    FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
""")


@check(
    "SELECT c_custkey, CASE WHEN r.funding IS NOT NULL AND rollup_cd IS NOT NULL "
    "THEN upper(rollup_cd) ELSE 'I' END AS insured "
    f"FROM customer JOIN {FUNDED.sql} ON c_nationkey = n_nationkey "
    f"LEFT JOIN {ROLLUPS.sql} r ON funding_cd = r.funding"
)
def d16_funding_code(spark, sf):
    customers = Derived("SELECT c_custkey, c_nationkey FROM {customer}").df(spark, sf)
    rows = left_lookup(
        customers, FUNDED.df(spark, sf), on=[("c_nationkey", "n_nationkey")],
        take={"funding_cd": "funding_cd"},
    )
    rows = left_lookup(
        rows, ROLLUPS.df(spark, sf), on=[("funding_cd", "funding")],
        take={"rollup_cd": "rollup_cd"}, matched="funded",
    )
    code = rules.funding_code(F.col("funded"), F.col("rollup_cd"))
    return rows.select("c_custkey", code.alias("insured"))


COVERED = Derived("""
    SELECT o_orderkey, o_custkey,
           CAST(1 + month(CAST(o_orderdate AS DATE)) % 2 AS INT) AS slot,
           CASE o_orderkey % 8 WHEN 0 THEN 'P' WHEN 1 THEN 'PA' WHEN 2 THEN 'X' WHEN 3 THEN '~01'
                WHEN 4 THEN NULL WHEN 5 THEN 'NA' ELSE 'P' END AS month_code
    FROM {orders}
""")
COORDINATION = Derived("""
    SELECT user_id AS member, CAST(1 + day(CAST(ts AS DATE)) % 2 AS INT) AS slot,
           CASE event_type WHEN 'click' THEN 'MDCR' WHEN 'view' THEN 'MEDCR' ELSE 'COMM' END AS kind,
           CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 1 ELSE 2 END AS ord
    FROM {events}
""")


@check(
    f"SELECT o_orderkey, c.slot, CASE WHEN month_code IN ({V8}) OR month_code IS NULL "
    "OR NOT month_code IN ('P', 'PA') OR ord = 1 THEN 'N' ELSE 'Y' END AS primary_coverage, "
    "CASE WHEN kind IN ('MDCR', 'MEDCR') AND ord = 1 THEN 'Y' ELSE 'N' END AS medicare "
    f"FROM {COVERED.sql} c LEFT JOIN {COORDINATION.sql} b ON o_custkey = member AND c.slot = b.slot"
)
def d17_coverage_flags(spark, sf):
    rows = left_lookup(
        COVERED.df(spark, sf), COORDINATION.df(spark, sf),
        on=[("o_custkey", "member"), ("slot", "slot")], take={"kind": "kind", "ord": "ord"},
    )
    return rows.select(
        "o_orderkey", "slot",
        rules.primary_coverage(F.col("month_code"), F.col("ord")).alias("primary_coverage"),
        rules.medicare(F.col("kind"), F.col("ord")).alias("medicare"),
    )


GRAIN = Derived("""
    SELECT l_orderkey, l_linenumber, l_suppkey, last_day(CAST(l_shipdate AS DATE)) AS month_end,
           CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE 'f' || CAST(l_partkey % 50 AS STRING) END AS funding
    FROM {lineitem}
""")


@check(
    "SELECT l_orderkey, l_linenumber, l_suppkey, CAST(month_end AS VARCHAR) AS month_end, "
    f"max(funding) OVER (PARTITION BY l_orderkey, month_end) AS max_funding FROM {GRAIN.sql}"
)
def d18_max_funding(spark, sf):
    rows = partition_max(
        GRAIN.df(spark, sf), ["l_orderkey", "month_end"], "funding", "max_funding", JobConfig()
    )
    return rows.select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        F.col("month_end").cast("string").alias("month_end"), "max_funding",
    )
