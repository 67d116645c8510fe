"""Random inputs: two ways of computing the same thing, or a brute-force count."""

import calendar
import random
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from segmill.functions.rules import linked_org
from segmill.operators.joins import left_lookup
from segmill.operators.months import month_ends
from segmill.operators.windows import partition_max
from segmill.plans import attribution as at
from segmill.plans import mining
from segmill.plans.segmentation import joined_links, with_linked_orgs
from segmill.sources.config import JobConfig

MONTH = "ELGBLTY_CLNDR_MNTH_END_DT"


def bag(df) -> Counter:
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_joined_links_equal_two_lookups(spark, seed):
    rng = random.Random(seed)
    pick = rng.choice
    sources, orgs, days = ["s", "t", None], ["g1", "g2", "g3", None], [date(2024, 1, 31), None]
    members = spark.createDataFrame(
        [(i, pick(sources), pick(orgs), pick(days)) for i in range(200)],
        f"id int, MBRSHP_SOR_CD string, PRCHSR_ORG_NBR string, {MONTH} date",
    )
    schema = (
        "MBRSHP_SOR_CD string, RLTD_PRCHSR_ORG_NBR string, PRCHSR_ORG_NBR string, "
        f"PRCHSR_ORG_TYPE_CD string, {MONTH} date"
    )

    def links(n):
        rows = [(pick(sources), pick(orgs), pick(["o^1", None, " x "]), pick(["06 ", "02", None]),
                 pick(days)) for _ in range(n)]
        return spark.createDataFrame(rows, schema)

    assn, clnt = links(12), links(9)
    expected = members
    for out, dim, wanted in (("SGMNTN_ASSN_ID", assn, "06"), ("SGMNTN_CLNT_ID", clnt, "02")):
        expected = left_lookup(
            expected, dim,
            [("MBRSHP_SOR_CD", "MBRSHP_SOR_CD"), ("PRCHSR_ORG_NBR", "RLTD_PRCHSR_ORG_NBR"),
             (MONTH, MONTH)],
            {"o": "PRCHSR_ORG_NBR", "t": "PRCHSR_ORG_TYPE_CD"}, matched="m",
        )
        expected = expected.withColumn(out, linked_org(F.col("m"), F.col("t"), F.col("o"), wanted))
        expected = expected.drop("o", "t", "m")
    assert bag(with_linked_orgs(members, joined_links(assn, clnt))) == bag(expected)


@pytest.mark.parametrize("seed", [1, 2])
def test_attribution_ways_agree_with_nested_loops(spark, seed):
    rng = random.Random(seed)
    ids = ["NA", "a", "b", "c", None]
    members = [(rng.choice(["s", "t", None]), rng.choice(ids), rng.choice(ids), rng.choice(ids))
               for _ in range(150)]
    relations = [(rng.choice(["s", "t", None]), rng.choice(["GRP", "CLNT", "ASSN"]),
                  rng.choice(ids), rng.choice(["x", "y", "z"])) for _ in range(25)]
    expected = Counter()
    for m in members:
        for source, kind, org, account in relations:
            own = {"GRP": m[1], "CLNT": m[2], "ASSN": m[3]}[kind]
            if None not in (source, org) and (source, org) == (m[0], own):
                expected[(*m, account)] += 1
    df = spark.createDataFrame(members, "src string, g string, c string, a string")
    rel = spark.createDataFrame(
        relations, "source string, org_type string, org_id string, ACCT_ID string")
    routes = {"GRP": "g", "CLNT": "c", "ASSN": "a"}
    assert bag(at.attribute_by_route(df, rel, "src", routes)) == expected
    combined = at.attribute_by_combination(df, rel, "src", routes)
    copies = Counter(members)
    assert bag(combined) == {row: copies[row[:-1]] for row in expected}


def test_month_ends_equal_a_walk_over_the_days(spark):
    rng = random.Random(5)
    spans = []
    for i in range(300):
        start = date(1999, 1, 1) + timedelta(days=rng.randrange(2000))
        spans.append((i, start, start + timedelta(days=rng.randrange(-40, 200))))
    expected = Counter()
    for i, start, end in spans:
        day = start
        while day <= end:
            if day.day == calendar.monthrange(day.year, day.month)[1]:
                expected[(i, day)] += 1
            day += timedelta(days=1)
    df = spark.createDataFrame(spans, "id int, s date, e date")
    assert bag(month_ends(df, "s", "e").select("id", "month_end")) == expected


@pytest.mark.parametrize("min_rows", [0, 5, 60, 10_000])
def test_partition_max_equals_a_dictionary(spark, min_rows):
    rng = random.Random(7)
    keys = [None, "hot", "hot", "hot", *[f"k{i}" for i in range(30)]]
    rows = [(rng.choice(keys), rng.choice([None, 1]), rng.choice([None, "a", "b", "c"]))
            for _ in range(500)]
    best = {}
    for k, q, v in rows:
        best[k, q] = max((x for x in (best.get((k, q)), v) if x is not None), default=None)
    df = spark.createDataFrame(rows, "k string, q int, v string")
    out = partition_max(df, ["k", "q"], "v", "m", JobConfig(), min_rows)
    assert bag(out) == Counter((k, q, v, best[k, q]) for k, q, v in rows)


def test_encoding_round_trip_over_all_planes(spark):
    rng = random.Random(11)
    alphabet = "aZ ~\n\téЖ中￮\U0001f600\U0010fffd"
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(0, 30))) for _ in range(100)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    vocab = mining.vocabulary(df, "t")
    ordered = sorted(set("".join(texts)))
    out = mining.decode(mining.encode(df, "t", vocab), "ids", vocab, out="back").collect()
    for row in out:
        assert row.ids == [ordered.index(c) for c in row.t]
        assert row.back == row.t
