"""Scans of texts in pieces against the row-local scans of whole texts."""

import random

import pytest
from pyspark.sql import functions as F

from segmill.functions import text as T
from segmill.plans import mining, split_texts
from segmill.sources.config import JobConfig

SCAN_TEXTS = [
    'val a = x.select("b;c"); // it\'s "quoted\nd = 1; e', "a\\'b'c;d\\\"e'f;", "//*a;b/*c//d;e\nf;/", "///*x;*/y//\n//z;w",
    "''\"\"\\\\'q;r", ";;; a ;\n;", "no end", "/", "\\", "'\\", "é;λ // ñ\nö;", "a/b;c//d", '"//";x', "//\";y\n\";z",
]


def scanned(spark, texts, cuts):
    """Statements of the texts, each cut at the given places."""
    rows = [(i, n, t[a:b]) for i, (t, at) in enumerate(zip(texts, cuts, strict=True))
            for n, (a, b) in enumerate(zip([0, *at], [*at, len(t)], strict=True)) if a < b]
    pieces = spark.createDataFrame(rows, "id int, piece int, text string").repartition(3)
    return sorted(map(tuple, split_texts.scan_statements(pieces, "id", JobConfig()).collect()))


def row_local(spark, texts, how):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    return sorted(map(tuple, mining.extract(df, "id", "text", how).collect()))


def test_scan_cut_at_every_position(spark):
    """Every text cut in two at every place, all at once as texts of their own."""
    texts, cuts = zip(*[(t, [k]) for t in SCAN_TEXTS for k in range(1, len(t))], strict=True)
    assert scanned(spark, texts, cuts) == row_local(spark, texts, T.scan_statements)


def test_scan_of_random_texts_in_many_pieces(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice("ab;;'\"\\//*\n ") for _ in range(rng.randrange(1, 60))) for _ in range(300)]
    cuts = [sorted(rng.sample(range(1, len(t)), rng.randrange(0, min(9, len(t))))) if len(t) > 1 else [] for t in texts]
    assert scanned(spark, texts, cuts) == row_local(spark, texts, T.scan_statements)
    singles = [list(range(1, len(t))) for t in texts]
    assert scanned(spark, texts, singles) == row_local(spark, texts, T.scan_statements)


@pytest.mark.parametrize("how, whole", [
    (split_texts.line_blocks, T.line_blocks), (split_texts.normalised_blocks, T.normalised_blocks),
])
def test_blocks_of_pieces_of_lines(spark, how, whole):
    rng = random.Random(9)
    line = lambda: rng.choice(["select a", "x", "from (b)", "y;  ", "", "where q", "z )\t", "== c .d", "val j = join e"])
    texts = ["\n".join(line() for _ in range(rng.randrange(1, 14))) + rng.choice(["", "\n"]) for _ in range(250)]
    texts += ["", None, "select\n\n\n;"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for length in (1, 9, 10_000):
        pieces = split_texts.cut_at_lines(df, "id", "text", length)
        got = sorted(map(tuple, how(pieces, "id", JobConfig()).collect()))
        assert got == row_local(spark, texts, whole)


def test_pieces_are_the_text(spark):
    df = spark.createDataFrame([(1, "ab\nc\n\ndéf"), (2, ""), (3, None), (4, "\n")], "id int, text string")
    for cut in (split_texts.cut_texts, split_texts.cut_at_lines):
        rows = cut(df, "id", "text", 2).groupBy("id").agg(
            F.array_sort(F.collect_list(F.struct("piece", "text"))).alias("p")).collect()
        assert {r.id: "".join(x.text for x in r.p) for r in rows} == {1: "ab\nc\n\ndéf", 4: "\n"}
    numbered = spark.createDataFrame([(1, k, f"l{k}") for k in range(7)], "id int, line_no long, text string")
    back = sorted(map(tuple, split_texts.lines_to_pieces(numbered, "id", 3).collect()))
    assert back == [(1, 0, "l0\nl1\nl2\n"), (1, 1, "l3\nl4\nl5\n"), (1, 2, "l6\n")]


def test_no_exchange_by_id_alone_carries_text(spark):
    """One text's pieces are dealt over tasks: what is dealt by id alone has no text column."""
    pieces = spark.range(40).selectExpr("1 AS id", "id AS piece", "'a;b' AS text")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = split_texts.scan_statements(pieces, "id", JobConfig())
        plan = found._jdf.queryExecution().executedPlan().toString()
        rows = found.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(rows) == 41 and {r.statement for r in rows} == {"a", "ba", "b"}
    assert "hashpartitioning(id" in plan
    for part in plan.split("Exchange hashpartitioning(")[1:]:
        keys = part.split(")")[0]
        below = part.split("Exchange")[0]
        assert "piece" in keys or "statement" not in below
