import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from segmill.catalog import texts as sql
from segmill.functions import text as T
from segmill.plans import mining


def run(spark, how, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    rows = mining.extract_arrays(df, "id", "text", how).orderBy("id").collect()
    return [r.statements for r in rows]


SCRIPT = '''val people = session.table("people")
val adults = people.select($"name", $"age")
  .where($"age" >= 18)
println("done")
val both = adults.join(other,
  $"a.k" === $"b.k")
val n = counter.sql("select 1")
'''


def test_fragments(spark):
    found = run(spark, T.fragments, SCRIPT, "", None, "x.TABLE( \"t\" )", 'select("a" from .sql b)')
    assert found[0] == ["people", "select 1"]
    assert found[1] == [] and found[2] is None
    # An upper-case call matches but carries no mark, so it stays whole.
    assert found[3] == ['.TABLE( "t" )']
    assert found[4] == ["a"]


def test_fragment_with_line_end_in_its_quotes_is_dropped(spark):
    assert run(spark, T.fragments, '.table("a\nb")', ".table('q' \"c\nd\")") == [[], []]


def test_line_blocks(spark):
    blocks = run(spark, T.line_blocks, SCRIPT)[0]
    assert blocks == [
        'val adults = people.select($"name", $"age")\n',
        '  .where($"age" >= 18)\n',
        'val both = adults.join(other,\n  $"a.k" === $"b.k")\n',
        'val n = counter.sql("select 1")\n',
    ]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("", []),
        ("select open", []),
        ("select a)\nb);\n", ["select a)\n"]),
        ("x readFromDisk(y) \t\n", ["x readFromDisk(y) \t\n"]),
        ("a;\n\nGROUP  BY\ngroup BY x\n y); ", ["group BY x\n y); "]),
        ("join(\n\n  ;", ["join(\n\n  ;"]),
        ("where a) + b\nc)", ["where a) + b\nc)"]),
    ],
)
def test_line_block_edges(spark, text, expected):
    assert run(spark, T.line_blocks, text) == [expected]


def test_normalised_blocks(spark):
    assert run(spark, T.normalised_blocks, SCRIPT)[0] == [
        "people(name, age)",
        "where(age >= 18)",
        "bk)",
        "countersql(select 1)",
    ]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("", []),
        (";;", []),
        (" ; a", ["", "a"]),
        ("a=1; b_c(2)", ["a=", "bc()"]),
        ('x "a;b" y', ["x  y"]),
        ("it's; gone", ["it"]),
        ('a "b\\"; c" d; e', ["a  d", "e"]),
        ("a // b; c\nd; e", ["a d", "e"]),
        ('u = "http://x"; lost\nkept', ["u = kept"]),
        ("a // 'q\nin' out", ["a  out"]),
        ("a //* b; c", ["a  b", "c"]),
        ("a // b /* c; d", ["a  c", "d"]),
        ("größe ж 名;", ["größe ж 名"]),
    ],
)
def test_scan_edges(spark, text, expected):
    assert run(spark, T.scan_statements, text) == [expected]


def random_texts(alphabet, n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(alphabet, k=rng.randrange(0, 60))) for _ in range(n)]


def compare(spark, how, statement_sql, texts, column):
    con = duckdb.connect()
    con.register("corpus", pa.table({"id": list(range(len(texts))), column: texts}))
    expected = sorted(con.execute(statement_sql).fetchall())
    df = spark.createDataFrame(list(enumerate(texts)), f"id int, {column} string")
    got = sorted(tuple(r) for r in mining.extract(df, "id", column, how).collect())
    assert got == expected
    assert len(got) > len(texts) / 4


def test_scan_equals_windows_on_random_texts(spark):
    alphabet = ['"', "'", "\\", "/", "/", "*", "\n", ";", ";", "a", "Z", "é", " ", "1", "(", "="]
    texts = random_texts(alphabet, 4000, 1)
    compare(spark, T.scan_statements, sql._scan_sql("corpus", "id", "text"), texts, "text")


def test_blocks_equal_windows_on_random_texts(spark):
    alphabet = ["select", "From", "where", "JOIN", "group by", ")", ";", "\n", "\n", " ", "\t",
                "x", "=", "val ", "$", ".table", ". "]
    texts = random_texts(alphabet, 3000, 2)
    blocks = sql._blocks_sql("corpus", "id", T.BLOCK_KEYWORDS, sql.RAW_BLOCK)
    compare(spark, T.line_blocks, blocks, texts, "script")


def test_long_texts_do_not_exhaust_the_stack(spark):
    n = 200_000
    texts = ["select " + "x\n" * n + ")", "'" * n + ";", "a//b\n;" * n, '"' + "\\\"" * n]
    assert [len(s) for s in run(spark, T.line_blocks, *texts)] == [1, 0, 0, 0]
    assert [len(s) for s in run(spark, T.scan_statements, *texts)] == [1, 0, n, 0]


def test_method_calls(spark):
    calls = run(spark, T.method_calls, SCRIPT + ".agg(max(x)).orderByX(1).filter (2)")[0]
    assert calls == ["select", "where", "join", "agg"]
    edges = run(spark, T.method_calls, ".join(a.where(b).agg(c", ".join(" * 3, "x.select()", "")
    assert edges == [["join"], [], ["select"], []]


def test_vocabulary_is_ordered_by_code_point(spark):
    df = spark.createDataFrame([("bé",), ("a😀b",), ("",), (None,)], "t string")
    vocab = mining.vocabulary(df, "t").orderBy("idx").collect()
    assert [tuple(r) for r in vocab] == [("a", 0), ("b", 1), ("é", 2), ("😀", 3)]


def test_encode_pads_and_decode_restores(spark):
    texts = [(0, "join"), (1, "where"), (2, ""), (3, "no😀in")]
    df = spark.createDataFrame(texts, "id int, t string")
    vocab = mining.vocabulary(df.where("id < 3"), "t")
    alphabet = sorted(set("joinwhere"))
    encoded = mining.encode(df, "t", vocab, pad_to=F.lit(5))
    decoded = mining.decode(encoded, "ids", vocab, out="back").orderBy("id").collect()
    for row in decoded:
        ids = [alphabet.index(c) if c in alphabet else 0 for c in row.t]
        ids += [0] * (5 - len(ids))
        assert row.ids == ids
        assert row.back == "".join(alphabet[i] for i in ids)
    assert len(decoded[3].ids) == 5 and decoded[3].t == "no😀in"


def test_longer_texts_are_not_cut(spark):
    df = spark.createDataFrame([("abcdef",)], "t string")
    vocab = mining.vocabulary(df, "t")
    assert mining.encode(df, "t", vocab, pad_to=F.lit(3)).first().ids == [0, 1, 2, 3, 4, 5]


def test_empty_corpus(spark):
    df = spark.createDataFrame([], "id int, t string")
    assert mining.extract(df, "id", "t").isEmpty()
    assert mining.vocabulary(df, "t").isEmpty()
    assert mining.frequency(df, "t").isEmpty()
    assert mining.encode(df, "t", mining.vocabulary(df, "t")).isEmpty()


def test_encoding_carries_no_lookup_column(spark):
    df = spark.createDataFrame([(1, "ab😀"), (2, None)], "id int, t string")
    vocab = mining.vocabulary(df, "t")
    encoded = mining.encode(df, "t", vocab, pad_to=mining.longest(df, "t"))
    text = encoded._jdf.queryExecution().optimizedPlan().toString()
    # One row-wise step over the input: no column holds the vocabulary.
    assert "_lookup" not in text and text.count("transform(") == 1
    assert [r.ids for r in encoded.orderBy("id").collect()] == [[0, 1, 2], None]
