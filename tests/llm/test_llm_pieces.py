"""Encoding against the model's own library; vectors against brute force; the pipeline."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from segmill.llm import hnsw, pieces
from segmill.llm.queries import PIECES

TEXTS = [
    "hello world", "  two  spaces ", "a\tb\nc", "ﬁ é", "", "émoji 😀", "▁x", " ", "    indent  code     x", "aaaaaaaaaaaaaaaa",
    "日本語のテキスト、中文文本", "Привет мир", "\r\n\r\n", "1234567890", "̀x", "x" * 5000, "the " * 50, "a\x00b",
]


@pytest.fixture(scope="module")
def vocab():
    return pieces.load(PIECES)


def encode(encoder, texts):
    ids, offsets = encoder.encode(*pieces._prepared(pa.array(texts, pa.string())))
    return [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)]


def test_ids_equal_the_library(vocab):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng = random.Random(3)
    letters = "aeinrst the ing  é\nñ▁1."
    texts = TEXTS + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 80))) for _ in range(1500)]
    assert encode(pieces.Encoder(vocab), texts) == model.encode(texts)


def test_forgetting_chunks_changes_nothing(vocab, monkeypatch):
    encoder = pieces.Encoder(vocab)
    first = [encode(encoder, TEXTS[i:i + 3]) for i in range(0, len(TEXTS), 3)]
    monkeypatch.setattr(pieces, "KNOWN_CHUNKS", 3)
    small = pieces.Encoder(vocab)
    assert [encode(small, TEXTS[i:i + 3]) for i in range(0, len(TEXTS), 3)] == first


def test_small_vocabularies_equal_merging():
    """Every text over two letters, for vocabularies with and without shared scores."""
    import itertools

    plain = {p: i for i, p in enumerate(["a", "b", "▁", "ab", "ba", "aa", "bab", "aab", "▁a", "abab"], start=3)}
    for scores in ([0, 0, 0, -1, -2, -3, -4, -5, -6, -7], [0, 0, 0, -7, -6, -5, -4, -3, -2, -1], [0, 0, 0, -1, -1, -2, -2, -3, -3, -1]):
        by_piece = dict(zip(plain, map(float, scores), strict=True))
        v = pieces.vocabulary(plain, by_piece, 13, {}, 0)
        texts = ["".join(t) for n in range(1, 8) for t in itertools.product("ab", repeat=n)]
        got = encode(pieces.Encoder(v), texts)
        assert got == [[plain[p] for p in pieces.merge("▁" + t, plain, by_piece)[0]] for t in texts]


def test_suffixes_are_sorted_and_searched_exactly(vocab):
    rng = np.random.default_rng(3)
    encoder = pieces.Encoder(vocab)
    words = [t for t in vocab.texts if t]
    text = b"".join(words[k] for k in rng.integers(0, len(words), 3_000)) + b"aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa"
    data = np.frombuffer(text, dtype=np.uint8)
    places = np.flatnonzero(data & 0xC0 != 0x80)
    order = pieces._suffix_order(pieces._eights(data, encoder.words * 8), places, encoder.words)
    wide = encoder.words * 8
    suffixes = [text[p: p + wide].ljust(wide, b"\0") for p in places[order]]
    assert suffixes == sorted(suffixes)
    starts, piece = encoder._edges(data)
    found = set(zip(starts.tolist(), piece.tolist(), strict=True))
    searched = {vocab.texts[i]: k for k, i in enumerate(vocab.normal)}
    longest = max(map(len, searched))
    want = {(p, searched[text[p: p + n]]) for p in places.tolist() for n in range(1, longest + 1) if text[p: p + n] in searched}
    assert found == {(p, k) for p, k in want if p + encoder.lengths[k] <= len(text)}


def test_round_trip_on_odd_rows(odd, nothing, vocab):
    out = pieces.decode_ids(pieces.encode(odd.withColumn("ids", F.lit(1)), vocab), vocab)
    assert set(out.columns) == {*odd.columns, "ids", "decoded"} and out.count() == odd.count()
    assert out.where("decoded <> text or ids is null").isEmpty()
    assert out.where("text = '' and size(ids) > 0").isEmpty()
    assert pieces.decode_ids(pieces.encode(nothing, vocab), vocab).count() == 0
    # The check in the same pass; a null text stays null; names in any case.
    checked = pieces.encode(odd.withColumnRenamed("text", "Text").withColumn("Same", F.lit(1)), vocab, "TEXT", check="same")
    assert checked.where("not same").isEmpty() and checked.count() == odd.count()
    assert checked.where("Text is null").count() == odd.where("text is null").count() > 0
    broken = pieces.decode
    try:
        pieces.decode = lambda *a: ["x"] * len(broken(*a))
        assert not any(pieces._encode(iter([pa.record_batch([pa.array(["a b"])], names=["t"])]), vocab, "t", "ids", "same").__next__()["same"].to_pylist())
    finally:
        pieces.decode = broken


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string").repartition(3)


def exact(rows, k):
    usable = {i: np.array(v + [0.0] * (8 - len(v)), dtype=np.float64) for i, v, _ in rows
              if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    out = {}
    for q, x in usable.items():
        if q % 20 == 0:
            others = sorted((-float(np.float32(y).astype(np.float64) @ np.float32(x).astype(np.float64)), i) for i, y in usable.items() if i != q)
            out[q] = [i for _, i in others[:k]]
    return out


def test_nearest_on_odd_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist(), "x") for i in range(600)]
    hot = rng.normal(size=8).astype(np.float32).tolist()
    rows += [(1000 + i, hot, None) for i in range(300)]  # copies of one vector
    rows += [(2000, None, "n"), (2020, [], "n"), (2040, [0.0] * 8, "n"), (2060, [float("nan")] + [1.0] * 7, "n"),
             (2080, [None] + [1.0] * 7, "n"), (2100, [float("inf")] + [1.0] * 7, "n"), (2120, [1.0] * 7, "n"), (None, hot, "n")]
    want = exact(rows, 20)
    rows += rows[:5]
    got = {}
    for r in hnsw.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0, 20).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert set(got) == set(want)
    hits = sum(len(set(want[q]) & {v for _, v in found}) for q, found in got.items())
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert all([k for k, _ in sorted(found)] == list(range(1, 21)) for found in got.values())
    # Copies of a query's own vector come by id, without the query.
    copies = [v for _, v in sorted(got[1000]) if v >= 1000]
    assert copies and copies == list(range(1001, 1001 + len(copies)))


def test_few_or_no_vectors(spark):
    rows = [(0, [1.0, 0.0], "a"), (1, [0.5, 0.5], "a"), (2, [2.0, 0.0], "a")]
    got = hnsw.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0, 20).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [(0, 1, 2, 2.0), (0, 2, 1, 0.5)]
    assert hnsw.nearest(vectors(spark, rows[:0]), F.col("vec_id") % 20 == 0, 20).count() == 0
    assert hnsw.nearest(vectors(spark, rows[1:]), F.col("vec_id") % 20 == 0, 20).count() == 0


def test_recall_over_several_shards(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist(), "x") for i in range(2000)]
    want, shares = exact(rows, 20), []
    for limit in ("SHARD_ROWS", "SHARD_BYTES"):
        monkeypatch.setattr(hnsw, limit, 350 if limit == "SHARD_ROWS" else 350 * 64)
        got = hnsw.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0, 20).collect()
        monkeypatch.undo()
        shares.append(sum(r.vec_id in want[r.query_id] for r in got) / sum(map(len, want.values())))
    # The bound by bytes makes the same shards as the one by rows.
    assert shares[0] == shares[1] > 0.97


def test_recall_in_one_large_graph():
    rng = np.random.default_rng(5)
    points = rng.normal(size=(3000, 24)) * rng.uniform(0.5, 2.0, size=(3000, 1))  # of unequal length
    found = hnsw.search(hnsw.build(points), points[:100])
    best = np.argsort(-(points[:100] @ points.T), axis=1)[:, :20]
    assert np.mean([len(set(a) & set(b)) / 20 for a, b in zip(best.tolist(), found.tolist(), strict=True)]) > 0.9


def test_pipeline_stages(spark, odd, nothing):
    import brute
    import corpus_pipeline as pipeline

    assert [n for n, _ in pipeline.STAGES][2] == "near dedup" and len(pipeline.STAGES) == 5
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs
    for k, (name, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, before, sf).cache()
        if k < 4:
            assert out.columns == columns, name
        if name == "near dedup":
            rows = [(r.doc_id, r.text) for r in before.collect()]
            classes = brute.classes(rows)
            assert {r.doc_id for r in out.collect()} == {c for c in classes.values()}
        if name == "quality classifier":
            labels = spark.read.parquet(f"{sf}/labels.parquet")
            assert docs.join(labels.where("quality = 1"), "doc_id").join(out, "doc_id", "left_anti").count() < 8
            assert out.join(labels.where("quality = 0"), "doc_id").count() < 8
        before = out
    assert before.where("not round_trip").isEmpty() and before.count() > 100
    assert pipeline.run(spark, sf).exceptAll(before).isEmpty()
    for _, stage in pipeline.STAGES:
        assert stage(spark, odd, sf).count() <= odd.count()
        assert stage(spark, nothing, sf).count() == 0
