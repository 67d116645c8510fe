"""Open buckets of near-duplicate search: texts of one template, some of them similar."""

import random
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest

from segmill.llm import minhash


def template_texts(n, slots, values, length=140, seed=8):
    """One template with ``slots`` places that hold one of ``values`` words."""
    rng = random.Random(seed)
    base = [f"b{rng.randrange(400)}" for _ in range(length)]
    places = sorted(rng.sample(range(length), slots))
    rows = []
    for i in range(n):
        text = list(base)
        for p in places:
            text[p] = f"v{rng.randrange(values)}"
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("slots, values", [(5, 3), (9, 4), (12, 1000)])
def test_texts_of_one_template_equal_brute_force(spark, slots, values):
    rows = template_texts(160, slots, values)
    want = Counter((rows[i][0], c) for i, c in brute.classes(rows).items())
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter((r.doc_id, r.class_id) for r in got.collect()) == want


@pytest.mark.parametrize("block", [7, 1_024])
def test_pairs_of_open_buckets_are_all_pairs_that_may_be_similar(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(2)
    rows = []
    for bucket in range(6):
        base = [rng.randrange(4) for _ in range(minhash.CLASSES)]
        for node in rng.sample(range(100), 40 if bucket == 0 else 3):
            classes = [c + (rng.random() < 0.1) for c in base]
            rows.append((bucket, node, node % 30, sum(classes) + rng.randrange(5), sum(classes), classes))
    frame = spark.createDataFrame(
        rows, "bucket long, node long, component long, size long, common int, classes array<int>"
    )

    def similar(shares, p, q):
        return shares * 1000 >= (p[3] + q[3] - shares) * 800

    want = Counter(
        (p[1], q[1]) for p in rows for q in rows if p[0] == q[0] and p[1] < q[1] and p[2] != q[2]
        and similar(min(p[4], q[4]), p, q) and similar(sum(map(min, p[5], q[5])), p, q)
    )
    apart = minhash._apart(frame, 0.8)
    assert want and Counter((r.x, r.y) for r in apart.collect()) == want
    table = pa.Table.from_pylist([
        {"bucket": b, "a": 0, "b": 0, "block": 0, "node": n, "component": c, "size": s, "common": m, "classes": np.array(x)}
        for b, n, c, s, m, x in rows
    ])
    for length in (1, 11, len(rows)):  # groups spread over batches
        got = minhash._similar_pairs(iter(table.to_batches(length)), 0.8)
        assert Counter(pair for x in got for pair in zip(x["x"].to_pylist(), x["y"].to_pylist(), strict=True)) == want
