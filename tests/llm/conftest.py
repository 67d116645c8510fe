from __future__ import annotations

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row string, id string"


def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows, near copies, shared lines and passages."""
    rng = random.Random(4)
    words = ["alpha", "beta", "gamma", "delta", "épsilon", "zeta", "eta", "theta", "iota", "kappa", "λ", "x1"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = text(120).split(" ")
    passage, line = text(45), "This work may be copied under the terms of the licence named below."
    rows = [(None, None), (None, text(30)), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two three")]
    rows += [(6, " ".join(base)), (7, "  ".join(base)), (8, " ".join(base)), (8, " ".join(base))]
    for i in range(12):
        near = list(base)
        near[rng.randrange(len(near))] = f"w{i}"
        rows.append((10 + i, " ".join(near)))
    rows += [(30 + i, f"{text(40 + i)}\n{passage}\n{line}\n{text(9)}") for i in range(8)]
    rows += [(40 + i, f"order {i * 7919} shipped to depot {i} on time today\n{text(25 + i)}") for i in range(8)]
    rows += [(50, text(6000)), (51, "a" * 30_000), (52, "same line here\n" * 40), (53, "%%% ### $$$ " * 30)]
    rows += [(54, "you st​upid 1d1ot and mor0n " + text(20)), (9, text(60)), (9, text(61))]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    rows = [
        (d, t, None if i % 5 == 0 else "en", None if i % 7 == 0 else f"s{i % 3}", len(t or ""), "x", "y")
        for i, (d, t) in enumerate(odd_rows())
    ]
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)
