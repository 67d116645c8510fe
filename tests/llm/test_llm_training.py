"""Bounded samples, the prior without negatives, and the lexicon's matcher against a naive one."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from segmill.llm import quality, toxicity, training
from segmill.llm.base import Scratch


def test_samples_count_an_id_once(spark):
    """A repeated id, with many texts and labels, is one row of a sample."""
    docs = spark.range(3000).select(
        F.when(F.col("id") < 2000, 7).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("Text")
    ).union(spark.createDataFrame([(None, "x"), (9000, None)], "doc_id long, Text string")).repartition(5)
    labels = docs.select("doc_id", (F.crc32("Text") % 2).cast("int").alias("quality"))
    scratch = Scratch(spark, "test")
    for rows in (3, 500, 5000):
        got = training.labelled_sample(docs, labels, "quality", rows, F.lit(True), Scratch(spark, "s")).collect()
        assert len(got) == len({r.id for r in got}) == min(rows, 1001) and all(r.id is not None for r in got)  # 9000 has no label
        web = training.unlabelled_sample(docs, rows, F.lit(True), Scratch(spark, "w")).collect()
        assert len(web) == len({r.id for r in web}) == min(rows, 1002)
    again = training.labelled_sample(docs.repartition(2), labels, "quality", 500, F.lit(True), Scratch(spark, "s"))
    first = training.labelled_sample(docs, labels, "quality", 500, F.lit(True), Scratch(spark, "s"))
    assert again.exceptAll(first).isEmpty() and first.exceptAll(again).isEmpty()
    assert training.labelled_sample(docs, labels, "quality", 5, F.lit(False), scratch).count() == 0


@pytest.mark.parametrize("share", [0.1, 0.35, 0.6, 0.9])
def test_the_prior_of_a_known_mixture(share):
    rng = np.random.default_rng(4)
    good = lambda n: rng.normal(0, 1, (n, 5)) + [1.5, 0, 0, 1.5, 0]
    bad = lambda n: rng.normal(0, 1, (n, 5)) - [1.5, 0, 0, 1.5, 0]
    web = np.vstack([good(int(6000 * share)), bad(6000 - int(6000 * share))])
    assert abs(training.mixture_share(good(4000), web) - share) < 0.06


def test_the_risk_never_pays_for_what_it_has_seen():
    """On a small sample the non-negative risk does not call every unlabelled text bad."""
    rng = np.random.default_rng(5)
    good, web = rng.normal(1, 1, (60, 4)), np.vstack([rng.normal(1, 1, (60, 4)), rng.normal(-1, 1, (60, 4))])
    model = quality.fit(good, web, 0.5)
    test = np.vstack([rng.normal(1, 1, (500, 4)), rng.normal(-1, 1, (500, 4))])
    called = model.logits(test) >= 0
    assert called[:500].mean() > 0.85 and called[500:].mean() < 0.15


def naive_hits(words, phrases, folded):
    """Weights by word, without an automaton."""
    out = {}
    spans = [(a, a + len(p)) for p in phrases for a, _ in
             [m.span() for m in re.finditer(rf"(?<![^\W_])(?={re.escape(p)}(?![^\W_]))", folded)]]
    for m in re.finditer(r"[^\W_]+", folded):
        best = [w for t, w in words.items() if m[0] == t or (t.endswith("*") and m[0].startswith(t[:-1]))]
        if best and not any(a <= m.start() < b for a, b in spans):
            out[m.start()] = max(best)
    return sorted(out.values())


def test_hits_equal_a_naive_matcher():
    rng = random.Random(6)
    words = {"ab": 1.0, "abc": 2.0, "ab*": 0.5, "bca*": 1.5, "cc": 3.0}
    phrases = ["ab cc", "cc ab", "bca x", "a"]
    automaton = toxicity.Lexicon(words, phrases).automaton()
    for _ in range(600):
        text = " ".join("".join(rng.choice("abcx") for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(0, 25)))
        assert sorted(toxicity._hits(automaton, text)) == naive_hits(words, phrases, text)


def test_a_long_text_full_of_exceptions_is_quick():
    automaton = toxicity.Lexicon({"bad": 1.0}, ["not bad"]).automaton()
    assert toxicity._hits(automaton, "not bad " * 60_000 + "bad") == [1.0]
