"""Toxicity by a weighted lexicon.

Texts are folded (case, homoglyphs, digits and signs that stand for letters), an
Aho-Corasick automaton finds the lexicon's words and stems in one pass over the
whole text, hits inside exception phrases do not count, and the summed weights,
normalised by length, give a score.  Accents tell words apart in many languages
and stay; only marks written apart from their letter are dropped.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmill.llm import words as W
from segmill.llm.base import Scratch, spelled
from segmill.llm.training import fit_logistic, labelled_sample

# Documents that are learned from, at most.  What they hold bounds the lexicon.
SAMPLE_ROWS = 10_000
MIN_TEXTS = 2
MIN_WEIGHT = 1.0
STRONG = 0.8

# Letters of other alphabets that look like Latin ones.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ғ": "f", "ɡ": "g", "һ": "h", "і": "i", "ј": "j",
    "к": "k", "ӏ": "l", "м": "m", "п": "n", "о": "o", "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t",
    "ц": "u", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y", "ᴢ": "z",
    "α": "a", "β": "b", "ϲ": "c", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "σ": "o", "τ": "t", "υ": "u", "χ": "x", "γ": "y", "ω": "w", "ı": "i", "ł": "l", "ø": "o", "đ": "d",
    "ß": "ss", "æ": "ae", "œ": "oe",
}
# 1, ! and | stand for i as well as for l, so l folds to i everywhere.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "l": "i"}
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i", "€": "e", "£": "i"}
INVISIBLE = dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, *range(0x300, 0x370)])

_FOLD = {ord(k): v.replace("l", "i") for k, v in (DIGITS | HOMOGLYPHS).items()} | INVISIBLE
# A sign stands for a letter only before a letter, at a word's start or inside it.
_SIGN = re.compile(r"(?:(?<=[^\W_])|(?<![^\s]))[@$!|€£](?=[^\W_])")
_WORD = re.compile(r"[^\W_]+")
_HIDDEN = re.compile("[@$!|€£]")

# Stems are written with this mark and match the beginnings of words.
STEM = "*"
STEM_LENGTHS = range(4, 10)


def fold(text: str) -> str:
    """The text as the lexicon sees it."""
    if _HIDDEN.search(text):
        text = _SIGN.sub(lambda m: SIGNS[m[0]], text)
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    return text.translate(_FOLD)


@dataclass(frozen=True)
class Lexicon:
    """Folded words with weights, folded phrases that excuse them, and the score's weights."""

    words: Mapping[str, float]
    exceptions: Sequence[str] = ()
    score: Sequence[float] = (0.0, 0.0, 0.0, 0.0)

    def automaton(self):
        found = ahocorasick.Automaton()
        entries: dict[str, dict] = {}
        for word, weight in self.words.items():
            letters = word.removesuffix(STEM)
            entries.setdefault(letters, {})["stem" if word != letters else "word"] = weight
        for phrase in self.exceptions:
            entries.setdefault(phrase, {})["excuse"] = 0.0
        for letters, kinds in entries.items():
            found.add_word(letters, (len(letters), kinds.get("word"), kinds.get("stem"), "excuse" in kinds))
        if len(found):
            found.make_automaton()
        return found


def _hits(automaton, folded: str) -> list[float]:
    """Weights of the words that are in the lexicon or begin with a stem of it.

    A word counts once, with its largest weight, and not inside an exception.
    """
    if not len(automaton):
        return []
    n, found, excused = len(folded), {}, []
    for end, (length, word, stem, excuse) in automaton.iter(folded):
        start = end - length + 1
        if start and folded[start - 1].isalnum():
            continue
        ends = end + 1 == n or not folded[end + 1].isalnum()
        if excuse and ends:
            excused.append((start, end))
        weights = [w for w in (word if ends else None, stem) if w is not None]
        if weights:
            found[start] = max(*weights, found.get(start, 0.0))
    if excused:
        # Up to each place, the farthest end of an exception that begins there or before.
        excused.sort()
        starts = [a for a, _ in excused]
        reach = list(accumulate((b for _, b in excused), max))
        found = {s: w for s, w in found.items() if not ((k := bisect_right(starts, s)) and reach[k - 1] >= s)}
    return list(found.values())


def features(automaton, text: str, n_words: int) -> tuple[float, float, float]:
    """Strongest hit; summed weight; summed weight over the length's root (all damped)."""
    hits = _hits(automaton, fold(text))
    if not hits:
        return 0.0, 0.0, 0.0
    total = sum(hits)
    return max(hits), float(np.log1p(total)), total / np.sqrt(max(1, n_words))


def _measure(batches: Iterator[pa.RecordBatch], lexicon: Lexicon, names: Sequence[str]) -> Iterator[pa.RecordBatch]:
    automaton = lexicon.automaton()
    for batch in W.chunks(batches, "text"):
        column = batch.column(batch.schema.get_field_index("text"))
        n_words = W.split(*W.flat(column)).counts
        rows = [features(automaton, t, n) for t, n in zip(column.to_pylist(), n_words.tolist(), strict=True)]
        values = np.array(rows, dtype=np.float64).reshape(len(rows), 3)
        out = [batch.column(batch.schema.get_field_index(c)) for c in names]
        yield pa.RecordBatch.from_arrays(
            [*out, *[pa.array(values[:, k]) for k in range(3)]], names=[*names, "strongest", "total", "density"]
        )


_FEATURES = "strongest double, total double, density double"


def tokens(folded: str) -> set[str]:
    """The text's words and stems."""
    own = set(_WORD.findall(folded))
    return own | {w[:k] + STEM for w in own for k in STEM_LENGTHS if k < len(w)}


def _pairs(folded: str, known: frozenset[str]) -> set[str]:
    """The text's word pairs that hold a word or stem of the lexicon."""
    words = _WORD.findall(folded)
    hit = [w in known or any(w[:k] + STEM in known for k in STEM_LENGTHS if k < len(w)) for w in words]
    return {f"{a} {b}" for a, b, x, y in zip(words, words[1:], hit, hit[1:], strict=False) if x or y}


def _counts(batches: Iterator[pa.RecordBatch], find) -> Iterator[pa.RecordBatch]:
    """``(token, p, n)``: toxic and other texts with each token, per piece of input."""
    for batch in W.chunks(batches, "text"):
        get = lambda c: batch.column(batch.schema.get_field_index(c)).to_pylist()
        counts: dict[str, list[int]] = {}
        for text, label in zip(get("text"), get("label"), strict=True):
            for token in find(fold(text)):
                counts.setdefault(token, [0, 0])[0 if label else 1] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), *[pa.array([c[k] for c in counts.values()], pa.int64()) for k in (0, 1)]],
            names=["token", "p", "n"],
        )


def _where(batches: Iterator[pa.RecordBatch], known: frozenset[str]) -> Iterator[pa.RecordBatch]:
    """``(id, tokens)``: which of the known tokens each text has."""
    for batch in W.chunks(batches, "text"):
        get = lambda c: batch.column(batch.schema.get_field_index(c))
        own = [sorted(tokens(fold(t)) & known) for t in get("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([get("id"), pa.array(own, pa.list_(pa.string()))], names=["id", "tokens"])


def weight(p: float, n: float, positives: int, negatives: int) -> float:
    """Log odds of toxic against other texts, less its standard error (times 1.64)."""
    odds = np.log((p + 0.5) / (positives + 1)) - np.log((n + 0.5) / (negatives + 1))
    return float(odds - 1.64 * np.sqrt(1 / (p + 0.5) + 1 / (n + 0.5)))


def cover(texts: Sequence[Sequence[str]], others: Mapping[str, int], positives: int, negatives: int) -> dict[str, float]:
    """Words and stems by sequential covering of the toxic texts.

    ``texts``: the candidates each toxic text has; ``others``: other texts with
    each.  Candidates about as strong as the strongest are all taken, but for stems
    that stand for one word taken already.  Then the strongest of the others is
    taken again and again; the texts explained no longer speak for others, so
    candidates that merely share those texts find no support.  A chosen one weighs
    what all texts say of it.
    """
    left: dict[str, set[int]] = {}
    for i, own in enumerate(texts):
        for token in own:
            left.setdefault(token, set()).add(i)
    full = {t: len(ids) for t, ids in left.items()}
    weights = {t: weight(full[t], others[t], positives, negatives) for t in full}
    strong = sorted(
        (t for t, w in weights.items() if w >= max(MIN_WEIGHT, STRONG * max(weights.values()))),
        key=lambda t: (t.endswith(STEM), -weights[t], t),
    )
    out: dict[str, float] = {}
    for token in strong:
        stem = token.removesuffix(STEM)
        if not any(t.startswith(stem) and full[t] >= 0.9 * full[token] for t in out):
            out[token] = weights[token]
    explained = {i for t in out for i in left[t]}
    left = {t: rest for t, ids in left.items() if t not in out and len(rest := ids - explained) >= MIN_TEXTS}
    while left:
        best, token = max((weight(len(ids), others[t], positives, negatives), t) for t, ids in left.items())
        if best < MIN_WEIGHT:
            break
        explained = left.pop(token)
        out[token] = weights[token]
        left = {t: rest for t, ids in left.items() if len(rest := ids - explained) >= MIN_TEXTS}
    return out


def learn(
    docs: DataFrame, labels: DataFrame, where: Column, label: str = "toxic",
    rows: int = SAMPLE_ROWS, exceptions: Sequence[str] = (), id_col: str = "doc_id", text_col: str = "text",
) -> Lexicon:
    """Lexicon, exception phrases and score from at most ``rows`` labelled documents.

    The driver gets the counts of words that speak for the label, those of each
    sampled toxic document, and three numbers per sampled document: all bounded by
    the sample.  Rows sharing an id count once.  Without toxic examples the lexicon
    is empty and every text scores low.
    """
    scratch = Scratch(docs.sparkSession, "toxicity")
    sample = labelled_sample(docs, labels, label, rows, where, scratch, id_col, text_col)
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    positives, negatives = sizes.get(1, 0), sizes.get(0, 0)
    if not positives:
        return Lexicon({}, [fold(e) for e in exceptions], (0.0, 0.0, 0.0, -3.0))
    p, n = F.col("p"), F.col("n")
    odds = F.log((p + 0.5) / (positives + 1)) - F.log((n + 0.5) / (negatives + 1))
    bound = odds - 1.64 * F.sqrt(1 / (p + 0.5) + 1 / (n + 0.5))
    counted = sample.select("text", "label").mapInArrow(lambda it: _counts(it, tokens), "token string, p long, n long")
    candidates = (
        counted.groupBy("token").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
        .withColumn("bound", bound).where((p >= MIN_TEXTS) & (F.col("bound") >= MIN_WEIGHT))
    )
    others = {r["token"]: r["n"] for r in candidates.collect()}
    known = frozenset(others)
    toxic = sample.where("label = 1").select("id", "text").mapInArrow(
        lambda it: _where(it, known), f"id {sample.schema['id'].dataType.simpleString()}, tokens array<string>"
    )
    chosen = cover([r["tokens"] for r in toxic.orderBy("id").collect()], others, positives, negatives)

    around = frozenset(chosen)
    innocent = (
        sample.select("text", "label").mapInArrow(
            lambda it: _counts(it, lambda t: _pairs(t, around)), "token string, p long, n long"
        )
        .groupBy("token").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
        .where((n >= 5) & (p * negatives < n * positives))
    )
    excused = sorted(r["token"] for r in innocent.collect()) + [fold(e) for e in exceptions]
    lexicon = Lexicon(chosen, excused)
    measured = sample.select("text", "label").mapInArrow(
        lambda it: _measure(it, lexicon, ("label",)), f"label int, {_FEATURES}"
    ).toPandas().sort_values(["label", "strongest", "total", "density"])
    scratch.keep_only()
    fitted = fit_logistic(measured[["strongest", "total", "density"]].to_numpy(), measured["label"].to_numpy())
    return Lexicon(chosen, excused, tuple(float(x) for x in fitted))


def score(df: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score)`` with a score from 0 to 1 for every text, null and empty ones too.

    One pass, no shuffle; the lexicon goes to the tasks with the function.  Null
    counts as empty and scores as a text without hits.  Repeated rows stay.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        lambda it: _measure(it, lexicon, ("id",)), f"id {df.schema[spelled(df, id_col)].dataType.simpleString()}, {_FEATURES}"
    )
    a, b, c, d = (F.lit(float(x)) for x in lexicon.score)
    logit = a * F.col("strongest") + b * F.col("total") + c * F.col("density") + d
    return rows.select(F.col("id").alias(id_col), (1 / (1 + F.exp(-logit))).alias("score"))
