"""Quality rules as a bitmask ledger.

Every rule is evaluated once.  The ledger keeps the measurements and one bit per
failed rule; policies are versioned sets of bits, and applying one or finding
out what a rule contributes needs nothing but bit operations on the ledger.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmill.llm import words as W
from segmill.llm.base import spelled

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True

REPEAT_WINDOW = 5

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters",
)
_SCHEMA = ", ".join(f"{m} long" for m in MEASURES)


@dataclass(frozen=True)
class Rule:
    """A failure condition over the measurements, at a fixed bit of the mask."""

    name: str
    bit: int
    fails: str


# Ratios are written as products, so that they are exact.  A bit never changes
# its meaning: a changed rule gets a new bit.
RULES = (
    Rule("too_few_words", 0, "n_words < 10"),
    Rule("repeated_windows", 1, "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", 2, "10 * n_symbols > n_words"),
    Rule("short_words", 3, "word_chars < 2 * n_words"),
    Rule("long_words", 4, "word_chars > 12 * n_words"),
    Rule("duplicate_lines", 5, "n_lines >= 4 and 10 * n_dup_lines > 3 * n_lines"),
    Rule("few_letters", 6, "2 * n_letters < word_chars"),
)


@dataclass(frozen=True)
class Policy:
    """A version's set of rules; a text is kept if it fails none of them."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        bits = {r.name: r.bit for r in RULES}
        return sum(1 << bits[name] for name in self.rules)


BASE = Policy("base", ("too_few_words", "repeated_windows"))
POLICIES: Mapping[str, Policy] = {
    p.version: p
    for p in (
        BASE,
        Policy("v1", (*BASE.rules, "symbols")),
        Policy("v2", tuple(r.name for r in RULES)),
    )
}


def measure(batches: Iterator[pa.RecordBatch], text: str, names: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    for batch in W.chunks(batches, text):
        data, offsets = W.flat(batch.column(batch.schema.get_field_index(text)))
        w = W.split(data, offsets)
        spread = W.counted((data & 0xC0 == 0x80), offsets)  # bytes beyond each code point's first
        n_chars = np.diff(offsets) - spread
        separators = W.counted(W.SEPARATOR[data], offsets)
        ascii_rest = W.counted(
            (data < 128) & ~W.SEPARATOR[data] & ~(((data | 32) >= 97) & ((data | 32) <= 122)), offsets
        )
        n_lines, dup_lines = _lines(data, offsets, w)
        values = {
            "n_words": w.counts, "word_chars": n_chars - separators,
            "n_symbols": W.counted(SYMBOLS[data], offsets),
            "n_dup_lines": dup_lines, "n_repeat_words": _repeats(w), "n_lines": n_lines,
            "n_letters": n_chars - separators - ascii_rest,
        }
        kept = [batch.column(batch.schema.get_field_index(n)) for n in names]
        out = kept + [pa.array(values[m].astype(np.int64)) for m in MEASURES]
        yield pa.RecordBatch.from_arrays(out, names=[*names, *MEASURES])


def _own(h: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The hashes made different for each text."""
    return W.joined(h, W.mix(text.astype(np.uint64) + np.uint64(1)))


def _repeats(w: W.Words) -> np.ndarray:
    """Words of each text inside a window that occurs twice or more in the text."""
    valid = np.flatnonzero(w.windows(REPEAT_WINDOW))
    h = W.window_hashes(W.span_hashes(w.data, w.starts, w.ends), REPEAT_WINDOW)[valid]
    h = _own(h, w.text_of[valid])
    order = np.argsort(h)
    same = h[order][1:] == h[order][:-1]
    twice = np.zeros(len(h), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(w.starts) + 1, dtype=np.int64)
    at = valid[twice]
    covered[at] += 1
    covered[at + REPEAT_WINDOW] -= 1
    return w.per_text(np.cumsum(covered[:-1]) > 0)


def _lines(data: np.ndarray, offsets: np.ndarray, w: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word in each text, and how many of them equal an earlier one."""
    starts, ends, first = W.lines(data, offsets)
    with_word = np.searchsorted(w.starts, starts) < np.searchsorted(w.starts, ends)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    n = W.counted(with_word, first)
    h = _own(W.span_hashes(data, starts, ends)[with_word], text[with_word])
    _, distinct = np.unique(h, return_index=True)
    firsts = np.bincount(text[with_word][distinct], minlength=len(n))
    return n, n - firsts


def ledger(df: DataFrame, text: str, mask: str = "failed_rules") -> DataFrame:
    """``df`` with the measurements and the mask of failed rules instead of ``text``.

    One pass, no shuffle.  A null text counts as empty: it has no words and fails
    ``too_few_words`` only.  Columns named like a measurement are replaced.
    """
    text = spelled(df, text)
    replaced = {n.lower() for n in (text, mask, *MEASURES)}
    names = tuple(c for c in df.columns if c.lower() not in replaced)
    source = df.select(*names, text)
    fields = [f"`{n}` {source.schema[n].dataType.simpleString()}" for n in names]
    measured = source.mapInArrow(lambda it: measure(it, text, names), ", ".join([*fields, _SCHEMA]))
    bits = F.lit(0).cast("long")
    for rule in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn(mask, bits)


def passes(policy: Policy, mask: str = "failed_rules") -> Column:
    """Whether a ledger row fails none of the policy's rules."""
    return F.col(mask).bitwiseAND(F.lit(policy.mask)) == 0


def ablations(rows: DataFrame, policy: Policy, mask: str = "failed_rules") -> DataFrame:
    """Per rule of the policy: texts that fail it, and texts that fail nothing else.

    The second number is what dropping the rule would let through.  Counts per
    distinct mask come first (at most 2 ** rules of them).
    """
    used = F.col(mask).bitwiseAND(F.lit(policy.mask)).alias("m")
    counts = rows.groupBy(used).agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit"))
        for r in RULES if r.name in policy.rules
    ])
    return (
        counts.select("m", "n", F.explode(rules).alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.col("m").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("m") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_failed_alone"),
        )
    )
