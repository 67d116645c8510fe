"""Repeated passages found by windows of doubling length.

A window of twice a length can only repeat if the windows inside it repeat, so
each level looks only at what survived the one before:

1. windows of half the wanted length.  Not every one is needed: from each
   full-length window the one inside it with the smallest hash stands for it,
   which equal windows choose alike.  About one word in ``half / 2`` starts one.
2. the chosen half windows that occur twice or more are extended: the full
   windows they stand for are hashed (128 bits), and the first occurrence of
   each is found.

Further levels work alike on windows of 2, 4, ... times the length, until no
window of a level repeats (``repeat_lengths``).

Only hashes and positions are shuffled at the first level.  All groupings are
aggregates with a partial step, so a passage that occurs in a third of all
documents is one row per task.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmill.llm import words as W
from segmill.llm.base import Scratch

WINDOW = 20

# Stands for a null id, and sorts before all others.
NO_ID = -(1 << 63)


def _standing(w: W.Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of full windows, the half window that stands for each, all half windows' hashes."""
    half = window // 2
    h = W.window_hashes(W.span_hashes(w.data, w.starts, w.ends), half)
    starts = np.flatnonzero(w.windows(window))
    if not len(starts):
        return starts, starts, h
    order = W.mix(h)
    smallest, at = order.copy(), np.arange(len(h))
    for k in range(1, half + 1):  # the leftmost of equal hashes wins
        other = W.shifted(order, k)
        less = other < smallest
        smallest[less] = other[less]
        at[less] = np.flatnonzero(less) + k
    return starts, at[starts], h


def _half_windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in W.chunks(batches, "text"):
        w = W.split(*W.flat(batch.column(batch.schema.get_field_index("text"))))
        _, standing, h = _standing(w, window)
        at = np.unique(standing)
        text = w.text_of[at]
        rows = batch.column(batch.schema.get_field_index("row")).to_numpy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(h[at].view(np.int64)), pa.array(rows[text]),
             pa.array((at - w.first[text]).astype(np.int32))],
            names=["h", "row", "pos"],
        )


def _flags(lists: pa.ListArray, first: np.ndarray, n: int) -> np.ndarray:
    """Flags of the words at each text's listed positions."""
    flags = np.zeros(n, dtype=bool)
    lists = lists.cast(pa.list_(pa.int32()))
    lengths = np.asarray(lists.value_lengths().fill_null(0))
    at = np.repeat(first[:-1], lengths) + lists.flatten().to_numpy(zero_copy_only=False)
    flags[at[at < np.repeat(first[1:], lengths)]] = True
    return flags


def _candidates(w: W.Words, repeated: np.ndarray, window: int) -> np.ndarray:
    """Starts of the full windows whose half window repeats."""
    starts, standing, _ = _standing(w, window)
    return starts[repeated[standing]]


def _full_windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in W.chunks(batches, "text"):
        get = lambda c: batch.column(batch.schema.get_field_index(c))
        w = W.split(*W.flat(get("text")))
        at = _candidates(w, _flags(get("repeated"), w.first, len(w.starts)), window)
        text = w.text_of[at]
        out = [
            W.window_hashes(W.span_hashes(w.data, w.starts, w.ends, family), window)[at].view(np.int64)
            for family in (0, 1)
        ]
        out += [get("id").to_numpy()[text], get("row").to_numpy()[text]]
        out.append((at - w.first[text]).astype(np.int32))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["a", "b", "id", "row", "pos"])


def _kept(batches: Iterator[pa.RecordBatch], window: int, names: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    for batch in W.chunks(batches, "text"):
        get = lambda c: batch.column(batch.schema.get_field_index(c))
        w = W.split(*W.flat(get("text")))
        n = len(w.starts)
        at = _candidates(w, _flags(get("repeated"), w.first, n), window)
        later = np.zeros(n, dtype=bool)
        later[at] = True
        later &= ~_flags(get("firsts"), w.first, n)
        steps = np.zeros(n + window + 1, dtype=np.int64)
        steps[:n] += later
        steps[window: n + window] -= later
        removed = np.cumsum(steps[:n]) > 0
        counts = w.per_text(removed)
        data = w.data.tobytes()
        kept = []
        for i in range(batch.num_rows):
            words = data[w.offsets[i]: w.offsets[i + 1]].split()
            if counts[i]:
                gone = removed[w.first[i]: w.first[i + 1]]
                words = [x for x, g in zip(words, gone.tolist(), strict=True) if not g]
            kept.append(b" ".join(words).decode())
        yield pa.RecordBatch.from_arrays(
            [*[get(c) for c in names], pa.array(w.counts.astype(np.int64)),
             pa.array(counts.astype(np.int64)), pa.array(kept, pa.string())],
            names=[*names, "n_words", "n_removed", "kept_text"],
        )


def remove_repeats(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """``(id, n_words, n_removed, kept_text)``: texts without words that stand in earlier windows.

    A word goes if it is covered by a window of ``window`` words (an even number)
    whose word sequence also starts earlier: in a text of smaller id, or earlier
    in the same text.  Windows are judged on the input.  ``kept_text`` has the
    other words, joined by one space.

    Null texts have no words.  A null id counts as smaller than all others.  Rows
    that share an id are in the order of their texts' hash; rows alike in both
    count as one text and are treated alike.  Other columns are not looked at.
    Runs two jobs when called; the last pass is lazy.
    """
    if window < 2 or window % 2:
        raise ValueError("window must be an even number of words")
    scratch = Scratch(df.sparkSession, "substrings")
    ids = F.col(id_col).cast("long")
    docs = df.select(
        ids.alias("given"), F.coalesce(ids, F.lit(NO_ID)).alias("id"),
        F.xxhash64(ids, F.col(text_col)).alias("row"), F.col(text_col).alias("text"),
    )
    half = scratch.put(
        docs.select("row", "text").mapInArrow(lambda it: _half_windows(it, window), "h long, row long, pos int"),
        "half",
    )
    # Written out, so that the join below has two plain shuffles, of which a
    # very frequent window's is split.
    again = scratch.put(
        half.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "again"
    )
    survivors = half.join(again, "h").groupBy("row").agg(F.sort_array(F.collect_set("pos")).alias("repeated"))
    repeated = scratch.put(survivors, "repeated")
    scratch.drop("half", "again")
    # Firsts of all windows looked at, unrepeated ones too: what is not a first is later.
    found = docs.select("id", "row", "text").join(repeated, "row").mapInArrow(
        lambda it: _full_windows(it, window), "a long, b long, id long, row long, pos int"
    )
    firsts = (
        found.groupBy("a", "b").agg(F.min(F.struct("id", "row", "pos")).alias("first"))
        .groupBy(F.col("first.row").alias("row"), F.col("first.id").alias("of"))
        .agg(F.collect_list("first.pos").alias("firsts"))
    )
    marks = scratch.put(repeated.join(firsts, "row", "left"), "marks")
    own = (docs["row"] == marks["row"]) & (F.coalesce(marks["of"], docs["id"]) == docs["id"])
    marked = docs.join(marks, own, "left").select(
        F.col("given").alias(id_col), "text",
        *[F.coalesce(c, F.array().cast("array<int>")).alias(c) for c in ("repeated", "firsts")],
    )
    return marked.mapInArrow(
        lambda it: _kept(it, window, (id_col,)),
        f"`{id_col}` long, n_words long, n_removed long, kept_text string",
    )


def repeat_lengths(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``(length, n_windows)``: how many different windows repeat at each doubled length.

    Starts from ``window`` and doubles until no window of a level repeats, which the
    longest text bounds.  Each level reads only the texts that had a repeated window
    at the one before.  Null, empty and short texts have no windows; rows alike in id
    and text count as often as they are there; an empty table gives no rows.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "repeat-lengths")
    docs = df.select(F.xxhash64(F.col(id_col).cast("long"), F.col(text_col)).alias("row"), F.col(text_col).alias("text"))
    found = []
    length = window
    for level in itertools.count():
        n = length
        wins = scratch.put(docs.mapInArrow(lambda it, n=n: _all_windows(it, n), "h long, row long"), f"wins-{level}")
        again = wins.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
        repeated = scratch.put(again, f"again-{level}")
        count = repeated.count()
        if not count:
            break
        found.append((length, count))
        rows = scratch.put(wins.join(repeated, "h", "left_semi").select("row").distinct(), f"rows-{level}")
        scratch.drop(f"wins-{level}")
        docs = docs.join(rows, "row", "left_semi")
        length *= 2
    return spark.createDataFrame(found, "length int, n_windows long")


def _all_windows(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in W.chunks(batches, "text"):
        w = W.split(*W.flat(batch.column(batch.schema.get_field_index("text"))))
        at = np.flatnonzero(w.windows(n))
        h = W.window_hashes(W.span_hashes(w.data, w.starts, w.ends), n)[at]
        rows = batch.column(batch.schema.get_field_index("row")).to_numpy()[w.text_of[at]]
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(rows)], names=["h", "row"])
