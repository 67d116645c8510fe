"""Hard negatives by angles to reference directions.

Every row stores its angles to a few reference directions.  By the triangle
inequality on the sphere, the angle between two rows is at least the largest
difference and at most the smallest sum of their angles to a reference.  Rows
are kept in windows (a reference's neighbourhood and a range of angles to it), so
the ranges of a window's angles and norms bound every score with it.  An anchor
is sent only to windows whose bounds overlap the scores it looks for; there, the
whole-number inner products are taken.

A bounded sample of rows gives the references, and scores that are certainly
reached, which tighten what an anchor looks for.  Both only save work.

Rows of a window come first in their task and anchors stream past them, so a
task holds a bounded part of a window and one batch of anchors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmill.llm.base import Scratch
from segmill.llm.vectors import finite, lists, longest, matrix, of_length

SAMPLE = 2_048        # rows that references and first bounds are taken from, by smallest hash of the id
REFERENCES = 16
BINS = 48             # of angles to the nearest reference
WINDOW_ROWS = 4_096   # neighbouring bins are one window up to so many rows
PART_ROWS = 16_384    # of a window in one task
BLOCK = 512           # anchors scored together
SLACK = 1e-7          # by which angles in double precision may be off
LARGEST = (1 << 63) - 1


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exactly, held within 64 bits."""
    bound = a.shape[1] * max(1, int(np.abs(a).max(initial=0))) * max(1, int(np.abs(b).max(initial=0)))
    if bound < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound <= LARGEST:
        return a @ b.T
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -LARGEST, LARGEST).astype(np.int64)


def polar(vectors: np.ndarray, references: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and angles to the references; a zero vector is at right angles to all."""
    vectors = vectors.astype(np.float64)
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    cosines = (vectors @ references.T) / np.maximum(norms, 1e-300)[:, None]
    return norms, np.arccos(np.clip(cosines, -1.0, 1.0))


def directions(vectors: np.ndarray, n: int) -> np.ndarray:
    """Unit vectors far from each other: each next one is the farthest from those before."""
    vectors = vectors[(vectors != 0).any(axis=1)].astype(np.float64)
    if not len(vectors):
        return np.zeros((1, vectors.shape[1]))
    unit = vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    chosen, nearest = [0], unit @ unit[0]
    while len(chosen) < min(n, len(unit)):
        k = int(nearest.argmin())
        if nearest[k] > 1 - 1e-9:
            break
        chosen.append(k)
        nearest = np.maximum(nearest, unit @ unit[k])
    return unit[chosen]


def score_bounds(
    norms: np.ndarray, angles: np.ndarray, low: np.ndarray, high: np.ndarray, least: np.ndarray, most: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """``[row, window]``: what no score of a row with a member of the window goes below or above.

    ``low``, ``high``: ranges of the windows' angles to the references; ``least``,
    ``most``: of their norms.  Rounded outwards.
    """
    own = angles[:, None, :]
    apart = np.maximum(np.maximum(low - own, own - high), 0).max(axis=2)
    widest = np.minimum(own + high, 2 * np.pi - own - low).min(axis=2)
    upper = np.cos(np.maximum(apart - SLACK, 0))
    lower = np.cos(np.minimum(widest + SLACK, np.pi))
    norms = norms[:, None]
    up = np.where(upper >= 0, upper * most, upper * least) * norms
    down = np.where(lower >= 0, lower * least, lower * most) * norms
    room = 1 + 1e-9 * norms * most
    return np.maximum(down - room, -9.2e18), np.minimum(up + room, 9.2e18)


class _Windows:
    """The windows' bounds and parts, and the sample; bounded by the parameters above."""

    def __init__(self, references, bounds, parts, sample_labels, sample_ids, sample):
        self.references, self.parts = references, parts
        self.low, self.high, self.least, self.most = bounds
        self.labels, self.ids, self.sample = sample_labels, sample_ids, sample

    def overlapping(self, vectors: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """``[row, window]``: whether a score from ``low`` to ``high`` (any of a row's) is possible."""
        norms, angles = polar(vectors, self.references)
        down, up = score_bounds(norms, angles, self.low, self.high, self.least, self.most)
        return ((low[:, :, None] <= up[:, None, :]) & (down[:, None, :] <= high[:, :, None])).any(axis=1)


def _chosen(
    score: np.ndarray, order: np.ndarray, fits: np.ndarray, low: np.ndarray, high: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """``(row, column)`` of each row's first ``k`` fitting columns with a score from ``low`` to ``high``."""
    ranked = np.take_along_axis(score, order, 1)
    good = np.take_along_axis(fits, order, 1) & (ranked >= low[:, None]) & (ranked <= high[:, None])
    good &= np.cumsum(good, axis=1) <= k
    row, at = np.nonzero(good)
    return row, order[row, at]


def _reached(
    windows: _Windows, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray,
    low: np.ndarray, high: np.ndarray, k: int, same: bool,
) -> np.ndarray:
    """``low``, raised to the ``k``-th best score in range that the sample has."""
    out = low.copy()
    if len(windows.ids):
        score = scores(vectors, windows.sample)
        fits = (labels[:, None] == windows.labels) == same
        fits &= ids[:, None] != windows.ids
        for b in range(low.shape[1]):
            good = fits & (score >= low[:, b, None]) & (score <= high[:, b, None])
            best = np.where(good, score, -LARGEST)
            if best.shape[1] >= k:
                kth = -np.partition(-best, k - 1, axis=1)[:, k - 1]
                out[:, b] = np.where(good.sum(axis=1) >= k, np.maximum(kth, out[:, b]), out[:, b])
    return out


_ASKED = "window int, part int, kind int, id long, label string, v array<long>, low array<long>, high array<long>"
_FOUND = "anchor_id long, band int, id long, score long"


def _route(batches: Iterator[pa.RecordBatch], windows: _Windows, d: int, k: int, same: bool) -> Iterator[pa.RecordBatch]:
    """Anchors with ranges of scores, once for each part of each window that may have them."""
    for batch in batches:
        for i in range(0, batch.num_rows, BLOCK):
            part = batch.slice(i, BLOCK)
            if not part.num_rows:
                continue
            vectors = matrix(part.column("v"), d)
            bands = len(part.column("low")[0])
            low, high = matrix(part.column("low"), bands), matrix(part.column("high"), bands)
            ids, labels = part.column("id").to_numpy(), np.array(part.column("label").to_pylist(), dtype=object)
            low = _reached(windows, ids, labels, vectors, low, high, k, same)
            # Rows with fewer ranges than others carry empty ones.
            row, window = np.nonzero(windows.overlapping(vectors, low, high))
            times = windows.parts[window]
            row, window = np.repeat(row, times), np.repeat(window, times)
            which = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            at = pa.array(row)
            take = lambda c: part.column(c).take(at)
            yield pa.RecordBatch.from_arrays([
                pa.array(window, pa.int32()), pa.array(which, pa.int32()), pa.array(np.ones(len(row)), pa.int32()),
                take("id"), take("label"), take("v"), lists(low[row], pa.int64()), take("high"),
            ], names=[c.split()[0] for c in _ASKED.split(", ")])


def _score(batches: Iterator[pa.RecordBatch], d: int, k: int, same: bool) -> Iterator[pa.RecordBatch]:
    """The first ``k`` rows of each anchor's ranges, in each part of a window.

    Rows arrive by (window, part), members before anchors, members by id.
    """
    key, held, ready = None, [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        windows, parts = batch.column("window").to_numpy(), batch.column("part").to_numpy()
        kinds = batch.column("kind").to_numpy()
        change = (np.diff(windows) != 0) | (np.diff(parts) != 0) | (np.diff(kinds) != 0)
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:], strict=False):
            rows = batch.slice(start, end - start)
            if (windows[start], parts[start]) != key:
                key, held, ready = (windows[start], parts[start]), [], None
            if kinds[start] == 0:
                held.append((rows.column("id").to_numpy(), rows.column("label").to_pylist(), matrix(rows.column("v"), d)))
                continue
            if ready is None:
                ready = (
                    np.concatenate([h[0] for h in held]), np.array([x for h in held for x in h[1]], dtype=object),
                    np.concatenate([h[2] for h in held]),
                ) if held else (np.zeros(0, np.int64), np.zeros(0, object), np.zeros((0, d), np.int64))
            for i in range(0, rows.num_rows, BLOCK):
                yield _scored(rows.slice(i, BLOCK), *ready, d, k, same)


def _scored(anchors: pa.RecordBatch, ids, labels, vectors, d: int, k: int, same: bool) -> pa.RecordBatch:
    bands = len(anchors.column("low")[0])
    low, high = matrix(anchors.column("low"), bands), matrix(anchors.column("high"), bands)
    own_ids, own_labels = anchors.column("id").to_numpy(), np.array(anchors.column("label").to_pylist(), dtype=object)
    score = scores(matrix(anchors.column("v"), d), vectors)
    fits = ((own_labels[:, None] == labels) == same) & (own_ids[:, None] != ids)
    # Members are by id, so a stable order breaks ties by id.
    order = np.argsort(-score, axis=1, kind="stable")
    found = []
    for b in range(bands):
        row, col = _chosen(score, order, fits, low[:, b], high[:, b], k)
        found.append((own_ids[row], np.full(len(row), b, np.int32), ids[col], score[row, col]))
    columns = [np.concatenate(x) for x in zip(*found, strict=True)]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()),
         pa.array(columns[3], pa.int64())], names=[c.split()[0] for c in _FOUND.split(", ")],
    )


def _search(anchors: DataFrame, stored: DataFrame, windows: _Windows, d: int, k: int, same: bool) -> DataFrame:
    """``(anchor_id, band, id, score, rank)``: the first ``k`` for each range of each anchor."""
    spark = stored.sparkSession
    asked = anchors.select("id", "label", "v", "low", "high").mapInArrow(
        lambda batches: _route(batches, windows, d, k, same), _ASKED
    )
    empty = F.array().cast("array<long>")
    members = stored.select("window", "part", F.lit(0).alias("kind"), "id", "label", "v", empty.alias("low"), empty.alias("high"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    met = members.unionByName(asked).repartition(parts, "window", "part").sortWithinPartitions(
        "window", "part", "kind", "id"
    )
    found = met.mapInArrow(lambda batches: _score(batches, d, k, same), _FOUND)
    best = Window.partitionBy("anchor_id", "band").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _store(rows: DataFrame, scratch: Scratch, d: int) -> tuple[DataFrame, _Windows]:
    """Rows with angles, norm, window and part; and what anchors are routed by."""
    spark = rows.sparkSession
    sample = rows.select("id", "label", "v").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow().combine_chunks()
    vectors = matrix(sample["v"], d)
    references = directions(vectors, REFERENCES)
    n = len(references)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            norms, angles = polar(matrix(batch.column("v"), d), references)
            cell = angles.argmin(axis=1) if len(angles) else np.zeros(0, np.int64)
            nearest = angles.min(axis=1) if len(angles) else np.zeros(0)
            bin_ = np.minimum(nearest / np.pi * BINS, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(norms), lists(angles, pa.float64()), pa.array(cell, pa.int32()), pa.array(bin_)],
                names=[*batch.schema.names, "norm", "angles", "cell", "bin"],
            )

    stored = scratch.put(
        rows.mapInArrow(measured, "id long, label string, v array<long>, norm double, angles array<double>, cell int, bin int"),
        "angles",
    )
    # At most REFERENCES x BINS counts.
    counts = sorted((r["cell"], r["bin"], r["count"]) for r in stored.groupBy("cell", "bin").count().collect())
    window, size, of, sizes = -1, 0, [], []
    for i, (cell, bin_, count) in enumerate(counts):
        if not i or cell != counts[i - 1][0] or size + count > WINDOW_ROWS:
            window, size = window + 1, 0
            sizes.append(0)
        size += count
        sizes[window] += count
        of.append((cell, bin_, window))
    parts = np.array([-(-s // PART_ROWS) for s in sizes], dtype=np.int64)
    places = spark.createDataFrame([(c, b, w, int(parts[w])) for c, b, w in of], "cell int, bin int, window int, parts int")
    stored = scratch.put(
        stored.join(F.broadcast(places), ["cell", "bin"])
        .withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
        .select("id", "label", "v", "window", "part", "norm", "angles"),
        "stored",
    )
    at = [F.element_at("angles", i + 1) for i in range(n)]
    ranges = stored.groupBy("window").agg(
        F.min("norm").alias("least"), F.max("norm").alias("most"),
        F.array(*[F.min(x) for x in at]).alias("low"), F.array(*[F.max(x) for x in at]).alias("high"),
    ).orderBy("window").collect()
    bounds = [np.array([r[c] for r in ranges], dtype=np.float64) for c in ("low", "high", "least", "most")]
    return stored, _Windows(
        references, bounds, parts, np.array(sample["label"].to_pylist(), dtype=object), sample["id"].to_numpy(), vectors
    )


def levels(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of every component; beyond 2^62 held there."""
    most = F.lit(float(1 << 62))
    return F.transform(vector, lambda x: F.floor(F.greatest(-most, F.least(most, x.cast("double") * scale))).cast("long"))


def mine(
    df: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90,
    scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``is_anchor`` is a condition on the id.  Components become ``floor(scale * x)``
    and a row's score is its inner product with the anchor, higher first, ties by
    smaller id.  An anchor's positives are its first rows of the same label; for
    each, its negatives are the first rows of other labels whose score is between
    ``least`` and ``most`` percent of the positive's (none for a negative one).

    Rows with a null id or label, and vectors that are null or hold null or
    non-finite components, take no part; zero vectors do, with scores of zero.
    Shorter vectors are extended by zeros.  Rows sharing an id count once, with the
    smallest label and vector.  Scores beyond 64 bits are held at their limits.
    An empty table has no rows.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "hardneg")
    rows = df.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).alias("vector"),
    ).where("id IS NOT NULL AND label IS NOT NULL").where(finite(F.col("vector")))
    d = longest(rows, "vector")
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not d:
        return spark.createDataFrame([], out)
    rows = rows.select("id", F.struct("label", of_length(levels(F.col("vector"), scale), d, F.lit(0).cast("long")).alias("v")).alias("row"))
    rows = scratch.put(rows.groupBy("id").agg(F.min("row").alias("row")).select("id", "row.label", "row.v"), "rows")
    stored, windows = _store(rows, scratch, d)
    scratch.keep_only("stored")
    anchors = stored.withColumnRenamed("id", id_col).where(is_anchor).withColumnRenamed(id_col, "id").select("id", "label", "v")
    whole = anchors.withColumn("low", F.array(F.lit(-LARGEST))).withColumn("high", F.array(F.lit(LARGEST)))
    near = scratch.put(
        _search(whole, stored, windows, d, positives, True)
        .select("anchor_id", "rank", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")),
        "positives",
    )

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # As many ranges for every anchor; those it lacks are empty.
        for batch in batches:
            found = batch.column("found").to_pylist()
            low = np.full((len(found), positives), LARGEST)
            high = np.full((len(found), positives), -LARGEST)
            for i, scores_ in enumerate(found):
                for rank, p in ((x["rank"], x["positive_score"]) for x in scores_):
                    low[i, rank - 1], high[i, rank - 1] = -(-least * p // 100), most * p // 100
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], lists(low, pa.int64()), lists(high, pa.int64())], names=["id", "label", "v", "low", "high"]
            )

    of = near.groupBy("anchor_id").agg(F.collect_list(F.struct("rank", "positive_score")).alias("found"))
    bound = anchors.join(of, F.col("id") == F.col("anchor_id")).select("id", "label", "v", "found").mapInArrow(
        ranges, "id long, label string, v array<long>, low array<long>, high array<long>"
    )
    hard = _search(bound, stored, windows, d, negatives, False).select(
        "anchor_id", (F.col("band") + 1).alias("nth"), F.col("rank"), F.col("id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    return hard.join(near.withColumnRenamed("rank", "nth"), ["anchor_id", "nth"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
