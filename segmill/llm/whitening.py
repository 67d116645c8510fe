"""Whitening of embeddings: components of the exact covariance by contour integration.

Components become whole numbers first, so that sums and products over any number
of rows are exact and do not depend on their order.  Tasks send sums (a row per
pair of dimensions), never rows; the driver solves a problem as wide as a vector.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmill.llm import feast
from segmill.llm.base import Scratch, spelled
from segmill.llm.vectors import finite, lists, longest, matrix, of_length

STEPS = 64        # levels to a unit
LIMIT = 1 << 45   # levels beyond are held at it
HALF = 23         # bits of the lower part where products would not be exact
LOW = 32          # bits of the lower part of a sum sent to the driver
INT64 = 1 << 63


def levels(vector: Column) -> Column:
    """``floor(64 x)`` of every component; beyond 2^45 held there."""
    return F.transform(vector, lambda x: F.floor(
        F.greatest(F.lit(-float(LIMIT)), F.least(F.lit(float(LIMIT)), x.cast("double") * STEPS))
    ).cast("long"))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a.T @ b`` of whole numbers, exactly, as Python integers."""
    out = np.zeros((a.shape[1], b.shape[1]), dtype=object)
    bound = max(1, int(np.abs(a).max(initial=0))) * max(1, int(np.abs(b).max(initial=0)))
    rows = max(1, (1 << 53) // bound)
    for i in range(0, len(a), rows):
        part = a[i: i + rows].astype(np.float64).T @ b[i: i + rows].astype(np.float64)
        out += part.astype(np.int64).astype(object)
    return out


def gram(y: np.ndarray) -> np.ndarray:
    """``y.T @ y`` of whole numbers up to 2^46, exactly, as Python integers."""
    if int(np.abs(y).max(initial=0)) < 1 << 26:
        return _products(y, y)
    high, low = y >> HALF, y & ((1 << HALF) - 1)
    mixed = _products(high, low)
    return (_products(high, high) << (2 * HALF)) + ((mixed + mixed.T) << HALF) + _products(low, low)


def _sums(df: DataFrame, of: Callable[[pa.RecordBatch], np.ndarray], wide: int) -> np.ndarray:
    """The sum over all batches of a matrix of Python integers with ``wide`` columns, exactly.

    Every task sends one row for each entry that is not zero; Spark adds them up.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            if batch.num_rows:
                total = total + of(batch)
        flat = np.asarray(total, dtype=object).reshape(-1)
        at = np.array([i for i, v in enumerate(flat) if v], dtype=np.int64)
        high = pa.array([int(flat[i]) >> LOW for i in at], pa.int64())
        low = pa.array([int(flat[i]) & ((1 << LOW) - 1) for i in at], pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(at), high, low], names=["at", "high", "low"])

    sums = df.mapInArrow(partial, "at long, high long, low long").groupBy("at").agg(
        F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low")
    )
    rows = sums.collect()
    out = np.zeros((-(-(max((r["at"] for r in rows), default=-1) + 1) // wide), wide), dtype=object)
    for r in rows:
        out[r["at"] // wide, r["at"] % wide] = (int(r["high"]) << LOW) + int(r["low"])
    return out


def _at_least(total: np.ndarray, rows: int) -> np.ndarray:
    """Rows of zeros that no task sent."""
    return np.vstack([total, np.zeros((rows - len(total), total.shape[1]), dtype=object)])


def _ratio(a: int, b: int) -> float:
    """``a / b``, rounded once."""
    return a / b


class Whitening:
    """What is learned from the distinct vectors of levels.

    ``n`` vectors; ``center`` and ``rest``: the sums are ``n * center + rest``,
    with ``center`` the rounded mean; ``covariance``; ``values`` and ``vectors``:
    eigenvalues, falling, and unit eigenvectors as columns; ``trace``.
    """

    def __init__(self, fit: DataFrame, d: int, k: int):
        first = _at_least(_sums(fit, lambda b: np.concatenate(
            [_products(np.ones((b.num_rows, 1), np.int64), matrix(b.column("y"), d)), [[b.num_rows]]], axis=1
        ), d + 1), 1)[0]
        self.n, sums = int(first[d]), first[:d]
        self.center = np.array([round(int(s) / self.n) if abs(s) < 1 << 52 else int(s) // self.n for s in sums], np.int64)
        self.rest = np.array([int(s) - self.n * int(c) for s, c in zip(sums, self.center, strict=True)], dtype=object)
        center = self.center
        squares = _at_least(_sums(fit, lambda b: gram(matrix(b.column("y"), d) - center), d), d)
        # n^2 times the covariance, exactly; one rounding.
        exact = self.n * squares - np.multiply.outer(self.rest, self.rest)
        over = np.frompyfunc(lambda x: _ratio(int(x), self.n * self.n), 1, 1)
        self.covariance = over(exact).astype(np.float64)
        self.trace = _ratio(int(exact.trace()), self.n * self.n)
        self.values, self.vectors = feast.largest(self.covariance, k)
        self.weights = self.vectors / np.sqrt(self.values)
        self.mean = over(self.rest * self.n).astype(np.float64)

    def whitened(self, y: np.ndarray) -> np.ndarray:
        return ((y - self.center) - self.mean) @ self.weights

    def deviations(self, y: np.ndarray) -> pa.Array:
        """The exact squares of ``n x - S``, summed; null beyond 64 bits."""
        off = y - self.center
        bound = self.n * int(np.abs(off).max(initial=0)) + max((abs(r) for r in self.rest), default=0)
        if y.shape[1] * bound * bound < INT64:
            off = off * self.n - self.rest.astype(np.int64)
            return pa.array((off * off).sum(axis=1), pa.int64())
        wide = ((off.astype(object) * self.n - self.rest) ** 2).sum(axis=1)
        return pa.array([int(v) if v < INT64 else None for v in wide], pa.int64())


def _identity_error(fit: DataFrame, model: Whitening, d: int) -> float:
    """The largest entry of the covariance of the whitened fit list, minus the identity."""
    k = len(model.values)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            z = model.whitened(matrix(batch.column("y"), d))
            total[:k] += z.T @ z
            total[k] += z.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.reshape(-1))], names=["at", "v"])

    rows = fit.mapInArrow(partial, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    total = np.zeros((k + 1) * k)
    for r in rows:
        total[r["at"]] = r["v"]
    total = total.reshape(k + 1, k) / model.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def learn(df: DataFrame, k: int, y_col: str = "y") -> tuple[Whitening, float]:
    """The model of a frame whose ``y_col`` holds levels of equal length, and its identity error."""
    scratch = Scratch(df.sparkSession, "whitening")
    fit = scratch.put(df.select(F.col(y_col).alias("y")).distinct(), "fit")
    d = longest(fit, "y")
    model = Whitening(fit, d, k)
    error = _identity_error(fit, model, d) if len(model.values) else 0.0
    scratch.drop("fit")
    return model, error


def whiten(
    df: DataFrame, k: int = 16, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """``(id, component, n, deviation, whitened, explained, identity_error)``, a row for each vector and component.

    Vectors that are null or hold null or non-finite components are dropped;
    shorter ones are extended by zeros.  Components become ``floor(64 x)``
    (held at 2^45), and every distinct vector counts once for the covariance.
    Rows with a null id stay, and repeated rows get repeated results.  Components
    without variance are left out: with one distinct vector, or none, there are
    no rows.  ``deviation`` is NULL where the exact number needs more than 64 bits.
    """
    spark = df.sparkSession
    out = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")).where(finite(F.col("vector")))
    d = longest(rows, "vector")
    kind = df.schema[spelled(df, id_col)].dataType.simpleString()
    if not d:
        return spark.createDataFrame([], f"{id_col} {kind}, {out}")
    rows = rows.select("id", of_length(levels(F.col("vector")), d, F.lit(0).cast("long")).alias("y"))
    model, error = learn(rows, k)
    shares = model.values / model.trace if model.trace else model.values
    width = len(model.values)

    def result(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = matrix(batch.column("y"), d)
            n, z, deviation = len(y), model.whitened(y), model.deviations(y)
            row = np.repeat(np.arange(n), width)
            yield pa.RecordBatch.from_arrays([
                batch.column("id").take(pa.array(row)), pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), n)),
                pa.array(np.full(n * width, model.n)), deviation.take(pa.array(row)), pa.array(z.reshape(-1)),
                pa.array(np.tile(shares, n)), pa.array(np.full(n * width, error)),
            ], names=[id_col, *(c.split()[0] for c in out.split(", "))])

    return rows.mapInArrow(result, f"{id_col} {kind}, {out}")
