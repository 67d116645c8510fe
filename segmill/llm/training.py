"""Bounded labelled samples and small models fitted on the driver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmill.llm.base import Scratch


def fold_of(id_col: str, folds: int) -> Column:
    """``crc32(id as text) mod folds``; NULL for a null id."""
    return F.crc32(F.col(id_col).cast("string")) % folds


def held_out(id_col: str, folds: int, fold: int) -> Column:
    """Whether the row is kept from training; a null id is."""
    return F.coalesce(fold_of(id_col, folds) == fold, F.lit(True))


def _one_text_each(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, scratch: Scratch, name: str) -> DataFrame:
    """``(id, text, ...)``: the ids, which are few, with one text each, written once.

    Rows that repeat an id fold into the text of smallest hash before they are
    shuffled, so the sample is as large as the ids are many.
    """
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(ids), "_id").withColumn("_h", F.xxhash64("text"))
    rest = [c for c in ids.columns if c != "_id"]
    one = found.groupBy("_id", *rest).agg(F.min(F.struct("_h", "text")).alias("_one"))
    return scratch.put(one.select(F.col("_id").alias("id"), "_one.text", *rest), name)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int, where: Column, scratch: Scratch,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(id, text, label)`` of at most ``rows`` labelled documents that satisfy ``where``.

    The ids with the smallest hashes are taken, so the sample is the same on
    every run and independent of order.  An id counts once: with the larger of
    contradicting labels, and with the text of smallest hash.  The ids are few by
    the bound and broadcast; texts of other documents do not leave their task.
    """
    ids = (
        labels.where(where & F.col(label).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id")).agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("_id"), "_id").limit(rows)
    )
    return _one_text_each(docs, ids, id_col, text_col, scratch, f"labelled-{label}")


def unlabelled_sample(
    docs: DataFrame, rows: int, where: Column, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(id, text)`` of at most ``rows`` documents that satisfy ``where``, as ``labelled_sample`` takes them."""
    ids = (
        docs.where(where & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id")).distinct()
        .orderBy(F.xxhash64("_id", F.lit(1)), "_id").limit(rows)
    )
    return _one_text_each(docs, ids, id_col, text_col, scratch, "unlabelled")


def mixture_share(positive: np.ndarray, unlabelled: np.ndarray, delta: float = 0.1, seed: int = 5) -> float:
    """The share of positives among the unlabelled, from rows of features and no negatives.

    A classifier of positives against unlabelled rows is fitted on half of each.
    On the other half, among the highest scores nearly all rows are positives, so
    there the share of unlabelled rows over that of positives is the share sought;
    the threshold is the one with the least upper confidence bound of the ratio.
    """
    rng = np.random.default_rng(seed)
    halves = [np.array_split(rng.permutation(len(x)), 2) for x in (positive, unlabelled)]
    both = np.vstack([positive, unlabelled])
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-6
    z = [np.clip((x - mean) / scale, -8, 8) for x in (positive, unlabelled)]
    x = np.vstack([z[0][halves[0][0]], z[1][halves[1][0]]])
    y = np.repeat([1.0, 0.0], [len(halves[0][0]), len(halves[1][0])])
    w = fit_logistic(x, y, ridge=1.0)
    p, u = (np.sort(v[h[1]] @ w[:-1] + w[-1]) for v, h in zip(z, halves, strict=True))
    if not len(p) or not len(u):
        return 0.5
    at = np.unique(p)
    over_p = 1 - np.searchsorted(p, at, "left") / len(p)
    over_u = 1 - np.searchsorted(u, at, "left") / len(u)
    slack = np.sqrt(np.log(4 / delta) / 2 / len(u)) + np.sqrt(np.log(4 / delta) / 2 / len(p))
    k = int(((over_u + slack) / over_p).argmin())
    return float(min(1.0, over_u[k] / over_p[k]))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights (the last is the intercept) by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = sigmoid(x @ w)
        gradient = x.T @ (p - y) + penalty * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty) + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w
