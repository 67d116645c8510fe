"""Quality by positive-unlabelled learning.

Trusted positives and unlabelled web text are all the risk needs: with the share
of good texts (the class prior) known, the risk on bad texts is the risk of
calling all unlabelled texts bad, less that part which falls on good ones.
The estimate of the latter difference can turn negative when the model fits the
sample too well; non-negative risk estimation holds it at zero and, where it
falls below, goes back on it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmill.llm import words as W
from segmill.llm.base import Scratch, spelled
from segmill.llm.training import labelled_sample, mixture_share, sigmoid, unlabelled_sample

# Bounds of the training sample, in documents.
POSITIVES = 8_000
UNLABELLED = 16_000
HIDDEN = 24
STEPS = 600


def _class(members: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


CLASSES = (
    _class(b"#*$%&<>"), _class(b"|"), _class(b".,;:!?"), _class(b"0123456789"),
    _class(bytes(range(65, 91))), _class(b"\n"), _class(bytes(range(192, 256))),
)
N_FEATURES = len(CLASSES) + 9


def features(batch_text: pa.Array) -> np.ndarray:
    """One row of measurements per text: shares of characters, repetition, lengths."""
    data, offsets = W.flat(batch_text)
    w = W.split(data, offsets)
    n = len(offsets) - 1
    size = np.maximum(1, np.diff(offsets)).astype(np.float64)
    count = np.maximum(1, w.counts).astype(np.float64)
    out = [np.sqrt(W.counted(c[data], offsets) / size) for c in CLASSES]
    h = W.span_hashes(data, w.starts, w.ends)
    text = w.text_of
    lengths = (w.ends - w.starts).astype(np.float64)
    sums = np.bincount(text, weights=lengths, minlength=n)
    squares = np.bincount(text, weights=lengths**2, minlength=n)
    mean = sums / count
    out += [mean / 10, np.sqrt(np.maximum(0, squares / count - mean**2)) / 10, np.log1p(w.counts) / 5]
    again = np.zeros(len(h), dtype=bool)
    again[1:] = (h[1:] == h[:-1]) & (text[1:] == text[:-1])
    out.append(w.per_text(again) / count)
    _, at = np.unique(W.joined(h, W.mix(text.astype(np.uint64) + np.uint64(1))), return_index=True)
    distinct = np.bincount(text[at], minlength=n)
    out.append(distinct / count)
    out.append(np.log1p(distinct) / np.log1p(count))
    pairs = W.joined(h, W.shifted(h, 1))
    inside = np.flatnonzero(w.windows(2))
    _, at = np.unique(W.joined(pairs[inside], W.mix(text[inside].astype(np.uint64) + np.uint64(1))), return_index=True)
    out.append(1 - np.bincount(text[inside[at]], minlength=n) / np.maximum(1, w.counts - 1))
    starts, ends, first = W.lines(data, offsets)
    of = np.repeat(np.arange(n), np.diff(first))
    _, at = np.unique(W.joined(W.span_hashes(data, starts, ends), W.mix(of.astype(np.uint64) + np.uint64(1))), return_index=True)
    n_lines = np.diff(first)
    out.append(1 - np.bincount(of[at], minlength=n) / n_lines)
    out.append(np.log1p(w.counts / n_lines) / 5)
    return np.column_stack(out)


@dataclass(frozen=True)
class Model:
    """A network with one hidden layer over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = STEPS, seed: int = 7) -> Model:
    """Minimise the non-negative risk with logistic loss by Adam on the whole sample."""
    both = np.vstack([positive, unlabelled])
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-6
    zp, zu = (np.clip((x - mean) / scale, -8, 8) for x in (positive, unlabelled))
    rng = np.random.default_rng(seed)
    d = both.shape[1]
    theta = [rng.normal(0, 1 / np.sqrt(d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.1, HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]

    def backward(z: np.ndarray, a: np.ndarray, g: np.ndarray) -> list[np.ndarray]:
        hidden = np.outer(g, theta[2]) * (1 - a**2)
        return [z.T @ hidden, hidden.sum(axis=0), a.T @ g, np.array([g.sum()])]

    for step in range(1, steps + 1):
        ap, au = np.tanh(zp @ theta[0] + theta[1]), np.tanh(zu @ theta[0] + theta[1])
        fp, fu = ap @ theta[2] + theta[3], au @ theta[2] + theta[3]
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        # Gradients of: prior * E_p[loss as good]; E_u[loss as bad] - prior * E_p[loss as bad].
        good_p = -prior * sigmoid(-fp) / len(fp)
        bad_p, bad_u = -prior * sigmoid(fp) / len(fp), sigmoid(fu) / len(fu)
        if negative >= 0:
            grads = [x + y for x, y in zip(backward(zp, ap, good_p + bad_p), backward(zu, au, bad_u), strict=True)]
        else:
            grads = [-x - y for x, y in zip(backward(zp, ap, bad_p), backward(zu, au, bad_u), strict=True)]
        for k, g in enumerate(grads):
            g = g + 1e-4 * theta[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g**2
            theta[k] = theta[k] - 0.02 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, theta[0], theta[1], theta[2], float(theta[3][0]))


def _features_of(batches: Iterator[pa.RecordBatch], names: Sequence[str]) -> Iterator[pa.RecordBatch]:
    for batch in W.chunks(batches, "text"):
        x = features(batch.column(batch.schema.get_field_index("text")))
        lists = pa.ListArray.from_arrays(
            pa.array((np.arange(len(x) + 1) * x.shape[1]).astype(np.int32)), pa.array(x.reshape(-1))
        )
        kept = [batch.column(batch.schema.get_field_index(c)) for c in names]
        yield pa.RecordBatch.from_arrays([*kept, lists], names=[*names, "x"])


def learn(
    docs: DataFrame, labels: DataFrame, where: Column, label: str = "quality", prior: float | None = None,
    positives: int = POSITIVES, unlabelled: int = UNLABELLED, id_col: str = "doc_id", text_col: str = "text",
) -> Model | None:
    """A model from bounded samples of the rows that satisfy ``where``; None without positives.

    Trusted positives are documents labelled 1.  Unlabelled are any documents, by
    smallest hash of the id, their labels unseen.  The class prior, unless given,
    is estimated from these two samples (``mixture_share``), kept within 0.05 and
    0.95.  Rows sharing an id count once.  The driver gets the features of the
    samples only.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    good = labelled_sample(docs, labels.where(F.col(label) == 1), label, positives, where, scratch, id_col, text_col)
    web = unlabelled_sample(docs, unlabelled, where, scratch, id_col, text_col)
    samples = (
        good.select(F.lit(1).alias("good"), "text").union(web.select(F.lit(0), "text"))
        .mapInArrow(lambda it: _features_of(it, ("good",)), "good int, x array<double>")
    ).toPandas()
    scratch.keep_only()
    x = np.array([list(v) for v in samples["x"]], dtype=np.float64).reshape(len(samples), N_FEATURES)
    order = np.lexsort((*x.T, samples["good"].to_numpy()))  # the sum's order, whatever the tasks' order
    x, is_good = x[order], samples["good"].to_numpy()[order] == 1
    if not is_good.any() or is_good.all():
        return None
    if prior is None:
        prior = min(0.95, max(0.05, mixture_share(x[is_good], x[~is_good])))
    return fit(x[is_good], x[~is_good], prior)


def _score(batches: Iterator[pa.RecordBatch], model: Model | None, text: str, out: str) -> Iterator[pa.RecordBatch]:
    for batch in W.chunks(batches, text):
        at = batch.schema.get_field_index(text)
        column = batch.column(at)
        scores = np.full(batch.num_rows, 0.5) if model is None else sigmoid(model.logits(features(column)))
        batch = batch.set_column(at, text, column.cast(pa.string()))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, out])


def with_score(df: DataFrame, model: Model | None, text_col: str = "text", out: str = "score") -> DataFrame:
    """``df`` with how likely each text is a good one, from 0 to 1.

    One pass over whole texts, no shuffle.  Null counts as empty, and comes back
    empty; an empty text gets the score of its features.  Without a model all
    scores are 0.5.  A column called ``out`` is replaced, others stay.
    """
    rest = df.drop(out)
    text_col = spelled(rest, text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields)
    return rest.mapInArrow(lambda it: _score(it, model, text_col, out), f"{schema}, `{out}` double")
