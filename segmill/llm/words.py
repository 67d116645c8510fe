"""Words, lines and windows of many texts at once, as numpy arrays.

Words are the maximal runs of bytes outside ``\\x20 \\x09-\\x0D``; texts are UTF-8,
in which these bytes stand for nothing but themselves.  A word, line or window
is known by a 64-bit hash: a polynomial modulo 2**64 over its bytes (or its
words' hashes), mixed.  Two independent families give 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are worked on in pieces of about this many bytes, whole texts each.
CHUNK_BYTES = 1 << 21
BLOCK_BYTES = 1 << 20

MULTIPLIERS = (0x9E3779B97F4A7C55, 0xD1342543DE82EF95)  # odd
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True


def chunks(
    batches: Iterable[pa.RecordBatch], text: str, size: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with a bounded amount of text (one row at least), null as empty."""
    for batch in batches:
        at = batch.schema.get_field_index(text)
        column = pc.fill_null(batch.column(at).cast(pa.large_string()), "")
        batch = batch.set_column(at, text, column)
        ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes, and the offset of each text (one more than texts)."""
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]: offsets[-1]], offsets - offsets[0]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(multiplier: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64, ``n`` at least."""
    known = _POWERS.get(multiplier)
    if known is None or len(known[0]) < n:
        n = max(n, BLOCK_BYTES)
        tables = []
        for base in (multiplier, pow(multiplier, -1, 1 << 64)):
            powers = np.full(n, base, dtype=np.uint64)
            powers[0] = 1
            tables.append(np.multiply.accumulate(powers))
        _POWERS[multiplier] = known = (tables[0], tables[1])
    return known


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, family: int = 0) -> np.ndarray:
    """A hash of the bytes of each span; the spans are in order and do not overlap."""
    out = np.zeros(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + BLOCK_BYTES, "right")))
        n = int(ends[j - 1] - base)
        up, down = _powers(MULTIPLIERS[family], n + 1)
        values = (data[base: base + n].astype(np.uint64) + np.uint64(1)) * up[:n]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (sums[e] - sums[s]) * down[s]
        i = j
    return mix(out)


@dataclass
class Words:
    """The words of some texts: byte spans, and each text's first word in ``first``."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def windows(self, n: int) -> np.ndarray:
        """Whether ``n`` words of one text start at each word."""
        last = np.repeat(self.first[1:], self.counts)
        return np.arange(len(self.starts)) + n <= last

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many of each text's words are flagged."""
        return counted(flags, self.first)


def counted(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``flags`` between consecutive offsets."""
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return np.diff(sums[offsets])


def split(data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = ~SEPARATOR[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] |= inside[edges]
    stops[edges - 1] |= inside[edges - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a sequence from the hashes of its two parts."""
    return mix(a * np.uint64(0x2545F4914F6CDD1D) + (b ^ np.uint64(0x5851F42D4C957F2D)))


def shifted(h: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros_like(h)
    out[: max(0, len(h) - by)] = h[by:]
    return out


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the ``n``-word windows at each word, by doubling (see ``Words.windows``)."""
    if n == 1:
        return h
    half = window_hashes(h, n // 2)
    out = joined(half, shifted(half, n // 2))
    return joined(out, shifted(h, n - 1)) if n % 2 else out


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of the ``\\n``-split lines, and each text's first line (an empty text has one)."""
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    before = np.searchsorted(breaks, offsets)
    first = before + np.arange(len(offsets))
    ends = np.empty_like(starts)
    ends[:-1] = starts[1:] - 1
    last = first[1:] - 1
    ends[last] = offsets[1:]
    return starts, ends, first
