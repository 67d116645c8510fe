"""Encoding and decoding with a SentencePiece model of merges (BPE).

Encoding indexes the text of a whole batch at once.  The batch's distinct chunks
(runs that no piece can cross, roughly words) are laid end to end and their
suffixes sorted; every piece of the vocabulary is found by binary search as one
range of suffixes.  The ranges are all the edges (start, end, piece) of the
segmentation graph.  Sorted by end, they are relaxed from left to right: an edge
is taken if its piece may follow the last piece of the text before it.  Exactly
one edge into each place passes, so the path is the one that merging would make.

Two pieces may stand side by side if merging their joined text gives the two
again.  That is decided by undoing merges on both sides of the border, latest
first: if what then touches could have merged earlier, they may not.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from segmill.llm import words as W
from segmill.llm.base import spelled

SPACE = "▁"  # stands for a space in pieces
WORD = 8      # bytes compared at once
BATCH_BYTES = 1 << 20
LEARN_BYTES = 1 << 17   # of new chunks under one suffix array, which takes some hundred bytes for each
KNOWN_CHUNKS = 400_000  # chunks a task remembers
LONG_CHUNK = 2_048      # longer chunks are merged one by one

NONE = -1     # before a chunk's first piece
OTHER = -2    # a character of no piece


@dataclass
class Vocabulary:
    """A model's pieces and what encoding needs of them, as arrays."""

    texts: list[bytes]          # by id, a space for SPACE; empty for control pieces
    normal: np.ndarray          # ids of ordinary pieces that merging makes of their own text
    rank: np.ndarray            # order of merging by id; base characters of no piece follow the ids
    left: np.ndarray            # last merge of each piece; the piece itself for characters
    right: np.ndarray
    pairs: np.ndarray           # sorted keys of two symbols that merge
    merged: np.ndarray          # rank of what they make
    tied: np.ndarray            # ids of pieces whose rank is shared or not behind their parts'
    byte_ids: np.ndarray | None  # ids of the 256 bytes, or None
    unknown: int
    alone: np.ndarray           # ASCII bytes of no piece

    @property
    def size(self) -> int:
        return len(self.rank)


def load(path: str) -> Vocabulary:
    """Read a model file on the driver; the arrays travel with the tasks (a few MB)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.vocab_size()
    names = [model.id_to_piece(i) for i in range(n)]
    special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]
    is_byte = [model.is_byte(i) for i in range(n)]
    plain = {names[i]: i for i in range(n) if not special[i] and not is_byte[i]}
    by_byte = {int(names[i][3:5], 16): i for i in range(n) if is_byte[i]}
    scores = {p: model.get_score(i) for p, i in plain.items()}
    return vocabulary(plain, scores, n, by_byte, model.unk_id())


def vocabulary(plain: dict[str, int], scores: dict[str, float], n: int, by_byte: dict[int, int], unknown: int) -> Vocabulary:
    extra = sorted({c for piece in plain for c in piece} - set(plain))
    ids = {c: k for k, c in enumerate(extra, start=n)} | plain
    order = sorted(set(scores.values()), reverse=True)
    place = {s: k for k, s in enumerate(order)}
    total = n + len(extra)
    rank = np.full(total, len(order) + 1, dtype=np.int64)
    for piece, i in plain.items():
        rank[i] = place[scores[piece]]
    counts = np.bincount(rank[list(plain.values())], minlength=len(order) + 2)
    tied = np.array([i for p, i in plain.items() if len(p) > 1 and counts[rank[i]] > 1], dtype=np.int64)
    left, right = np.arange(total), np.arange(total)
    normal = []
    keys, made = [], []
    for piece, i in plain.items():
        if len(piece) == 1:
            normal.append(i)
            continue
        parts, last = merge(piece, plain, scores)
        if parts == [piece]:
            normal.append(i)
            left[i], right[i] = ids[last[0]], ids[last[1]]
        for k in range(1, len(piece)):
            a, b = ids.get(piece[:k]), ids.get(piece[k:])
            if a is not None and b is not None:
                keys.append(a * total + b)
                made.append(rank[i])
    # Undoing merges latest first needs pieces to rank behind their parts.
    early = [i for p, i in plain.items() if len(p) > 1 and left[i] != i
             and rank[i] <= max([rank[h] for h in (left[i], right[i]) if left[h] != h], default=-1)]
    tied = np.union1d(tied, np.array(early, dtype=np.int64))
    order_ = np.argsort(keys)
    texts = [b""] * n
    for piece, i in plain.items():
        texts[i] = piece.replace(SPACE, " ").encode()
    for value, i in by_byte.items():
        texts[i] = bytes([value])
    used = {c for p in plain for c in p.replace(SPACE, " ").encode()}
    alone = np.array([b < 128 and b not in used for b in range(256)])
    byte_ids = np.array([by_byte[b] for b in range(256)]) if len(by_byte) == 256 else None
    return Vocabulary(
        texts, np.array(sorted(normal)), rank, left, right, np.array(keys, dtype=np.int64)[order_],
        np.array(made, dtype=np.int64)[order_], tied, byte_ids, unknown, alone,
    )


def merge(text: str, plain: dict[str, int], scores: dict[str, float]) -> tuple[list[str], tuple[str, str] | None]:
    """The pieces that merging makes of a text, best score first and then leftmost; its last merge."""
    parts = list(text)
    nexts, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    queue: list[tuple[float, int, str, str]] = []

    def offer(i: int) -> None:
        j = nexts[i]
        if j < len(parts) and (both := parts[i] + parts[j]) in plain:
            heapq.heappush(queue, (-scores[both], i, parts[i], parts[j]))

    for i in range(len(parts) - 1):
        offer(i)
    last = None
    while queue:
        _, i, a, b = heapq.heappop(queue)
        j = nexts[i]
        if parts[i] != a or j >= len(parts) or parts[j] != b:
            continue
        last = (a, b)
        parts[i], parts[j] = a + b, ""
        nexts[i] = nexts[j]
        if nexts[j] < len(parts):
            before[nexts[j]] = i
        if before[i] >= 0:
            offer(before[i])
        offer(i)
    return [p for p in parts if p], last


def _numbers(texts: list[bytes], words: int) -> np.ndarray:
    """``[text, word]``: texts of equal length as numbers of eight bytes that sort as they do."""
    return np.frombuffer(b"".join(texts), dtype=">u8").reshape(len(texts), words).astype(np.uint64)


def _eights(text: np.ndarray, room: int) -> np.ndarray:
    """The eight bytes from each place on as a number, zeros after the end, for ``room`` places more."""
    out = np.concatenate([text, np.zeros(room + WORD, dtype=np.uint8)]).astype(np.uint64)
    for shift in (1, 2, 4):
        out[:-shift] = (out[:-shift] << np.uint64(8 * shift)) | out[shift:]
    return out


def _suffix_order(keys: np.ndarray, places: np.ndarray, words: int) -> np.ndarray:
    """The order of the suffixes at ``places`` by their first ``words`` numbers.

    All are sorted by the first number; only those that tie, by the next.
    """
    order = np.argsort(keys[places], kind="stable")
    first = keys[places[order]]
    same = np.zeros(len(order) + 1, dtype=bool)
    same[1:-1] = first[1:] == first[:-1]
    for k in range(1, words):
        tied = np.flatnonzero(same[:-1] | same[1:])
        if not len(tied):
            break
        group = np.cumsum(~same[:-1])[tied]
        number = keys[places[order[tied]] + k * WORD]
        by = np.lexsort((number, group))
        order[tied] = order[tied][by]
        number = number[by]
        still = np.zeros(len(order) + 1, dtype=bool)
        still[tied[1:]] = (number[1:] == number[:-1]) & (group[1:] == group[:-1])
        same = still
    return order


def _bisect(at, wanted: np.ndarray, low: np.ndarray, high: np.ndarray, strict: bool) -> np.ndarray:
    """In each range, the first place whose number is at least (``strict``: above) the wanted one."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_]) // 2
        number = at(middle)
        before = (number <= wanted[open_]) if strict else (number < wanted[open_])
        low[open_[before]] = middle[before] + 1
        high[open_[~before]] = middle[~before]


class Encoder:
    """Encodes batches; remembers chunks and neighbouring pieces it has met."""

    def __init__(self, vocab: Vocabulary):
        self.v = vocab
        searched = [vocab.texts[i] for i in vocab.normal]
        self.lengths = np.array([len(t) for t in searched], dtype=np.int64)
        self.words = -(-int(self.lengths.max(initial=1)) // WORD)
        # Each piece's least and largest continuation, as numbers of eight bytes.
        self.low = _numbers([t.ljust(self.words * WORD, b"\x00") for t in searched], self.words)
        self.high = _numbers([t.ljust(self.words * WORD, b"\xff") for t in searched], self.words)
        self.tied = np.isin(vocab.normal, vocab.tied)
        self.met = np.full(1 << 20, -1, dtype=np.int64)
        self.fits = np.zeros(1 << 20, dtype=bool)
        self.hashes = np.zeros(0, dtype=np.uint64)
        self.starts, self.sizes = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.flat = np.zeros(0, dtype=np.int32)
        self._slow: tuple | None = None

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the offset of each text among them.

        ``data`` has a space where the text has SPACE, and one before each text
        that is not empty.
        """
        cut = np.zeros(len(data), dtype=bool)
        if len(data):
            cut[0] = True
            cut[1:] = ((data[1:] == 32) & (data[:-1] != 32)) | self.v.alone[data[1:]] | self.v.alone[data[:-1]]
            inner = offsets[:-1][offsets[:-1] < len(data)]
            cut[inner] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data))[: len(starts)]
        hashes = W.span_hashes(data, starts, ends)
        distinct, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        new = np.ones(len(distinct), dtype=bool)
        if len(self.hashes):
            near = np.minimum(np.searchsorted(self.hashes, distinct), len(self.hashes) - 1)
            new = self.hashes[near] != distinct
        if new.any():
            if len(self.hashes) + new.sum() > KNOWN_CHUNKS:
                new[:] = True
                self.hashes, self.starts = self.hashes[:0], self.starts[:0]
                self.sizes, self.flat = self.sizes[:0], self.flat[:0]
            self._learn(distinct[new], data, starts[at[new]], ends[at[new]])
        entry = np.searchsorted(self.hashes, distinct)[which]
        sizes = self.sizes[entry]
        first = np.cumsum(sizes) - sizes
        ids = self.flat[np.arange(sizes.sum()) + np.repeat(self.starts[entry] - first, sizes)]
        sums = np.concatenate([[0], np.cumsum(sizes)])
        return ids, sums[np.searchsorted(starts, offsets)]

    def _learn(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        lengths = ends - starts
        behind = np.cumsum(lengths)
        found, at = [], 0
        while at < len(starts):
            done = behind[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(behind, done + LEARN_BYTES, "right")))
            some = lengths[at:stop]
            offsets = np.concatenate([[0], np.cumsum(some)])
            text = data[np.arange(offsets[-1]) + np.repeat(starts[at:stop] - offsets[:-1], some)]
            found.append(self._segment(text, offsets))
            at = stop
        ids, sizes = (np.concatenate(x) for x in zip(*found, strict=True))
        all_hashes = np.concatenate([self.hashes, hashes])
        all_sizes = np.concatenate([self.sizes, sizes])
        all_starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.flat = np.concatenate([self.flat, ids])
        order = np.argsort(all_hashes, kind="stable")  # both parts are sorted
        self.hashes, self.sizes, self.starts = all_hashes[order], all_sizes[order], all_starts[order]

    def _edges(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(start, index of the piece)`` of all occurrences of all pieces, by the suffix array."""
        places = np.flatnonzero(text & 0xC0 != 0x80)
        keys = _eights(text, self.words * WORD)
        order = _suffix_order(keys, places, self.words)
        array = places[order]
        low = np.zeros(len(self.lengths), dtype=np.int64)
        high = np.full(len(self.lengths), len(array), dtype=np.int64)
        # A range of suffixes with the piece's first words narrows by the next word.
        live = np.arange(len(self.lengths))
        for k in range(self.words):
            if not k:
                first = keys[array]
                low[:] = np.searchsorted(first, self.low[:, 0], "left")
                high[:] = np.searchsorted(first, self.high[:, 0], "right")
            else:
                live = live[(self.lengths[live] > k * WORD) & (low[live] < high[live])]
                if not len(live):
                    break
                at = lambda i: keys[array[i] + k * WORD]  # noqa: B023, E731
                left = _bisect(at, self.low[live, k], low[live], high[live], strict=False)
                high[live] = _bisect(at, self.high[live, k], left, high[live], strict=True)
                low[live] = left
        counts = np.maximum(high - low, 0)
        piece = np.repeat(np.arange(len(counts)), counts)
        at = np.arange(counts.sum()) + np.repeat(low - (np.cumsum(counts) - counts), counts)
        return array[at], piece

    def _segment(self, text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks, end to end, and how many each has."""
        n = len(text)
        chunk_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        start, piece = self._edges(text)
        end = start + self.lengths[piece]
        inside = end <= offsets[chunk_of[start] + 1]
        start, piece, end = start[inside], piece[inside], end[inside]
        slow = np.zeros(len(offsets) - 1, dtype=bool)
        slow[chunk_of[start[self.tied[piece]]]] = True
        slow |= np.diff(offsets) > LONG_CHUNK
        if slow.any():
            fast = ~slow[chunk_of[start]]
            start, piece, end = start[fast], piece[fast], end[fast]
        token = self.v.normal[piece]
        # Characters that no piece consists of, alone or as a beginning, get an edge of their own.
        places = np.flatnonzero(text & 0xC0 != 0x80)
        next_place = np.append(places[1:], n)
        after = np.zeros(n + 1, dtype=np.int64)
        after[places] = next_place
        has = np.zeros(n + 1, dtype=bool)
        has[start[end == after[start]]] = True
        bare = ~has[places] & ~slow[chunk_of[places]]
        start = np.concatenate([start, places[bare]])
        token = np.concatenate([token, np.full(int(bare.sum()), OTHER)])
        end = np.concatenate([end, next_place[bare]])

        level = end - offsets[chunk_of[start]]
        order = np.argsort(level, kind="stable")
        start, token, end, level = start[order], token[order], end[order], level[order]
        bounds = np.searchsorted(level, np.arange(1, (level[-1] if len(level) else 0) + 2))
        # By end place: the last piece of the only segmentation, and where it starts.
        last = np.full(n + 1, OTHER - 1, dtype=np.int64)
        back = np.full(n + 1, -1, dtype=np.int64)
        first = np.zeros(n + 1, dtype=bool)
        first[offsets] = True
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if a == b:
                continue
            s, t, e = start[a:b], token[a:b], end[a:b]
            previous = np.where(first[s], NONE, last[s])
            taken = self._may_follow(previous, t)
            last[e[taken]] = t[taken]
            back[e[taken]] = s[taken]
        marks = np.zeros(n + 1, dtype=bool)
        at = offsets[1:][~slow]
        begin = offsets[:-1][~slow]
        while len(at):
            marks[at] = True
            at = back[at]
            on = at > begin
            at, begin = at[on], begin[on]
        ends = np.flatnonzero(marks)
        tokens, begins = last[ends], back[ends]
        owner = chunk_of[begins]
        if slow.any():
            extra = [self._merged(text[offsets[c]: offsets[c + 1]], offsets[c]) for c in np.flatnonzero(slow)]
            tokens = np.concatenate([tokens, *[x[0] for x in extra]])
            begins = np.concatenate([begins, *[x[1] for x in extra]])
            ends = np.concatenate([ends, *[x[2] for x in extra]])
            owner = np.concatenate([owner, *[np.full(len(x[0]), c) for x, c in zip(extra, np.flatnonzero(slow), strict=True)]])
            order = np.argsort(begins, kind="stable")
            tokens, begins, ends, owner = tokens[order], begins[order], ends[order], owner[order]
        as_bytes = (tokens < 0) | (tokens >= len(self.v.texts))
        spread = np.where(as_bytes, ends - begins if self.v.byte_ids is not None else 1, 1)
        ids = np.repeat(np.where(as_bytes, self.v.unknown, tokens), spread)
        if self.v.byte_ids is not None:
            within = np.arange(len(ids)) - np.repeat(np.cumsum(spread) - spread, spread)
            raw = np.repeat(as_bytes, spread)
            ids[raw] = self.v.byte_ids[text[(np.repeat(begins, spread) + within)[raw]]]
        sizes = np.bincount(owner, weights=spread, minlength=len(offsets) - 1).astype(np.int64)
        return ids.astype(np.int32), sizes

    def _merged(self, chunk: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces of one chunk by merging, for long ones and for ranks that several pieces share."""
        if self._slow is None:
            plain = {self.v.texts[i].decode(): int(i) for i in self.v.normal}
            self._slow = plain, {p: -float(self.v.rank[i]) for p, i in plain.items()}
        plain, scores = self._slow
        parts, _ = merge(chunk.tobytes().decode(), plain, scores)
        ends = at + np.cumsum([len(p.encode()) for p in parts])
        return np.array([plain.get(p, OTHER) for p in parts]), np.concatenate([[at], ends[:-1]]), ends

    def _may_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether piece ``b`` may stand after ``a``; nothing may where there is no segmentation."""
        out = (a >= NONE) | (a == OTHER)
        both = np.flatnonzero((a >= 0) & (b >= 0))
        keys = a[both] * self.v.size + b[both]
        slot = (W.mix(keys.astype(np.uint64)) & np.uint64(len(self.met) - 1)).astype(np.int64)
        unmet = self.met[slot] != keys
        fits = self.fits[slot]
        if unmet.any():
            ask = np.unique(keys[unmet])
            answer = self._compatible(ask // self.v.size, ask % self.v.size)
            fits[unmet] = answer[np.searchsorted(ask, keys[unmet])]
            self.met[slot[unmet]], self.fits[slot[unmet]] = keys[unmet], fits[unmet]
        out[both] = fits
        return out

    def _compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        v = self.v
        fits = np.ones(len(a), dtype=bool)
        live = np.arange(len(a))
        # A merge over the border must come before the merge that hid it from the border.
        # At equal rank the left one comes first.
        limit = np.full(len(a), np.iinfo(np.int64).max)
        while len(live):
            key = a * v.size + b
            at = np.minimum(np.searchsorted(v.pairs, key), len(v.pairs) - 1)
            crosses = (v.pairs[at] == key) & (v.merged[at] < limit)
            fits[live[crosses]] = False
            ra, rb = np.where(v.left[a] == a, -1, v.rank[a]), np.where(v.left[b] == b, -1, v.rank[b])
            on = ~crosses & ((ra >= 0) | (rb >= 0))
            live, a, b, ra, rb = live[on], a[on], b[on], ra[on], rb[on]
            undo_a = ra > rb
            limit = np.where(undo_a, ra, rb + 1)
            a, b = np.where(undo_a, v.right[a], a), np.where(undo_a, b, v.left[b])
        return fits


def _prepared(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Texts with a space before each that is not empty, and spaces for SPACE."""
    texts = [f" {t}".replace(SPACE, " ").encode() if t else b"" for t in column.to_pylist()]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return np.frombuffer(b"".join(texts), dtype=np.uint8), offsets


def decode(vocab: Vocabulary, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
    """Texts of id sequences; one leading space goes.  Bytes that are no UTF-8 become U+FFFD."""
    known = vocab.texts
    lengths = np.array([len(t) for t in known])
    starts = np.cumsum(lengths) - lengths
    pool = np.frombuffer(b"".join(known), dtype=np.uint8)
    size = lengths[ids]
    data = pool[np.arange(size.sum()) + np.repeat(starts[ids] - (np.cumsum(size) - size), size)].tobytes()
    at = np.concatenate([[0], np.cumsum(size)])[offsets].tolist()
    return [data[a:b].removeprefix(b" ").decode(errors="replace") for a, b in zip(at, at[1:], strict=False)]


def _encode(
    batches: Iterator[pa.RecordBatch], vocab: Vocabulary, text: str, out: str, check: str | None
) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(vocab)
    # The text as given travels behind the one that is worked on, whose nulls are filled.
    given = (b.append_column("given", b.column(b.schema.get_field_index(text))) for b in batches)
    for batch in W.chunks(given, text, BATCH_BYTES):
        at = batch.schema.get_field_index(text)
        ids, offsets = encoder.encode(*_prepared(batch.column(at)))
        columns = [*batch.columns[:-1], pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))]
        columns[at] = batch.column(batch.num_columns - 1).cast(pa.string())
        names = [*batch.schema.names[:-1], out]
        if check is not None:
            texts = decode(vocab, ids.astype(np.int64), offsets)
            same = [d == t.replace(SPACE, " ") for d, t in zip(texts, batch.column(at).to_pylist(), strict=True)]
            columns.append(pa.array(same, pa.bool_()))
            names.append(check)
        yield pa.RecordBatch.from_arrays(columns, names=names)


def encode(
    df: DataFrame, vocab: Vocabulary, text_col: str = "text", out: str = "ids", check: str | None = None
) -> DataFrame:
    """``df`` with the ids of each text, as the model itself gives them.

    One pass, no shuffle.  Empty and null texts have no ids; a null text stays
    null.  ``check`` names a column that tells whether the ids decode to the text
    (with a space for SPACE; null counts as empty); they are decoded in the same
    pass.  Columns called ``out`` or ``check`` are replaced, others stay.
    """
    rest = df.drop(out, check) if check else df.drop(out)
    text_col = spelled(rest, text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields)
    schema += f", `{out}` array<int>" + (f", `{check}` boolean" if check else "")
    return rest.mapInArrow(lambda it: _encode(it, vocab, text_col, out, check), schema)


def _decode(batches: Iterator[pa.RecordBatch], vocab: Vocabulary, ids: str, out: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            lists = part.column(part.schema.get_field_index(ids)).cast(pa.list_(pa.int32()))
            sizes = np.asarray(lists.value_lengths().fill_null(0))
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            texts = decode(vocab, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), offsets)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, out])


def decode_ids(df: DataFrame, vocab: Vocabulary, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text of each id sequence; null and empty ones give the empty text."""
    rest = df.drop(out)
    ids_col = spelled(rest, ids_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields)
    return rest.mapInArrow(lambda it: _decode(it, vocab, ids_col, out), f"{schema}, `{out}` string")
