"""Near-duplicate documents by weighted minwise hashing (BagMinHash).

A document is the multiset of its five-word shingles.  Similarity is the
weighted Jaccard index of two multisets: the sum of the smaller counts over the
sum of the larger.

Signatures.  Every unit of weight of every shingle carries a Poisson process of
points ``(time, register)``; a register keeps the earliest point that falls on
it.  Weights are discretised to integers and grouped in bands ``[0,1) [1,2) [2,4)
[4,8) ...``: one process of the band's total rate stands for its units, and a
point belongs to the unit it falls on.  A shingle of weight ``w`` uses the points
below ``w``.  Two documents see the same points below the smaller weight, so a
register agrees with probability exactly equal to the similarity.  A process
is followed only until it passes the latest register, which takes few steps.

Candidates share a band of registers.  They are verified exactly on whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segmill.llm import words as W
from segmill.llm.base import Scratch
from segmill.llm.components import components

SHINGLE = 5
THRESHOLD = 0.8
# A pair at similarity 0.8 agrees on 128 * 0.8 registers, give or take five, and
# then shares none of 60 bands of 7 with a probability of some 6 in 100,000.  Bands
# this long keep texts apart that share no more than a common passage.
REGISTERS = 128
BANDS = 60
BAND_REGISTERS = 7

# A bucket whose members fall into several components is looked at further: in
# rounds with more and more hubs, and pair by pair once the pairs are few.
HUBS = 4
# Shingles are counted by this many classes to bound what two texts share.
CLASSES = 64
NO_ID = -(1 << 63)
HUB_ROUNDS = 1
PAIRS_PER_TEXT = 4
# Members of a bucket are compared by blocks of about so many, and so many pairs at once.
BLOCK = 1_024
PAIRS = 1 << 16


def band_registers() -> np.ndarray:
    """The registers of each band: shuffled decks of all registers, dealt one after another."""
    rng = np.random.default_rng(5)
    decks = [rng.permutation(REGISTERS) for _ in range(-(-BANDS * BAND_REGISTERS // REGISTERS))]
    return np.concatenate(decks)[: BANDS * BAND_REGISTERS].reshape(BANDS, BAND_REGISTERS)


def shingle_bags(w: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, shingle, count)``, in order of text and shingle.

    A text of fewer than five words has one shingle, all of its words.
    """
    h = W.span_hashes(w.data, w.starts, w.ends)
    at = np.flatnonzero(w.windows(SHINGLE))
    text, shingle = [w.text_of[at]], [W.window_hashes(h, SHINGLE)[at]]
    for n in range(1, SHINGLE):
        short = np.flatnonzero(w.counts == n)
        text.append(short)
        shingle.append(W.window_hashes(h, n)[w.first[short]])
    text, shingle = np.concatenate(text), np.concatenate(shingle)
    order = np.lexsort((shingle, text))
    text, shingle = text[order], shingle[order]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (shingle[1:] != shingle[:-1])
    first = np.flatnonzero(new)
    return text[first], shingle[first], np.diff(np.append(first, len(text)))


def signatures(text: np.ndarray, shingle: np.ndarray, count: np.ndarray, n: int, m: int) -> np.ndarray:
    """The names of the earliest points, ``n`` rows of ``m`` registers (0 without shingles)."""
    owner, element, width, low, weight = [text], [shingle], [np.ones(len(text))], [np.zeros(len(text))], [count]
    level = 0
    while True:
        more = count > (1 << level)
        if not more.any():
            break
        level += 1
        size = 1 << (level - 1)
        owner.append(text[more])
        element.append(W.joined(shingle[more], np.full(int(more.sum()), level, np.uint64)))
        width.append(np.full(int(more.sum()), float(size)))
        low.append(np.full(int(more.sum()), float(size)))
        weight.append(count[more])
    owner, element = np.concatenate(owner), np.concatenate(element)
    width, low, weight = np.concatenate(width), np.concatenate(low), np.concatenate(weight)
    whole = low + width <= weight
    earliest = np.full(n * m, np.inf)
    names = np.zeros(n * m, dtype=np.uint64)
    time = np.zeros(len(owner))
    step = 0
    while len(owner):
        step += 1
        r = W.mix(element + np.uint64(step * 0x9E3779B97F4A7C15 % (1 << 64)))
        s = W.mix(r ^ np.uint64(0x6A09E667F3BCC909))
        time = time - np.log(((s >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)) / width
        register = ((r >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        slot = owner * m + register
        inside = whole
        if not whole.all():
            x = low + (r & np.uint64(0xFFFFFFFF)).astype(np.float64) / (1 << 32) * width
            inside = whole | (x < weight)
        np.minimum.at(earliest, slot[inside], time[inside])
        won = inside & (earliest[slot] == time)
        names[slot[won]] = r[won]
        latest = earliest.reshape(n, m).max(axis=1)
        on = time < latest[owner]
        owner, element, time, width = owner[on], element[on], time[on], width[on]
        low, weight, whole = low[on], weight[on], whole[on]
    return names.reshape(n, m)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    registers = band_registers()
    for batch in W.chunks(batches, "text"):
        get = lambda c: batch.column(batch.schema.get_field_index(c))
        w = W.split(*W.flat(get("text")))
        n = batch.num_rows
        some = w.counts > 0
        sequences = [_sequence(w, family) for family in (0, 1)]
        names = signatures(*shingle_bags(w), n, REGISTERS)
        buckets = np.zeros((n, BANDS), dtype=np.uint64)
        for band in range(BANDS):
            h = np.full(n, band + 1, dtype=np.uint64)
            for k in range(BAND_REGISTERS):
                h = W.joined(h, names[:, registers[band, k]])
            buckets[:, band] = h
        lists = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(np.where(some, BANDS, 0))]).astype(np.int32)),
            pa.array(buckets[some].reshape(-1).view(np.int64)),
        )
        yield pa.RecordBatch.from_arrays(
            [get("id"), get("row"), *[pa.array(s.view(np.int64)) for s in sequences],
             pa.array(w.counts.astype(np.int64)), lists],
            names=["id", "row", "a", "b", "n_words", "buckets"],
        )


def _sequence(w: W.Words, family: int) -> np.ndarray:
    """A hash of each text's words in order."""
    h = W.span_hashes(w.data, w.starts, w.ends, family)
    place = np.arange(len(h)) - np.repeat(w.first[:-1], w.counts)
    placed = W.joined(h, W.mix(place.astype(np.uint64) + np.uint64(1 + family)))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(placed, dtype=np.uint64)])
    return W.joined(sums[w.first[1:]] - sums[w.first[:-1]], w.counts.astype(np.uint64))


def _verify(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    per_mille = round(threshold * 1000)
    for batch in W.chunks(batches, "text_x"):
        get = lambda c: batch.column(batch.schema.get_field_index(c))
        bags = []
        for side in ("text_x", "text_y"):
            w = W.split(*W.flat(get(side).cast(pa.large_string())))
            pair, shingle, count = shingle_bags(w)
            bags.append((W.joined(shingle, W.mix(pair.astype(np.uint64) + np.uint64(1))), pair, count))
        (kx, pair, cx), (ky, pair_y, cy) = bags
        _, ix, iy = np.intersect1d(kx, ky, assume_unique=True, return_indices=True)
        n = batch.num_rows
        shared = np.bincount(pair[ix], weights=np.minimum(cx[ix], cy[iy]), minlength=n).astype(np.int64)
        total = (np.bincount(pair, weights=cx, minlength=n) + np.bincount(pair_y, weights=cy, minlength=n)).astype(np.int64)
        alike = (shared > 0) & (shared * 1000 >= per_mille * (total - shared))
        kept = pa.array(alike)
        yield pa.RecordBatch.from_arrays([get("x").filter(kept), get("y").filter(kept)], names=["x", "y"])


class _Links:
    """Verified links between distinct texts, and what has been compared so far."""

    def __init__(self, scratch: Scratch, texts: DataFrame, threshold: float):
        self.scratch, self.texts, self.threshold = scratch, texts, threshold
        self.compared: DataFrame | None = None
        self.links: DataFrame | None = None
        self.rounds = 0

    def compare(self, pairs: DataFrame) -> None:
        """Verify new pairs ``(x, y)``, each a pair of nodes with ``x < y``."""
        self.rounds += 1
        pairs = pairs.distinct()
        if self.compared is not None:
            pairs = pairs.join(self.compared, ["x", "y"], "left_anti")
        pairs = self.scratch.put(pairs, f"pairs-{self.rounds}")
        found = (
            pairs.join(self.texts.toDF("y", "text_y"), "y").join(self.texts.toDF("x", "text_x"), "x")
            .select("x", "y", "text_x", "text_y")
            .mapInArrow(lambda it, t=self.threshold: _verify(it, t), "x long, y long")
        )
        found = self.scratch.put(found, f"links-{self.rounds}")
        self.compared = pairs if self.compared is None else self.compared.union(pairs)
        self.links = found if self.links is None else self.links.union(found)


def _ordered(x, y) -> list:
    return [F.least(x, y).alias("x"), F.greatest(x, y).alias("y")]


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``(id, class_id)``, one row per row of ``df``: the smallest id of its near-duplicate class.

    Classes are the connected components of "similarity >= threshold"; texts with
    the same words are copies and always share a class.

    Copies are taken together first and never paired.  A bucket of any size is
    compared with one hub, its smallest member, by which a class usually becomes
    one component.  Only where a bucket still holds several components are its
    members from different components compared: with hubs of the largest one in a
    few rounds, then pair by pair.  Pairs within a component cannot change a class
    and are never made, and neither are pairs that cannot be similar because of
    the shingles that only one of them has.  No bucket is capped.

    Null and empty texts are near nothing: their class is their own id.  A null
    id never names a class that has another id.  Other columns are not looked at.
    """
    signed, named = _classes(df, id_col, text_col, threshold)
    return signed.select("id", "n_words", "a", "b").join(named, ["a", "b"], "left").select(
        F.col("id").alias(id_col), F.when(F.col("n_words") > 0, F.col("class_id")).otherwise(F.col("id")).alias("class_id")
    )


def deduplicate(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """One row of ``df`` per near-duplicate class, the one of smallest id, with all columns.

    Of rows alike in id and text one stays.  Null and empty texts are near
    nothing and stay, but for such repeated rows.
    """
    signed, named = _classes(df, id_col, text_col, threshold)
    stay = named.select(F.col("class_id").alias("id"), F.col("class_row").alias("row")).union(
        signed.where("n_words = 0").select("id", "row")
    ).select(F.coalesce("id", F.lit(NO_ID)).alias("__stay_id"), F.col("row").alias("__stay_row")).distinct()
    ids = F.col(id_col).cast("long")
    keyed = df.withColumns({"__id": F.coalesce(ids, F.lit(NO_ID)), "__row": F.xxhash64(ids, F.col(text_col))})
    kept = keyed.join(stay, (F.col("__id") == F.col("__stay_id")) & (F.col("__row") == F.col("__stay_row")), "left_semi")
    place = F.row_number().over(Window.partitionBy("__id", "__row").orderBy("__row"))
    return kept.withColumn("__place", place).where("__place = 1").select(*df.columns)


def _classes(df: DataFrame, id_col: str, text_col: str, threshold: float) -> tuple[DataFrame, DataFrame]:
    """The signed rows, and ``(a, b, class_id, class_row)`` for each distinct word sequence."""
    spark = df.sparkSession
    scratch = Scratch(spark, "minhash")
    docs = df.select(
        F.col(id_col).cast("long").alias("id"),
        F.xxhash64(F.col(id_col).cast("long"), F.col(text_col)).alias("row"),
        F.col(text_col).alias("text"),
    )
    signed = scratch.put(
        docs.mapInArrow(_sign, "id long, row long, a long, b long, n_words long, buckets array<long>"), "signed"
    )
    # One node per distinct word sequence; written once, so the numbers are fixed.
    nodes = scratch.put(
        signed.where("n_words > 0").groupBy("a", "b").agg(
            # Null ids last, so that they name no class that has another.
            F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first"),
            F.first("buckets").alias("buckets"),
            F.greatest(F.lit(1), F.first("n_words") - (SHINGLE - 1)).alias("size"),
        ).withColumns({"row": F.col("first.row"), "node": F.monotonically_increasing_id()}),
        "nodes",
    )
    member = nodes.select("node", "size", F.explode("buckets").alias("bucket"))
    hubs = scratch.put(
        member.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("hub")).where("n > 1"),
        "hubs",
    )
    shared = scratch.put(member.join(hubs, "bucket").select("bucket", "n", "hub", "node", "size"), "shared")
    wanted = nodes.select("row", "node").join(shared.select("node").distinct(), "node", "left_semi")
    texts = scratch.put(docs.select("row", "text").join(wanted, "row").select("node", "text"), "texts")

    found = _Links(scratch, texts, threshold)
    found.compare(shared.where("node <> hub").select(*_ordered("node", "hub")))
    labels = components(found.links, scratch, "first")
    n_texts = nodes.count()
    bounded = None
    for turn in range(HUB_ROUNDS + 1):
        if bounded is None:
            rest = _open_buckets(shared.where("n > 2"), labels, scratch, "open")
            if rest.isEmpty():
                break
            # Texts with too many shingles of their own have no further links, and leave.
            common = _common(texts, rest)
            bounded = scratch.put(
                rest.drop("component").join(common, "node")
                .where(F.col("common") * 1000 >= F.col("size") * round(threshold * 1000)),
                "bounded",
            )
        rest = _open_buckets(bounded, labels, scratch, f"open-{turn}")
        left = rest.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("c")).groupBy("bucket").agg(
            ((F.sum("c") * F.sum("c") - F.sum(F.col("c") * F.col("c"))) / 2).alias("p")
        ).agg(F.sum("p")).first()[0]
        if not left:
            break
        last = turn == HUB_ROUNDS or left <= PAIRS_PER_TEXT * n_texts
        found.compare(_apart(rest, threshold) if last else _hub_pairs(rest, HUBS**turn, turn, threshold))
        labels = components(found.links, scratch, f"round-{turn}")
        if last:
            break

    classes = (
        nodes.join(labels, "node").groupBy("component").agg(F.min("first").alias("class"))
        .join(labels, "component").select("node", "class")
    )
    named = nodes.join(classes, "node", "left").withColumn("class", F.coalesce("class", "first"))
    return signed, named.select("a", "b", F.col("class.id").alias("class_id"), F.col("class.row").alias("class_row"))


def _open_buckets(members: DataFrame, labels: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The members, with their component, of the buckets that hold several components."""
    labelled = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    labelled = scratch.put(labelled, f"{name}-labelled")
    several = labelled.groupBy("bucket").agg(
        F.min("component").alias("least"), F.max("component").alias("most")
    ).where("least < most").select("bucket")
    return scratch.put(labelled.join(several, "bucket", "left_semi"), name)


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.chunks(batches, "text"):
        text, shingle, count = shingle_bags(W.split(*W.flat(batch.column(batch.schema.get_field_index("text")))))
        nodes = batch.column(batch.schema.get_field_index("node")).to_numpy()[text]
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes), pa.array(shingle.view(np.int64)), pa.array(count.astype(np.int32))],
            names=["node", "shingle", "c"],
        )


def _class_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.chunks(batches, "text"):
        text, shingle, count = shingle_bags(W.split(*W.flat(batch.column(batch.schema.get_field_index("text")))))
        cell = text * CLASSES + (shingle % np.uint64(CLASSES)).astype(np.int64)
        counts = np.bincount(cell, weights=count, minlength=batch.num_rows * CLASSES).astype(np.int32)
        lists = pa.ListArray.from_arrays(
            pa.array((np.arange(batch.num_rows + 1) * CLASSES).astype(np.int32)), pa.array(counts)
        )
        yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("node")), lists], names=["node", "counts"])


def _common(texts: DataFrame, rest: DataFrame) -> DataFrame:
    """``(node, common, classes)``: how much of each text's bag other texts of open buckets have, too.

    Texts that only share a bucket by a common passage are told apart by this
    without comparing them.  ``classes`` has the number by class of shingle, by
    which copies with different changes are told apart.  One row per shingle and
    task is shuffled.
    """
    wanted = texts.join(rest.select("node").distinct(), "node", "left_semi")
    own = (
        wanted.mapInArrow(_shingles, "node long, shingle long, c int")
        .groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node"), F.sum("c").cast("int").alias("c"))
        .where("n = 1")
        .groupBy("node", F.pmod("shingle", F.lit(CLASSES)).cast("int").alias("k")).agg(F.sum("c").cast("int").alias("c"))
        .groupBy("node").agg(F.map_from_entries(F.collect_list(F.struct("k", "c"))).alias("own"))
    )
    less = F.transform("counts", lambda x, k: x - F.coalesce(F.try_element_at(F.col("own"), k), F.lit(0)))
    return (
        wanted.mapInArrow(_class_counts, "node long, counts array<int>").join(own, "node", "left")
        .select("node", F.when(F.col("own").isNull(), F.col("counts")).otherwise(less).alias("classes"))
        .withColumn("common", F.aggregate("classes", F.lit(0), lambda total, x: total + x))
    )


def _more_hubs(rest: DataFrame, hubs: int, turn: int) -> DataFrame:
    """Up to ``hubs`` members of each bucket's largest component, other ones each turn."""
    counts = rest.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("c"))
    largest = counts.groupBy("bucket").agg(F.max(F.struct("c", "component")).alias("m")).select(
        "bucket", F.col("m.component").alias("component")
    )
    order = F.xxhash64("node", F.lit(turn))
    return (
        rest.join(largest, ["bucket", "component"])
        .groupBy("bucket", F.pmod(order, F.lit(hubs)).alias("slot"))
        .agg(F.min(F.struct(order.alias("o"), "node", "component", "size", "common", "classes")).alias("hub"))
        .select("bucket", "hub.node", "hub.component", "hub.size", "hub.common", "hub.classes")
    )


def _hub_pairs(rest: DataFrame, hubs: int, turn: int, threshold: float) -> DataFrame:
    """``(x, y)``: members and hubs of a bucket, in different components, that may be similar."""
    other = _more_hubs(rest, hubs, turn).select(
        "bucket", *[F.col(c).alias(f"other_{c}") for c in ("node", "component", "size", "common", "classes")]
    )

    def similar(shares):
        return shares * 1000 >= (F.col("size") + F.col("other_size") - shares) * round(threshold * 1000)

    least = F.zip_with("classes", "other_classes", lambda a, b: F.least(a, b))
    pairs = rest.join(other, "bucket").where("component <> other_component").where(
        # Two texts share no more than the fewer shingles of either, in each class.
        similar(F.least("common", "other_common"))
        & similar(F.aggregate(least, F.lit(0), lambda total, x: total + x))
    )
    return pairs.select(*_ordered("node", "other_node"))


def _apart(rest: DataFrame, threshold: float) -> DataFrame:
    """``(x, y)``: all members of a bucket, in different components, that may be similar.

    A bucket's members are dealt to blocks, and each pair of blocks meets in one
    task, which returns only the pairs that pass.
    """
    blocks = rest.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = (
        rest.join(blocks, "bucket")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", others)
        .select(
            "bucket", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"),
            "block", "node", "component", F.col("size").cast("long").alias("size"), "common", "classes",
        )
        .repartition("bucket", "a", "b").sortWithinPartitions("bucket", "a", "b")
    )
    return met.mapInArrow(lambda it: _similar_pairs(it, threshold), "x long, y long")


def _similar_pairs(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """The pairs of each group of rows, equal in bucket and blocks, which may be spread over batches."""
    per_mille = round(threshold * 1000)
    rest: pa.Table | None = None

    def whole(rows: pa.Table, to: np.ndarray) -> Iterator[pa.RecordBatch]:
        columns = {c: rows[c].to_numpy() for c in ("a", "b", "block", "node", "component", "size", "common")}
        classes = rows["classes"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, CLASSES)
        for first, end in zip(to[:-1].tolist(), to[1:].tolist(), strict=True):
            group = {c: x[first:end] for c, x in columns.items()}
            for x, y in _block_pairs(group, classes[first:end], per_mille):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["x", "y"])

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        keys = [rows[c].to_numpy() for c in ("bucket", "a", "b")]
        new = np.zeros(max(0, rows.num_rows - 1), dtype=bool)
        for key in keys:
            new |= key[1:] != key[:-1]
        starts = np.concatenate([[0], np.flatnonzero(new) + 1])
        yield from whole(rows.slice(0, int(starts[-1])), starts)
        rest = rows.slice(int(starts[-1]))
    if rest is not None and rest.num_rows:
        yield from whole(rest, np.array([0, rest.num_rows]))


def _block_pairs(
    group: dict[str, np.ndarray], classes: np.ndarray, per_mille: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The nodes of the pairs between a group's two blocks, or within its one."""
    node, component = group["node"], group["component"]
    size, common = group["size"], group["common"].astype(np.int64)
    one = group["a"][0] == group["b"][0]
    left = np.arange(len(node)) if one else np.flatnonzero(group["block"] == group["a"][0])
    right = left if one else np.flatnonzero(group["block"] == group["b"][0])
    step = max(1, PAIRS // max(1, len(right)))
    for i in range(0, len(left), step):
        x = left[i: i + step]
        sizes = size[x, None] + size[right]
        # Two texts share no more than the fewer shingles of either, in each class.
        least = np.minimum(common[x, None], common[right])
        may = (component[x, None] != component[right]) & (least * 1000 >= (sizes - least) * per_mille)
        if one:
            may &= node[x, None] < node[right]
        row, col = np.nonzero(may)
        shares = np.minimum(classes[x[row]], classes[right[col]]).sum(axis=1, dtype=np.int64)
        good = shares * 1000 >= (sizes[row, col] - shares) * per_mille
        if good.any():
            yield node[x[row[good]]], node[right[col[good]]]
