"""Near-duplicate embeddings: small-world graphs per shard, every shard queried.

Distinct vectors of a label are dealt to shards of bounded size, and each shard
gets a hierarchical navigable small-world graph.  Two shards of a label, or a
shard with itself, meet in one task: the vectors of each are searched in the
other's graph.  A search runs a beam and then opens every node near the limit
until none is left, so a group of copies of any size is found whole.  Some of
the queries are checked against all vectors of the shard; if links are missing,
parts of the graph are out of reach, and all vectors of the two shards are
compared in blocks: shards are bounded, and this costs less than a search with
wider beams.  Cosines are verified in double precision.

A task returns how many links each vector has and a spanning forest of them,
never the pairs, so that a group of near copies costs its size and not its square.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmill.llm.base import Scratch
from segmill.llm.components import components
from segmill.llm.hnsw import GROUP, LINKS, Graph, _beam, build
from segmill.llm.vectors import finite, longest, matrix, of_length

SHARD_ROWS = 8_192           # at most, in a shard
SHARD_BYTES = 32 << 20       # of vectors, at most, in a shard
WIDTH, MARGIN = 32, 0.03     # of a search: beam, and what counts as near the limit
AUDITED = 512                # queries of a search that are checked
RECALL = 0.999               # of their links that must be found
ROUNDING = 1e-4              # by which cosines in single precision may be off
PAIRS = 1 << 18              # worked on together

_SHARD = (
    "label string, shard int, node array<long>, copies array<long>, vectors array<double>, "
    "links array<int>, upper array<int>, entry int"
)


@dataclass
class Shard:
    """``unit``: vectors of length one; ``node``, ``copies``: the key of each and how often it occurs."""

    node: np.ndarray
    copies: np.ndarray
    unit: np.ndarray
    graph: Graph


def unit_vectors(vectors: np.ndarray) -> np.ndarray:
    """Rows divided by their length; by their largest component first, so that nothing overflows."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _list(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, values.size], pa.int32()), pa.array(values.reshape(-1), kind))


def _build(rows: pa.Table, d: int) -> pa.Table:
    """One row: a shard's vectors and the flat neighbour arrays of its graph."""
    vectors = matrix(rows["vector"], d)
    ids, node = rows["id"].to_numpy(), rows["node"].to_numpy()
    order = np.lexsort((*vectors.T[::-1], ids))
    unit = unit_vectors(vectors[order])
    graph = build(unit)
    upper = np.stack(graph.layers[1:]) if len(graph.layers) > 1 else np.zeros(0, np.int32)
    return pa.Table.from_arrays([
        pa.array([rows["label"][0].as_py()], pa.string()), pa.array([rows["shard"][0].as_py()], pa.int32()),
        _list(node[order], pa.int64()), _list(rows["copies"].to_numpy()[order], pa.int64()),
        _list(unit, pa.float64()), _list(graph.layers[0], pa.int32()), _list(upper, pa.int32()),
        pa.array([graph.entry], pa.int32()),
    ], names=[c.split()[0] for c in _SHARD.split(", ")])


def _shard(rows: pa.Table, i: int, d: int) -> Shard:
    get = lambda c: rows[c].chunk(0)[i].values.to_numpy(zero_copy_only=False)
    node, unit = get("node"), get("vectors").reshape(-1, d)
    n = len(node)
    # As `build` has them: one more component, which is zero for unit vectors.
    points = np.column_stack([unit, np.zeros(n)]).astype(np.float32)
    layers = [get("links").reshape(n, 2 * LINKS), *get("upper").reshape(-1, n, LINKS)]
    return Shard(node, get("copies"), unit, Graph(points, layers, rows["entry"][i].as_py()))


def _cosines(a: np.ndarray, b: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    """``a[row] . b[col]`` in double precision, a bounded number of pairs at a time."""
    parts = [
        np.einsum("ij,ij->i", a[row[i: i + PAIRS]], b[col[i: i + PAIRS]]) for i in range(0, len(row), PAIRS)
    ]
    return np.concatenate(parts) if parts else np.zeros(0)


def _around(graph: Graph, queries: np.ndarray, limit: float, width: int, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """``(query, node)`` of the nodes found whose cosine may reach ``limit``.

    A beam of ``width``, then every node within ``margin`` of the limit is opened.
    """
    n, b = len(graph.points), len(queries)
    start = np.full((b, 1), graph.entry, dtype=np.int64)
    for l in range(len(graph.layers) - 1, 0, -1):
        start, _ = _beam(graph.points, graph.layers[l], queries, start, 4)
    ids, near = _beam(graph.points, graph.layers[0], queries, start, width)
    seen = np.zeros(b * n, dtype=bool)
    row, k = np.nonzero(ids >= 0)
    node, sim = ids[row, k], near[row, k]
    seen[row * n + node] = True
    found = []
    while len(node):
        close = sim >= limit - ROUNDING
        found.append((row[close], node[close]))
        open_ = sim >= limit - margin
        row, node, more = row[open_], node[open_], []
        for i in range(0, len(row), PAIRS // (2 * LINKS)):
            part = slice(i, i + PAIRS // (2 * LINKS))
            to = graph.layers[0][node[part]]
            key = (row[part, None] * n + to)[to >= 0]
            key = np.unique(key[~seen[key]])
            seen[key] = True
            r, t = key // n, key % n
            more.append((r, t, np.einsum("ij,ij->i", queries[r], graph.points[t])))
        row, node, sim = (np.concatenate(x) for x in zip(*more, strict=True)) if more else (row[:0], node[:0], sim[:0])
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (row, node)


def _search(of: Shard, into: Shard, limit: float) -> np.ndarray:
    """``[query, node]``: whether a link was found from a vector of ``of`` to one of ``into``."""
    n, m = len(of.node), len(into.node)
    audited = np.unique(np.linspace(0, n - 1, min(n, AUDITED)).astype(np.int64))
    truth = of.unit[audited] @ into.unit.T >= limit
    queries = np.column_stack([of.unit, np.zeros(n)]).astype(np.float32)
    linked = np.zeros((n, m), dtype=bool)
    for i in range(0, n, GROUP):
        row, col = _around(into.graph, queries[i: i + GROUP], limit, min(WIDTH, m), MARGIN)
        row = row + i
        good = _cosines(of.unit, into.unit, row, col) >= limit
        linked[row[good], col[good]] = True
    if (linked[audited] & truth).sum() < RECALL * truth.sum():
        for i in range(0, n, GROUP):
            linked[i: i + GROUP] = of.unit[i: i + GROUP] @ into.unit.T >= limit
    return linked


def _forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, column)`` of links that connect whatever ``linked`` connects."""
    across = np.ascontiguousarray(linked.T)
    rows_left, cols_left = linked.any(axis=1), np.ones(linked.shape[1], dtype=bool)
    out: list[tuple[int, np.ndarray, bool]] = []
    for first in np.flatnonzero(rows_left):
        if not rows_left[first]:
            continue
        rows_left[first] = False
        todo: list[tuple[int, bool]] = [(int(first), True)]
        while todo:
            at, is_row = todo.pop()
            left = cols_left if is_row else rows_left
            new = np.flatnonzero((linked[at] if is_row else across[at]) & left)
            left[new] = False
            out.append((at, new, is_row))
            todo += [(int(x), not is_row) for x in new]
    row = [np.full(len(new), at) if is_row else new for at, new, is_row in out]
    col = [new if is_row else np.full(len(new), at) for at, new, is_row in out]
    empty = np.zeros(0, dtype=np.int64)
    return np.concatenate([empty, *row]), np.concatenate([empty, *col])


_FOUND = "x long, y long, links long"


def _meet(graphs: pa.Table, d: int, limit: float) -> pa.Table:
    """Two shards, or one with itself: ``(x, null, links)`` for each vector, ``(x, y, null)`` of a forest."""
    graphs = graphs.combine_chunks()
    a = _shard(graphs, 0, d)
    if graphs.num_rows == 1:
        b, linked = a, _search(a, a, limit)
        linked |= linked.T.copy()
        np.fill_diagonal(linked, False)
    else:
        b = _shard(graphs, 1, d)
        linked = _search(a, b, limit)
        linked |= _search(b, a, limit).T
    counts = [(a.node, _weighted(linked, b.copies))]
    if b is not a:
        counts.append((b.node, _weighted(linked.T, a.copies)))
    node = np.concatenate([x for x, _ in counts])
    links = np.concatenate([x for _, x in counts])
    some = links > 0
    row, col = _forest(linked)
    none = lambda n: pa.nulls(n, pa.int64())
    return pa.table({
        "x": pa.concat_arrays([pa.array(node[some], pa.int64()), pa.array(a.node[row], pa.int64())]),
        "y": pa.concat_arrays([none(int(some.sum())), pa.array(b.node[col], pa.int64())]),
        "links": pa.concat_arrays([pa.array(links[some], pa.int64()), none(len(row))]),
    })


def _weighted(linked: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """The copies that each row is linked with."""
    return np.array([copies[x].sum() for x in linked], dtype=np.int64)


def near_duplicates(
    df: DataFrame, limit: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``(id, n_links, component_id, kept)``, a row for each row of ``df``.

    Rows of equal label are linked if their cosine, in double precision, is at
    least ``limit``; a component goes by its smallest id.  Rows whose id or label
    is null, and vectors that are null, empty, zero or hold null or non-finite
    components, are linked with nothing and kept (a null id is not).  Of vectors
    of different lengths the shorter is extended by zeros.  Rows are told apart by
    position, so rows that repeat an id count each: repeated rows are copies.

    Copies are one node, so a vector repeated in a third of all rows costs no
    search.  A label with very many vectors has many shards, and each pair of
    its shards is a task of bounded memory.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "neardup")
    vector = F.col("vector")
    rows = df.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    takes_part = F.col("id").isNotNull() & F.col("label").isNotNull() & finite(vector)
    takes_part = takes_part & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))
    d = longest(rows.where(takes_part), "vector")
    # Adding zero makes equal what only differs in the sign of a zero.
    long_enough = F.transform(of_length(vector, d, F.lit(0.0)), lambda x: x + 0.0)
    rows = scratch.put(
        rows.select("id", "label", F.when(takes_part, long_enough).alias("vector"))
        .withColumn("h", F.xxhash64("label", "vector")),
        "rows",
    )
    taken = rows.where(F.col("vector").isNotNull())
    nodes = scratch.put(
        taken.groupBy("label", "h", "vector").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    cap = max(1, min(SHARD_ROWS, SHARD_BYTES // (8 * max(1, d))))
    shards = scratch.put(
        nodes.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / cap).cast("int").alias("shards")), "shards"
    )
    dealt = nodes.join(shards, "label").withColumn("shard", F.pmod(F.xxhash64("node"), F.col("shards")).cast("int"))
    graphs = scratch.put(
        dealt.select("label", "shard", "id", "node", "copies", "vector")
        .groupBy("label", "shard").applyInArrow(lambda t: _build(t, d), _SHARD),
        "graphs",
    )
    # Each shard goes to the tasks of all pairs it is in.
    others = F.explode(F.sequence(F.lit(0), F.col("shards") - 1))
    asked = graphs.join(shards, "label").withColumn("other", others).select(
        *graphs.columns, F.least("shard", "other").alias("a"), F.greatest("shard", "other").alias("b")
    )
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    found = scratch.put(
        asked.repartition(parts, "label", "a", "b").groupBy("label", "a", "b")
        .applyInArrow(lambda t: _meet(t, d, limit), _FOUND),
        "found",
    )
    counts = found.where(F.col("y").isNull()).groupBy(F.col("x").alias("node")).agg(F.sum("links").alias("links"))
    classes = components(found.where(F.col("y").isNotNull()).select("x", "y"), scratch, "classes")
    known = scratch.put(
        nodes.select("node", "label", "h", "vector", "id", "copies")
        .join(counts, "node", "left").join(classes, "node", "left")
        .withColumn("component", F.coalesce("component", "node")),
        "known",
    )
    scratch.keep_only("rows", "known")
    smallest = known.groupBy("component").agg(F.min("id").alias("component_id"))
    known = known.join(smallest, "component").select(
        "label", "h", "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), "component_id"
    )
    out = rows.join(known, ["label", "h", "vector"], "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
