"""Approximate nearest neighbours by inner product: small-world graphs, one per shard.

Vectors are dealt to shards by their id's hash.  Each shard gets a hierarchical
navigable small-world graph over its distinct vectors, stored as flat neighbour
arrays.  Every query is searched in every shard's graph, in blocks of queries,
and the shards' results are merged.

Within a task points are inserted, and queries searched, many at a time: one
step expands the best open candidate of each.  Points inserted together do not
see each other, so a group is at most a quarter of what is already there.

The graph works on vectors extended by one component to equal length, which
turns the largest inner product into the smallest angle.  Scores are computed
from the given vectors in double precision.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmill.llm.base import Scratch

LINKS = 16          # per node on the upper layers; twice that on the lowest
BUILD_WIDTH = 64    # candidates kept while inserting
SEARCH_WIDTH = 200  # candidates kept while searching
GROUP = 256         # points or queries worked on together
SHARD_ROWS = 8_192  # vectors of a shard, and
SHARD_BYTES = 1 << 26  # their bytes, at most
QUERY_BLOCK = 16_384


@dataclass
class Graph:
    """``layers[l]``: neighbours of every node on layer ``l``, -1 for none; ``entry`` is on the last."""

    points: np.ndarray
    layers: list[np.ndarray]
    entry: int


def extended(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors with one more component, by which all have equal length."""
    squares = (vectors.astype(np.float64) ** 2).sum(axis=1)
    longest = squares.max(initial=1e-300)
    rest = np.sqrt(np.maximum(0.0, longest - squares))
    return (np.column_stack([vectors, rest]) / np.sqrt(longest)).astype(np.float32)


def _beam(points: np.ndarray, links: np.ndarray, queries: np.ndarray, start: np.ndarray, width: int):
    """The ``width`` nearest nodes found for each query, nearest first (-1 where fewer).

    ``start``: known nodes to begin from, ``[query, any number]``, -1 for none.
    """
    b = len(queries)
    rows = np.arange(b)
    visited = np.zeros((b, len(points) + 1), dtype=bool)
    visited[:, -1] = True  # where -1 points to
    ids = np.full((b, width), -1, dtype=np.int64)
    near = np.full((b, width), -np.inf, dtype=np.float32)
    open_ = np.zeros((b, width), dtype=bool)
    new = start[:, :width].astype(np.int64)
    while True:
        seen = visited[rows[:, None], new]
        sims = np.einsum("bd,bkd->bk", queries, points[new])
        sims[seen] = -np.inf
        visited[rows[:, None], new] = True
        all_ids = np.concatenate([ids, new], axis=1)
        all_near = np.concatenate([near, sims], axis=1)
        all_open = np.concatenate([open_, ~seen], axis=1)
        best = np.argsort(-all_near, axis=1, kind="stable")[:, :width]
        ids, near = np.take_along_axis(all_ids, best, 1), np.take_along_axis(all_near, best, 1)
        open_ = np.take_along_axis(all_open, best, 1) & np.isfinite(near)
        on = open_.any(axis=1)
        if not on.any():
            ids[~np.isfinite(near)] = -1
            return ids, near
        first = open_.argmax(axis=1)
        new = np.full((b, links.shape[1]), -1, dtype=np.int64)
        new[on] = links[ids[on, first[on]]]
        open_[rows[on], first[on]] = False


def _diverse(points: np.ndarray, of: np.ndarray, ids: np.ndarray, near: np.ndarray, n: int) -> np.ndarray:
    """``n`` of each node's candidates (nearest first, -1 for none), in different directions.

    A candidate nearer to a chosen one than to the node waits; places left over
    go to the nearest that waited.
    """
    valid = (ids >= 0) & (ids != of[:, None])
    vectors = points[ids]
    between = vectors @ vectors.transpose(0, 2, 1)
    chosen = np.zeros(ids.shape, dtype=bool)
    for i in range(ids.shape[1]):
        covered = (chosen & (between[:, i, :] > near[:, i, None])).any(axis=1)
        chosen[:, i] = valid[:, i] & ~covered & (chosen.sum(axis=1) < n)
    rank = np.where(chosen, 0, np.where(valid, 1, 2)) * ids.shape[1] + np.arange(ids.shape[1])
    order = np.argsort(rank, axis=1)[:, :n]
    picked = np.where(np.take_along_axis(valid, order, 1), np.take_along_axis(ids, order, 1), -1)
    if picked.shape[1] < n:
        picked = np.pad(picked, ((0, 0), (0, n - picked.shape[1])), constant_values=-1)
    return picked


def _link_back(points: np.ndarray, links: np.ndarray, sources: np.ndarray, targets: np.ndarray) -> None:
    """Add the links from ``targets`` to ``sources``; full nodes choose anew."""
    width = links.shape[1]
    order = np.lexsort((-np.einsum("ij,ij->i", points[sources], points[targets]), targets))
    sources, targets = sources[order], targets[order]
    nodes, first, counts = np.unique(targets, return_index=True, return_counts=True)
    place = np.arange(len(targets)) - np.repeat(first, counts)
    kept = place < width  # of more new links than fit, the nearest
    added = np.full((len(nodes), min(width, int(counts.max()))), -1, dtype=np.int64)
    added[np.repeat(np.arange(len(nodes)), counts)[kept], place[kept]] = sources[kept]
    for i in range(0, len(nodes), GROUP):
        own = nodes[i: i + GROUP]
        ids = np.concatenate([links[own], added[i: i + GROUP]], axis=1)
        near = np.einsum("bd,bkd->bk", points[own], points[ids])
        near[ids < 0] = -np.inf
        order = np.argsort(-near, axis=1, kind="stable")
        ids, near = np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)
        links[own] = _diverse(points, own, ids, near, width)


def build(vectors: np.ndarray, seed: int = 11) -> Graph:
    points = extended(vectors)
    n = len(points)
    rng = np.random.default_rng(seed)
    level = np.minimum(-np.log(1 - rng.random(n)) / np.log(LINKS), 8).astype(np.int64)
    order = rng.permutation(n)
    entry = int(order[0])
    layers = [
        np.full((n, 2 * LINKS if l == 0 else LINKS), -1, dtype=np.int32) for l in range(int(level.max()) + 1)
    ]
    done = 1
    while done < n:
        group = order[done: done + min(GROUP, max(1, done // 4))]
        start = np.full((len(group), 1), entry, dtype=np.int64)
        for l in range(len(layers) - 1, -1, -1):
            in_layer = level[group] >= l
            if l > level[entry]:
                continue
            width = BUILD_WIDTH if in_layer.any() else 1
            ids, near = _beam(points, layers[l], points[group], start, width)
            own = group[in_layer]
            if len(own):
                picked = _diverse(points, own, ids[in_layer], near[in_layer], LINKS)
                layers[l][own, :LINKS] = picked
                at, k = np.nonzero(picked >= 0)
                if len(at):
                    _link_back(points, layers[l], own[at], picked[at, k])
            start = ids
        top = group[level[group].argmax()]
        if level[top] > level[entry]:
            entry = int(top)
        done += len(group)
    return Graph(points, layers, entry)


def search(graph: Graph, queries: np.ndarray, width: int = SEARCH_WIDTH) -> np.ndarray:
    """The nodes found nearest to each query, ``width`` at most (-1 where fewer)."""
    norms = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1, keepdims=True))
    q = np.column_stack([queries / norms, np.zeros(len(queries))]).astype(np.float32)
    out = np.full((len(q), width), -1, dtype=np.int64)
    for i in range(0, len(q), GROUP):
        part = q[i: i + GROUP]
        start = np.full((len(part), 1), graph.entry, dtype=np.int64)
        for l in range(len(graph.layers) - 1, 0, -1):
            start, _ = _beam(graph.points, graph.layers[l], part, start, 4)
        out[i: i + GROUP], _ = _beam(graph.points, graph.layers[0], part, start, width)
    return out


def _matrix(column: pa.ChunkedArray | pa.Array, dimension: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _one_list(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, values.size], pa.int32()), pa.array(values.reshape(-1)))


_GRAPH = (
    "shard int, vectors array<double>, first array<long>, ids array<long>, links array<int>, "
    "upper array<int>, entry int"
)


def _build_shard(rows: pa.Table, dimension: int) -> pa.Table:
    """One row: distinct vectors, their ids (flat), and the flat neighbour arrays of all layers."""
    vectors = np.ascontiguousarray(_matrix(rows["vector"], dimension), dtype=np.float64)
    ids = rows["id"].to_numpy()
    keys = (vectors + 0.0).view([("", vectors.dtype)] * dimension).reshape(-1)
    _, at, inverse = np.unique(keys, return_index=True, return_inverse=True)
    order = np.lexsort((ids, inverse))
    first = np.concatenate([[0], np.cumsum(np.bincount(inverse, minlength=len(at)))])
    graph = build(vectors[at])
    upper = np.stack(graph.layers[1:]) if len(graph.layers) > 1 else np.zeros(0, np.int32)
    columns = [
        pa.array([rows["shard"][0].as_py()], pa.int32()), _one_list(vectors[at]), _one_list(first.astype(np.int64)),
        _one_list(ids[order]), _one_list(graph.layers[0]), _one_list(upper), pa.array([graph.entry], pa.int32()),
    ]
    return pa.Table.from_arrays(columns, names=[f.split()[0] for f in _GRAPH.split(", ")])


def _search_block(graphs: pa.Table, queries: pa.Table, dimension: int, k: int, width: int) -> pa.Table:
    """``(query_id, vec_id, score)``: the ``k`` best of one shard for a block of queries."""
    out: list[np.ndarray] = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    if graphs.num_rows and queries.num_rows:
        get = lambda c: graphs[c].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        vectors = get("vectors").reshape(-1, dimension)
        n = len(vectors)
        upper = get("upper").reshape(-1, n, LINKS)
        layers = [get("links").reshape(n, 2 * LINKS), *upper]
        graph = Graph(extended(vectors), layers, graphs["entry"][0].as_py())
        out = _best(graph, vectors, get("first"), get("ids"), _matrix(queries["vector"], dimension),
                    queries["id"].to_numpy(), k, width)
    return pa.table({"query_id": out[0], "vec_id": out[1], "score": out[2]})


def _best(graph, vectors, first, ids, queries, query_ids, k, width) -> list[np.ndarray]:
    found = search(graph, queries, width)
    parts: list[tuple] = []
    for i in range(0, len(found), GROUP):
        nodes = found[i: i + GROUP]
        row, col = np.nonzero(nodes >= 0)
        node = nodes[row, col]
        score = (queries[i: i + GROUP][row].astype(np.float64) * vectors[node]).sum(axis=1)
        # Of a vector's copies no more than the k + 1 smallest ids can be among the best.
        take = np.minimum(first[node + 1] - first[node], k + 1)
        copy = np.arange(take.sum()) - np.repeat(np.cumsum(take) - take, take)
        vec = ids[np.repeat(first[node], take) + copy]
        row, score = np.repeat(row, take), np.repeat(score, take)
        other = vec != query_ids[i: i + GROUP][row]
        row, vec, score = row[other], vec[other], score[other]
        order = np.lexsort((vec, -score, row))
        row, vec, score = row[order], vec[order], score[order]
        start = np.searchsorted(row, np.arange(len(nodes)))
        keep = np.arange(len(row)) - start[row] < k
        parts.append((query_ids[i: i + GROUP][row[keep]], vec[keep], score[keep]))
    return [np.concatenate(x) for x in zip(*parts, strict=True)]


def usable(vector: Column) -> Column:
    """Whether a vector takes part: no null or non-finite component, not zero, not null or empty."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(
    df: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding",
    width: int = SEARCH_WIDTH,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query row's ``k`` nearest other rows found.

    ``is_query`` is a condition on the id.  Nearness is the inner product; ties
    go to the smaller id.  With fewer than ``k`` candidates all found are listed.

    Rows with a null id, and vectors that are null, empty, zero or hold null or
    non-finite components, take no part.  Shorter vectors are extended by zeros to
    the longest one's length.  Rows sharing an id count once, with the smallest
    vector; an empty table gives no rows.  Copies of a vector are one node of a graph
    with several ids, so a vector repeated in a third of all rows costs no links.

    A shard holds some ``SHARD_ROWS`` vectors, fewer where these would exceed
    ``SHARD_BYTES``, so a task's memory is bounded and the result does not depend on
    the cluster.  Graphs are written to the shared folder before they are searched.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "hnsw")
    vectors = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    vectors = vectors.where(F.col("id").isNotNull() & usable(F.col("vector")))
    n, d = vectors.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shards = -(-n // max(1, min(SHARD_ROWS, SHARD_BYTES // (8 * d))))
    full = F.concat("vector", F.array_repeat(F.lit(0.0), F.lit(d) - F.size("vector")))
    vectors = scratch.put(
        vectors.groupBy("id").agg(F.min("vector").alias("vector")).withColumn("vector", full)
        .withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")),
        "vectors",
    )
    # A count of partitions that is given is not lowered at run time, so shards do not share a task but by chance.
    graphs = scratch.put(
        vectors.repartition(2 * shards, "shard").groupBy("shard").applyInArrow(lambda rows: _build_shard(rows, d), _GRAPH),
        "graphs",
    )
    queries = vectors.withColumnRenamed("id", id_col).where(is_query).withColumnRenamed(id_col, "id")
    blocks = -(-max(1, queries.count()) // QUERY_BLOCK)
    block = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int")
    asked = queries.select("id", "vector", block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    served = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = served.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(
        lambda graph, rows: _search_block(graph, rows, d, k, width), "query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
