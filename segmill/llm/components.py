"""Connected components of an undirected graph kept in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmill.llm.base import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``(node, component)`` for the nodes of ``(x, y)``; the component is its smallest node.

    Labels spread along the edges and, each round, jump to their label's label,
    so the rounds grow with the logarithm of the longest path.  Each round is
    written to the shared folder.  Neighbours are aggregated with a partial
    step; a node with very many edges is only a skewed join key.
    """
    both = scratch.put(
        edges.select("x", "y").union(edges.select(F.col("y"), F.col("x"))).toDF("node", "other").distinct(),
        f"{name}-edges",
    )
    labels = scratch.put(
        both.groupBy("node").agg(F.min("other").alias("m"))
        .select("node", F.least("node", "m").alias("component")),
        f"{name}-0",
    )
    step = 0
    while True:
        step += 1
        near = (
            both.join(labels.toDF("other", "component"), "other")
            .groupBy("node").agg(F.min("component").alias("seen"))
        )
        spread = labels.join(near, "node").select(
            "node", F.col("component").alias("was"), F.least("component", "seen").alias("label")
        )
        jumped = scratch.put(
            spread.join(labels.toDF("label", "next"), "label")
            .select("node", "was", F.least("label", "next").alias("component")),
            f"{name}-{step}",
        )
        scratch.drop(f"{name}-{step - 1}")
        labels = jumped.select("node", "component")
        if jumped.where("was <> component").isEmpty():
            return labels
