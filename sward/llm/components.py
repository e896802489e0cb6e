"""Connected components of a graph that is never held in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sward.session import discard, materialise


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links`` (``a, b``); the component is its smallest node.

    Every round gives each node the smallest label among its neighbours and then its label's label, so that chains
    shrink by halves; a round is two joins and two combined aggregates, written to the shared folder. Labels are read
    from written tables, so AQE can split the join on a node that a large part of all links lead to.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where(F.col("a") != F.col("b")).distinct()
    edges = materialise(both, "edges")
    labels = materialise(edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = edges.join(labels, edges["b"] == labels["node"]).select(F.col("a").alias("node"), "label")
        low = near.union(labels.select("node", "label")).groupBy("node").agg(F.min("label").alias("low"))
        up = labels.select(F.col("node").alias("_n"), F.col("label").alias("up"))
        jumped = low.join(up, F.col("low") == F.col("_n")).select("node", F.least("low", "up").alias("label"))
        new = materialise(jumped, "labels")
        changed = new.join(labels.withColumnRenamed("label", "old"), "node").where("label <> old").limit(1).count()
        discard(labels)
        labels = new
        if not changed:
            discard(edges)
            return labels.select("node", F.col("label").alias("component"))
