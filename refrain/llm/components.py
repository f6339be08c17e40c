"""Connected components of a distributed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refrain.llm.store import stored


def star(edges: DataFrame) -> DataFrame:
    """Edges with the same components, in which each node's lesser neighbours hang on the least of them.

    A node that is linked with many roots keeps one, and the links between roots, being alike for many nodes, are
    reduced to one row each: of k roots shared by n nodes n + k rows stay instead of n * k. The window is over the
    lesser neighbours of one node, which are as many as the buckets and blocks it was compared in.
    """
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    down = down.withColumn("least", F.min("b").over(Window.partitionBy("a")))
    ends = F.explode(F.array("a", "b")).alias("a")
    return down.select(ends, F.col("least").alias("b")).filter("a <> b").distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """node and component (the least node reachable) of every node of ``edges`` (columns a and b).

    Each round takes the least label among neighbours and then the label of that label, so that chains shorten by
    doubling. Only labels and edges are shuffled, minima are combined before, and a node with many edges may be
    split. Nulls are not allowed.
    """
    edges = star(edges)
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.filter("a <> b").distinct(), f"{name}-edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("component")), f"{name}-labels")
    while True:
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("component").alias("seen")
        )
        near = labels.join(seen, "node").select("node", "component", F.least("component", "seen").alias("least"))
        near = stored(near, f"{name}-near")
        jump = labels.select(F.col("node").alias("least"), F.col("component").alias("next"))
        after = near.join(jump, "least").select(
            "node", F.least("least", "next").alias("component"), (F.least("least", "next") < F.col("component")).alias("moved")
        )
        after = stored(after, f"{name}-labels")
        labels = after.select("node", "component")
        if after.filter("moved").isEmpty():
            return labels
