"""Connected components of a graph in a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard
from .common import stored


def connected(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) for every node of ``edges`` (columns ``a`` and
    ``b``, no nulls). Each round hooks every label to its smallest neighbour, halves the paths of labels, and
    contracts the edges; edges inside one label vanish. Rounds grow with the logarithm of a component's size."""
    edges = stored(edges.select("a", "b").where("a <> b").distinct(), "edges")
    labels = stored(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node")), "labels")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # A hot label meets as partial minima.
        parent = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("x"), F.least("a", "b").alias("p"))
        for _ in range(2):
            above, before = parent.select(F.col("x").alias("p"), F.col("p").alias("pp")), parent
            parent = stored(parent.join(above, "p").select("x", F.col("pp").alias("p")), "parents")
            discard(before)
        old = parent, labels, edges
        labels = stored(labels.join(parent, labels["component"] == parent["x"], "left")
                        .select("node", F.coalesce("p", "component").alias("component")), "labels")
        a, b = parent.select(F.col("x").alias("a"), F.col("p").alias("pa")), parent.select(F.col("x").alias("b"), F.col("p").alias("pb"))
        edges = stored(edges.join(a, "a").join(b, "b").where("pa <> pb")
                       .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
        discard(*old)
    discard(edges)
    return labels
