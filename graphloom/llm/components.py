"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spread_join, stage


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) edges -> (node, label), the label being a component's smallest node; only nodes that have an edge.

    Each round is two joins on minima that are aggregated first, so a node with very
    many neighbours is never gathered, and its edges are dealt over several tasks; rounds grow with the
    logarithm of the largest component, and each is written to the shared folder.
    """
    edges = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    if edges.isEmpty():
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    before = None
    while True:
        # large star: every neighbour above u goes to the smallest node u knows
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = stage(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("n")))
        large = spread_join(both.where("v > u"), least, ["u"]).select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: u and its lower neighbours go to the lowest of them
        large = stage(large)
        lowest = stage(large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")))
        moved = spread_join(large, lowest, ["a"]).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stage(moved.union(lowest.select("a", F.col("m").alias("b"))).distinct())
        n, h = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if before == (n, h):
            break
        before = (n, h)
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return stars.union(stars.select("label", "label").distinct().toDF("node", "label"))
