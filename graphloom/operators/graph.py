"""Graph lookups and traversal over node and edge tables, for any number of seeds at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lineage import cut

#: A node with more neighbours is a hub.
HEAVY = 20_000


def incident(edges: DataFrame) -> DataFrame:
    """Each edge twice, seen from either end: (at, other, edge columns)."""
    ends = F.array(F.struct(F.col("source").alias("at"), F.col("target").alias("other")), F.struct(F.col("target").alias("at"), F.col("source").alias("other")))
    return edges.select(F.inline(ends), "*")


def entity(nodes: DataFrame, name: str) -> DataFrame:
    return nodes.where(F.col("name") == name)


def entity_relations(edges: DataFrame, names: DataFrame) -> DataFrame:
    """Edges out of and into the named entities: (name, source, target, relation, description, weight)."""
    seen = incident(edges).join(names.select(F.col("name").alias("at")).distinct(), "at", "left_semi")
    return seen.select(F.col("at").alias("name"), "source", "target", "relation", "description", "weight").distinct()


def _parts(step: DataFrame) -> DataFrame | None:
    """(at, parts): nodes with more than HEAVY neighbours and over how many parts these are dealt; None if there are none. There is at most one such node for each HEAVY edges."""
    heavy = cut(step.groupBy("at").agg(F.count("*").alias("n")).where(F.col("n") > HEAVY).select("at", F.ceil(F.col("n") / HEAVY).cast("int").alias("parts")))
    return None if heavy.isEmpty() else heavy


def _meet(front: DataFrame, at: str, step: DataFrame, heavy: DataFrame | None) -> DataFrame:
    """front joined with ``step`` (at, other, ...) where its column ``at`` is step's. A hub's neighbours are dealt over several tasks, and what stands at the hub goes to each."""
    if heavy is None:
        return front.join(step.withColumnRenamed("at", at), at)
    key = heavy.withColumnRenamed("at", at)
    dealt = step.withColumnRenamed("at", at).join(key, at, "left").withColumn("_part", F.pmod(F.xxhash64("other"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
    every = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))
    return front.join(key, at, "left").withColumn("_part", every).drop("parts").join(dealt, [at, "_part"]).drop("_part")


def reached(edges: DataFrame, seeds: DataFrame, depth: int) -> DataFrame:
    """(seed, name, distance): nodes within ``depth`` steps along edges of either direction.

    One join a step; a frontier meets only edges, and nodes seen before drop out.
    """
    seen = seeds.select(F.col("name").alias("seed"), "name", F.lit(0).alias("distance"))
    if depth < 1:
        return seen
    step = incident(edges.select("source", "target")).select("at", "other").distinct()
    front, heavy = seen, _parts(step)
    for d in range(1, depth + 1):
        nearby = _meet(front.select("seed", F.col("name").alias("here")), "here", step, heavy).select("seed", F.col("other").alias("name")).distinct()
        front = nearby.join(seen.select("seed", "name"), ["seed", "name"], "left_anti").withColumn("distance", F.lit(d))
        seen = seen.unionByName(front)
    return seen


def neighbors(edges: DataFrame, seeds: DataFrame, depth: int = 1, limit: int = 50) -> DataFrame:
    """Edges on paths of at most ``depth`` steps from a seed, the first ``limit`` in order of all columns."""
    near = reached(edges, seeds, depth - 1).select("seed", F.col("name").alias("here"))
    sides = incident(edges)
    found = _meet(near, "here", sides, _parts(sides)).select("seed", "source", "relation", "target", "description", "weight").distinct()
    order = Window.partitionBy("seed").orderBy("source", "relation", "target", "description", "weight")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def subgraph_nodes(nodes: DataFrame, edges: DataFrame, seeds: DataFrame, depth: int = 1) -> DataFrame:
    names = reached(edges, seeds.join(nodes.select("name"), "name", "left_semi"), depth).select("name").distinct()
    return nodes.join(names, "name", "left_semi")


def subgraph_edges(nodes: DataFrame, edges: DataFrame, seeds: DataFrame, depth: int = 1) -> DataFrame:
    """Edges between the subgraph's nodes."""
    inside = subgraph_nodes(nodes, edges, seeds, depth).select("name")
    for end in ("source", "target"):
        edges = edges.join(inside.withColumnRenamed("name", end), end, "left_semi")
    return edges


def stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: nodes, edges."""
    n = nodes.agg(F.count("*").alias("nodes")).withColumn("one", F.lit(1))
    return n.join(edges.agg(F.count("*").alias("edges")).withColumn("one", F.lit(1)), "one").drop("one")
