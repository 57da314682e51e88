"""Merging extracted entities and relations into a property graph of node and edge tables.

Order is meaning here (first type seen, first descriptions), so raw rows carry
(chunk_idx, pos) and every aggregate sorts by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Numbers of chunks that a page of the mapping spans.
PAGE = 1000


def _seen() -> Column:
    return F.struct("chunk_idx", "pos")


def first_distinct(raw: DataFrame, key: list[str], value: str, n: int, sep: str = " | ") -> DataFrame:
    """(key, value): the first n distinct values of each key that are not empty, in order of appearance.

    Each value is first reduced to its earliest place; no more than n of a key are gathered.
    """
    firsts = raw.where(F.col(value) != "").groupBy(*key, value).agg(F.min(_seen()).alias("first"))
    order = Window.partitionBy(*key).orderBy("first", value)
    firsts = firsts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)
    pairs = F.array_sort(F.collect_list(F.struct("place", F.col(value).alias("v"))))
    return firsts.groupBy(*key).agg(F.array_join(F.transform(pairs, lambda p: p["v"]), sep).alias(value))


def filter_entities(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("name") != "")


def filter_relations(relations: DataFrame, entities: DataFrame) -> DataFrame:
    """Keeps relations between two different entities that their own chunk names."""
    names = entities.select("chunk_idx", "name").distinct()
    kept = relations.where((F.col("source") != "") & (F.col("target") != "") & (F.col("source") != F.col("target")))
    for end in ("source", "target"):
        kept = kept.join(names.withColumnRenamed("name", end), ["chunk_idx", end], "left_semi")
    return kept


def add_keywords(entities: DataFrame, keywords: DataFrame) -> DataFrame:
    """Entities with the keywords (chunk_idx, name, pos) their chunk does not name yet, typed TERM_YAKE."""
    first = keywords.groupBy("chunk_idx", "name").agg(F.min("pos").alias("pos"))
    new = first.join(entities.select("chunk_idx", "name").distinct(), ["chunk_idx", "name"], "left_anti")
    return entities.unionByName(new.select("chunk_idx", "pos", "name", F.lit("TERM_YAKE").alias("type"), F.lit("").alias("description")))


def merge_entities(raw: DataFrame) -> DataFrame:
    """One node a name: most frequent type (first seen on ties), first three descriptions, chunks, mentions.

    Types and descriptions are counted per (name, value) first, so a name that is
    everywhere shuffles a row for each task and value.
    """
    types = raw.groupBy("name", "type").agg(F.count("*").alias("n"), F.min(_seen()).alias("first"))
    best = types.groupBy("name").agg(F.max_by("type", F.struct("n", (-F.col("first.chunk_idx")).alias("a"), (-F.col("first.pos")).alias("b"))).alias("entity_type"), F.sum("n").alias("frequency"))
    said = first_distinct(raw, ["name"], "description", 3)
    chunks = raw.groupBy("name").agg(F.array_sort(F.collect_set("chunk_idx")).alias("source_chunks"))
    nodes = best.join(said, "name", "left").join(chunks, "name")
    return nodes.select("name", "entity_type", F.coalesce("description", F.lit("")).alias("description"), "source_chunks", "frequency")


def merge_relations(raw: DataFrame) -> DataFrame:
    """One row for each (source, target, relation): first two descriptions, mean weight, chunks, first place."""
    key = ["source", "target", "relation"]
    said = first_distinct(raw, key, "description", 2)
    rest = raw.groupBy(*key).agg(F.avg("weight").alias("weight"), F.array_sort(F.collect_set("chunk_idx")).alias("source_chunks"), F.min(_seen()).alias("first"))
    return rest.join(said, key, "left").select(*key, F.coalesce("description", F.lit("")).alias("description"), "weight", "source_chunks", "first")


def collapse_edges(merged: DataFrame) -> DataFrame:
    """One edge for each (source, target): of its relations the one that is first seen last."""
    best = F.max_by(F.struct("relation", "description", "weight", "source_chunks"), "first")
    return merged.groupBy("source", "target").agg(best.alias("e")).select("source", "target", "e.*")


def known_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges whose ends are nodes."""
    for end in ("source", "target"):
        edges = edges.join(nodes.select(F.col("name").alias(end)), end, "left_semi")
    return edges


def bridge(entities: DataFrame) -> DataFrame:
    """(name, chunk_idx), each once: the table behind both mappings."""
    return entities.select("name", "chunk_idx").distinct()


def chunk_entities(chunks: DataFrame, entities: DataFrame) -> DataFrame:
    """(chunk_idx, entities), also for chunks without any."""
    sets = bridge(entities).groupBy("chunk_idx").agg(F.array_sort(F.collect_list("name")).alias("entities"))
    return chunks.select("chunk_idx").join(sets, "chunk_idx", "left").withColumn("entities", F.coalesce("entities", F.array().cast("array<string>")))


def entity_chunks(entities: DataFrame) -> DataFrame:
    """(name, chunks)."""
    return bridge(entities).groupBy("name").agg(F.array_sort(F.collect_list("chunk_idx")).alias("chunks"))


def entity_pages(bridge: DataFrame, size: int = PAGE) -> DataFrame:
    """(name, page, chunks) of (name, chunk_idx): a page holds the chunks of ``size`` neighbouring numbers, so no row is larger, whoever is in every chunk."""
    page = F.floor(F.col("chunk_idx") / size).cast("long")
    return bridge.groupBy("name", page.alias("page")).agg(F.array_sort(F.collect_list("chunk_idx")).alias("chunks"))


def page_directory(pages: DataFrame) -> DataFrame:
    """(name, pages, first_page, last_page, n_chunks): where an entity's pages are."""
    return pages.groupBy("name").agg(F.count("*").alias("pages"), F.min("page").alias("first_page"), F.max("page").alias("last_page"), F.sum(F.size("chunks")).cast("long").alias("n_chunks"))


def upsert(old: DataFrame, new: DataFrame, *key: str) -> DataFrame:
    """New rows, and the old ones whose (text) key is not among them."""
    # as in fuse: keys are new expressions, so the union relies on no partitioning
    fresh = new.withColumns({k: F.concat(F.col(k), F.lit("")) for k in key})
    return fresh.unionByName(old.join(new.select(*key), list(key), "left_anti"))


def graph_nodes(nodes: DataFrame) -> DataFrame:
    """Nodes as the graph export writes them, defaults filled in."""
    return nodes.select(
        "name", F.coalesce("entity_type", F.lit("UNKNOWN")).alias("type"), F.coalesce("description", F.lit("")).alias("description"),
        "source_chunks", F.coalesce("frequency", F.lit(1)).alias("frequency"),
    )
