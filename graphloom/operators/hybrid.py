"""Hybrid retrieval for many questions in one plan: dense, lexical and graph evidence, fused in order of priority."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import graph
from .extract import with_retry
from .structure import joined

DENSE, LEXICAL, ENTITY = 4, 4, 3
CHUNKS, ENTITIES_SHOWN = 6, 15
# fixed value: the answer where nothing is found
FALLBACK = "Không tìm thấy thông tin liên quan"


def entity_candidates(hits: DataFrame, bridge: DataFrame) -> DataFrame:
    """All chunks of the entities found: (query_id, rank, name) with (name, chunk_idx)."""
    return hits.join(bridge, "name").select("query_id", "rank", "chunk_idx")


def fuse(dense: DataFrame, lexical: DataFrame, entity: DataFrame, most: int = CHUNKS) -> DataFrame:
    """(query_id, place, chunk_idx): candidates one source after the other, each chunk once, the first ``most``."""
    # keys are written as new expressions: a union that takes its parts for equally partitioned can fail once AQE has coalesced one of them
    parts = [c.select((F.col("query_id") + 0).alias("query_id"), F.lit(p).alias("source"), "rank", "chunk_idx") for p, c in enumerate((dense, lexical, entity))]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    first = every.groupBy("query_id", "chunk_idx").agg(F.min(F.struct("source", "rank")).alias("at"))
    order = Window.partitionBy("query_id").orderBy("at", "chunk_idx")
    return first.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most).select("query_id", "place", "chunk_idx")


def context_entities(fused: DataFrame, bridge: DataFrame) -> DataFrame:
    """(query_id, name): entities of the chunks chosen."""
    return fused.join(bridge, "chunk_idx").select("query_id", "name").distinct()


def context_relations(entities: DataFrame, edges: DataFrame) -> DataFrame:
    """(query_id, source, target, relation, description): edges at these entities, one for each pair of ends, of several the first by label and description."""
    at = graph.incident(edges).select("at", "source", "target", F.struct("relation", "description").alias("r"))
    found = entities.join(at, F.col("name") == F.col("at")).groupBy("query_id", "source", "target").agg(F.min("r").alias("r"))
    return found.select("query_id", "source", "target", "r.relation", "r.description")


def contexts(questions: DataFrame, fused: DataFrame, chunks: DataFrame, entities: DataFrame, relations: DataFrame) -> DataFrame:
    """(query_id, context, prompt, num_chunks, num_entities, num_relationships) for each question."""
    e = entities.groupBy("query_id").agg(F.array_sort(F.collect_list("name")).alias("names"))
    r = relations.withColumn("line", F.concat(F.lit("• "), "source", F.lit(" --["), F.coalesce("relation", F.lit("liên_quan")), F.lit("]--> "), "target", F.when(F.coalesce("description", F.lit("")) != "", F.concat(F.lit(" ("), "description", F.lit(")"))).otherwise("")))
    r = r.groupBy("query_id").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    c = fused.join(chunks.select("chunk_idx", "content"), "chunk_idx").withColumn("line", F.concat(F.lit("[Chunk "), F.col("place"), F.lit("]: "), "content"))
    c = c.groupBy("query_id").agg(joined("place", "line", "\n").alias("texts"), F.count("*").alias("num_chunks"))
    q = questions.select("query_id", "query").join(e, "query_id", "left").join(r, "query_id", "left").join(c, "query_id", "left")
    names, lines = F.coalesce("names", F.array().cast("array<string>")), F.coalesce("lines", F.array().cast("array<string>"))
    shown = F.array_join(F.transform(F.slice(names, 1, ENTITIES_SHOWN), lambda n: F.concat(F.lit("• "), n)), "\n")
    context = F.concat(
        F.lit("--- ENTITIES ---\n"), shown, F.lit("\n\n--- RELATIONS ---\n"), F.array_join(lines, "\n"), F.lit("\n\n--- CHUNKS ---\n"), F.coalesce("texts", F.lit(""))
    )
    rules = f"Answer in one short paragraph, only from the context, with its legal basis. If the context does not say, answer: {FALLBACK}\n\n"
    return q.withColumn("context", context).select(
        "query_id", "context", F.concat(F.lit(rules), "context", F.lit("\n\nQuestion: "), "query", F.lit("\nAnswer:")).alias("prompt"),
        F.coalesce("num_chunks", F.lit(0)).alias("num_chunks"), F.size(names).alias("num_entities"), F.size(lines).alias("num_relationships"),
    )


def answer(contexts: DataFrame, make: Callable[[], Callable[[str], str]], workers: int | None = None, attempts: int = 5, wait: float = 1.0) -> DataFrame:
    """contexts with ``my_answer`` of any model of a prompt; ``make`` runs once a task, a call that keeps failing answers nothing."""
    def run(batches):
        model = make()
        for b in batches:
            said = [with_retry(lambda p=p: model(p), attempts, wait) for p in b.column("prompt").to_pylist()]
            yield pa.record_batch([*b.columns, pa.array(said, pa.string())], names=[*b.schema.names, "my_answer"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in contexts.schema.fields)
    return (contexts.repartition(workers) if workers else contexts).mapInArrow(run, f"{fields}my_answer string")


def evaluation(questions: DataFrame, answered: DataFrame) -> DataFrame:
    """One row a question with its answer and the true counts of what its context held."""
    info = F.struct("num_entities", "num_chunks", "num_relationships", F.col("context").alias("context_recall"))
    return questions.join(answered.select("query_id", "my_answer", info.alias("debug_info")), "query_id", "left")
