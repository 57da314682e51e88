"""Questions to a build: from stored tables to contexts and answers."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lineage import cut
from ..functions.text import query_text, question
from ..operators import bm25, hybrid, vector
from ..sources import artifacts
from .build import vector_index


class Retriever:
    """A build's tables below ``root``, opened once for any number of questions.

    ``backend`` names the vector store that the build has written, ``embedder`` is the model it was built with (hashed words of ``dim`` places if not given).
    """

    def __init__(self, spark: SparkSession, root: str, backend: str = "exact", embedder: Callable[[list[str]], np.ndarray] | None = None, dim: int = vector.DIM):
        load = lambda name: artifacts.load(spark, root, name)
        self.chunks, self.bridge, self.edges, self.names = load("chunks"), load("bridge"), load("edges"), load("entity_names")
        self.lexical = bm25.Index.load(spark, root)
        self.dense = vector_index(spark, root, backend, "chunks")
        self.entities = None if self.names.isEmpty() else vector_index(spark, root, backend, "entities")
        self.embedder, self.dim = embedder, dim

    def _embedded(self, questions: DataFrame) -> DataFrame:
        asked = questions.select("query_id", query_text(F.col("query")).alias("text"))
        if self.embedder is None:
            return asked.select("query_id", vector.hashed_embedding(F.col("text"), self.dim).alias("embedding"))
        return vector.embed(asked, "text", self.embedder).select("query_id", "embedding")

    def contexts(self, questions: DataFrame) -> DataFrame:
        """(query_id, context, prompt, num_chunks, num_entities, num_relationships) of (query_id, query)."""
        q = cut(self._embedded(questions))
        dense = self.dense.search(q, hybrid.DENSE).withColumnRenamed("idx", "chunk_idx")
        lexical = self.lexical.top_k(questions, hybrid.LEXICAL)
        if self.entities is None:
            by_entity = dense.where(F.lit(False)).select("query_id", "rank", "chunk_idx")
        else:
            hits = self.entities.search(q, hybrid.ENTITY).join(self.names.select("idx", F.col("content").alias("name")), "idx")
            by_entity = hybrid.entity_candidates(hits, self.bridge)
        fused = cut(hybrid.fuse(dense, lexical, by_entity))
        names = cut(hybrid.context_entities(fused, self.bridge))
        return hybrid.contexts(questions, fused, self.chunks, names, hybrid.context_relations(names, self.edges))

    def answers(self, questions: DataFrame, make: Callable[[], Callable[[str], str]], workers: int | None = None) -> DataFrame:
        """The evaluation rows of (query_id, query, ...): each question with its answer and the counts behind it. A ``case`` goes before its question."""
        asked = questions.withColumn("query", question(F.col("query"), F.col("case"))) if "case" in questions.columns else questions
        return hybrid.evaluation(questions, hybrid.answer(cut(self.contexts(asked)), make, workers))
