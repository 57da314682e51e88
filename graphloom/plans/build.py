"""The whole build, from text files to tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BuildConfig
from ..functions.lineage import cut
from ..operators import answers, bm25, chunking, extract, kg, structure, vector
from ..sources import artifacts, corpus


def _keywords(chunks: DataFrame, config: BuildConfig) -> DataFrame:
    """Phrases of the text that an extractor sees of each chunk."""
    seen = chunks.select("chunk_idx", F.substring("content", 1, extract.TEXT_LIMIT[config.kg_backend]).alias("content")) if config.kg_backend in extract.TEXT_LIMIT else chunks
    return extract.keywords(seen, config.keyword_top_k, words=config.keyword_words)


def _answers(chunks: DataFrame, config: BuildConfig, make: Callable[[], extract.Extractor]) -> DataFrame:
    """An extractor's answers; only those that are not stored yet are asked for."""
    limit = extract.TEXT_LIMIT.get(config.kg_backend, 6000)
    words = _keywords(chunks, config).groupBy("chunk_idx").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "name"))), lambda x: x["name"]).alias("keywords"))
    told = chunks.select("chunk_idx", "content").join(words, "chunk_idx", "left")
    name = f"{config.kg_backend}:{config.kg_model or getattr(make, '__qualname__', type(make).__qualname__)}"
    return answers.ask(told, config.work, make, name, limit, config.max_workers, config.batch_size, backend=config.kg_backend)


def graph_of(chunks: DataFrame, config: BuildConfig, make: Callable[[], extract.Extractor] | None = None) -> dict[str, DataFrame]:
    """entities_raw and relations_raw of chunks: by rules, or by an extractor's calls. Keywords are entities, too, and may be ends of relations, which an extractor is asked for with them."""
    if config.kg_backend != "rules" and make is None:
        raise ValueError(f"kg_backend {config.kg_backend!r} needs an extractor")
    if make is None:
        entities = extract.rule_entities(chunks, config.entity_types)
        relations = extract.rule_relations(entities)
    else:
        said = _answers(chunks, config, make)
        entities, relations = extract.parse_entities(said), extract.parse_relations(said)
    if config.keyword_top_k:
        entities = kg.add_keywords(entities, _keywords(chunks, config))
    return {"entities_raw": entities, "relations_raw": kg.filter_relations(relations, entities)}


#: What a build embeds.
COLLECTIONS = ("chunks", "entities")


def _index_path(root: str, backend: str, collection: str) -> str:
    return f"{root}/{backend.strip().lower()}_{collection}"


def vector_index(spark: SparkSession, root: str, backend: str, collection: str):
    """The store that a build has written for a backend and a collection, opened; KeyError if there is none."""
    if not artifacts.exists(spark, root, f"{backend.strip().lower()}_{collection}"):
        raise KeyError(collection)
    return vector.backend(backend).load(spark, _index_path(root, backend, collection))


def run_build(
    spark: SparkSession, config: BuildConfig, make: Callable[[], extract.Extractor] | None = None,
    embedder: Callable[[list[str]], np.ndarray] | None = None, count: chunking.Counter = chunking.count_words,
) -> dict[str, DataFrame]:
    """Writes every table of ``artifacts.TABLES`` below the output folder and gives them as read from there.

    ``make`` makes an extractor in each task (rules if not given), ``embedder`` is any model of a list of strings (hashed words
    if not given), ``count`` counts tokens (words if not given). The corpus is read at every build. An extractor's answers are stored below the work
    folder under what was asked, so a build that broke off asks for the rest, and a changed text or setting for what it changes.
    The vectors are stored for the configuration's backend, too; ``vector_index`` opens them.
    """
    store = vector.backend(config.vector_backend)  # an unknown one is an error before any work
    out = config.output
    docs = corpus.load_documents(spark, str(config.dataset_dir))
    if docs.isEmpty():
        raise ValueError(f"no text of {corpus.MIN_CHARS} characters or more below {config.dataset_dir}")
    parts = cut(structure.passages(docs, ["doc_id", "path", "doc_number"]))
    chunks = chunking.build_chunks(parts, count, config.min_chunk_tokens, config.target_chunk_tokens, config.max_chunk_tokens, config.tail_merge_threshold, config.min_chunk_chars)
    tables = {"chunks": artifacts.save(chunks, out, "chunks")}
    for name, df in graph_of(tables["chunks"], config, make).items():
        tables[name] = artifacts.save(df, out, name)
    nodes = artifacts.save(kg.merge_entities(tables["entities_raw"]), out, "nodes")
    edges = kg.known_edges(kg.collapse_edges(kg.merge_relations(tables["relations_raw"])), nodes)
    tables |= {"nodes": nodes, "edges": artifacts.save(edges, out, "edges"), "bridge": artifacts.save(kg.bridge(tables["entities_raw"]), out, "bridge")}
    for name, df in (
        ("chunk_entities", kg.chunk_entities(tables["chunks"], tables["entities_raw"])), ("entity_to_chunks", kg.entity_pages(tables["bridge"])),
        ("chunks_meta", tables["chunks"].drop("content")), ("graph_nodes", kg.graph_nodes(nodes)),
    ):
        tables[name] = artifacts.save(df, out, name)
    tables["entity_directory"] = artifacts.save(kg.page_directory(tables["entity_to_chunks"]), out, "entity_directory")
    bm25.Index(tables["chunks"], out)
    named = chunking.number(nodes.select("name"), "name").select(F.col("chunk_idx").alias("idx"), F.col("name").alias("content"))
    named = artifacts.save(named, out, "entity_names")
    texts = tables["chunks"].select(F.lit("chunks").alias("collection"), F.col("chunk_idx").alias("idx"), "content")
    texts = texts.unionByName(named.select(F.lit("entities").alias("collection"), "idx", "content"))
    if embedder is None:
        texts = texts.withColumn("embedding", vector.hashed_embedding(F.col("content"), config.embed_dim).cast("array<float>"))
    else:
        texts = vector.embed(texts, "content", embedder, config.batch_embed)
    tables["vectors"] = artifacts.save_vectors(texts.select("collection", "idx", "embedding"), out)
    for name in COLLECTIONS:
        store.build(artifacts.load_collection(spark, out, name), _index_path(out, config.vector_backend, name)) if name == "chunks" or not nodes.isEmpty() else None
    mode = "rules" if make is None else "extractor"
    meta = artifacts.build_meta(spark, asdict(config), mode, passages=parts, chunks=tables["chunks"], entities=tables["entities_raw"], nodes=nodes, edges=tables["edges"])
    tables["meta"] = artifacts.save(meta, out, "meta")
    return tables
