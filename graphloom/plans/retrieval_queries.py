"""Queries of lexical, dense and hybrid retrieval. Documents are the chunks, benchmark items the questions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.lineage import cut
from ..functions.text import query_text
from ..operators import bm25, hybrid, kg, vector
from . import base
from .base import TOKENS, chunks, query, questions, table
from .kg_queries import EDGES_SQL, ENTITIES_SQL, edges, entities

_INDEX = f"""tok AS MATERIALIZED (SELECT doc_id AS chunk_idx, {TOKENS('text')} AS t FROM documents),
len AS MATERIALIZED (SELECT chunk_idx, len(t) AS length FROM tok), size AS MATERIALIZED (SELECT count(*) AS n, avg(length) AS mean FROM len),
posts AS (SELECT chunk_idx, unnest(t) AS term FROM tok), tf AS MATERIALIZED (SELECT chunk_idx, term, count(*) AS tf FROM posts GROUP BY ALL),
raw AS MATERIALIZED (SELECT term, df, ln(n - df + 0.5) - ln(df + 0.5) AS raw FROM (SELECT term, count(*) AS df FROM tf GROUP BY term) CROSS JOIN size),
low AS MATERIALIZED (SELECT avg(raw) AS low FROM raw),
idf AS MATERIALIZED (SELECT term, df, CASE WHEN raw < 0 THEN 0.25 * low ELSE raw END AS idf FROM raw CROSS JOIN low)"""
_BM25 = f"""{_INDEX}, q AS (SELECT item_id AS query_id, unnest({TOKENS('text')}) AS term FROM benchmark), qt AS (SELECT query_id, term, count(*) AS times FROM q GROUP BY ALL),
s AS (
  SELECT query_id, chunk_idx, round(sum(times * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * length / mean))), 6) AS score
  FROM qt JOIN tf USING (term) JOIN idf USING (term) JOIN len USING (chunk_idx) CROSS JOIN size GROUP BY ALL
), bm AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_idx)::INTEGER AS rank, chunk_idx, score FROM s WHERE score > 0
)"""


@query(f"WITH {_INDEX} SELECT term, df, round(idf, 6) AS idf FROM idf")
def bm25_index(spark: SparkSession, d: str) -> DataFrame:
    return bm25.Index(chunks(spark, d)).idf.select("term", "df", F.round("idf", 6).alias("idf"))


@query(f"WITH {_BM25} SELECT * FROM bm WHERE rank <= 5")
def bm25_topk(spark: SparkSession, d: str) -> DataFrame:
    return bm25.top_k(chunks(spark, d), questions(spark, d), 5)


def vectors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("idx"), "embedding")


def _asked(spark: SparkSession, d: str) -> DataFrame:
    return vectors(spark, d).where("idx % 100 = 0").withColumnRenamed("idx", "query_id")


@query(
    """
WITH s AS (
  SELECT q.vec_id AS query_id, v.vec_id AS idx, round(list_inner_product(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 9) AS score
  FROM embeddings q, embeddings v WHERE q.vec_id % 100 = 0
)
SELECT query_id, rank::INTEGER AS rank, idx, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, idx) AS rank FROM s) WHERE rank <= 5
"""
)
def knn_exact(spark: SparkSession, d: str) -> DataFrame:
    return vector.search("exact", _asked(spark, d), vectors(spark, d), 5).withColumn("score", F.round("score", 6))


_KNN = base.SQL["knn_exact"]


@query(_KNN)
def knn_ivf(spark: SparkSession, d: str) -> DataFrame:
    return vector.search("ivf", _asked(spark, d), vectors(spark, d), 5).withColumn("score", F.round("score", 6))


@query(_KNN)
def knn_graph(spark: SparkSession, d: str) -> DataFrame:
    """The walk is approximate by its kind; what it leaves open is settled from the cells that its k-th scores do not rule out."""
    return vector.search("graph", _asked(spark, d), vectors(spark, d), 5, complete=True).withColumn("score", F.round("score", 6))


def _hash_sql(name: str, rows: str) -> str:
    """SQL of the hashed embedding; rows: (id, text)."""
    return f"""{name}_p AS (SELECT id, ('0x' || substr(md5(t), 1, 8))::BIGINT % 64 AS p FROM (SELECT id, unnest({TOKENS('text')}) AS t FROM ({rows}))),
{name}_n AS (SELECT id, p, count(*) AS n FROM {name}_p GROUP BY ALL),
{name} AS (SELECT id, p, n / sqrt(sum(n * n) OVER (PARTITION BY id)) AS x FROM {name}_n)"""


_DOC_VECTORS = _hash_sql("dv", "SELECT doc_id AS id, text FROM documents")


@query(f"WITH {_DOC_VECTORS} SELECT doc_id AS chunk_idx, (p::INTEGER) AS place, round(x, 6) AS x FROM dv JOIN documents ON doc_id = id")
def embed_hash(spark: SparkSession, d: str) -> DataFrame:
    v = chunks(spark, d).select("chunk_idx", F.posexplode(vector.hashed_embedding(F.col("content"))).alias("place", "x"))
    return v.where("x <> 0").withColumn("x", F.round("x", 6))


def _dense(spark: SparkSession, d: str, k: int = hybrid.DENSE) -> DataFrame:
    v = chunks(spark, d).select(F.col("chunk_idx").alias("idx"), vector.hashed_embedding(F.col("content")).alias("embedding"))
    q = questions(spark, d).select("query_id", vector.hashed_embedding(query_text(F.col("query"))).alias("embedding"))
    return vector.exact(q, v, k).withColumnRenamed("idx", "chunk_idx")


def _entity_hits(spark: SparkSession, d: str, bridge: DataFrame, k: int = hybrid.ENTITY) -> DataFrame:
    """(query_id, rank, name, score): entities nearest to each question."""
    names = bridge.select("name").distinct()
    v = cut(names.select(F.xxhash64("name").alias("idx"), vector.hashed_embedding(F.col("name")).alias("embedding"), "name"))
    q = questions(spark, d).select("query_id", vector.hashed_embedding(query_text(F.col("query"))).alias("embedding"))
    # ties are wide (equal places), so the order by name is settled on all entities of the k best places; these
    # are numbered by their first names, so that the places kept among equal scores hold the k smallest names
    places = v.groupBy("embedding").agg(F.min("name").alias("first"))
    p = cut(places.orderBy("first").select(F.monotonically_increasing_id().alias("idx"), "embedding"))
    near = vector.exact(q, p.select("idx", "embedding"), k)
    # of a place, which may hold a large share of all names, the k smallest are enough
    within = Window.partitionBy("embedding").orderBy("name")
    some = v.select("embedding", "name", F.row_number().over(within).alias("r")).where(F.col("r") <= k).drop("r")
    held = near.join(p.select("idx", "embedding"), "idx").join(some, "embedding")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "name")
    return held.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "name", "score")


_QUERY_VECTORS = _hash_sql("qv", "SELECT item_id AS id, 'query: ' || text AS text FROM benchmark")
_DENSE = f"""{_DOC_VECTORS}, {_QUERY_VECTORS}, ds AS (
  SELECT q.item_id AS query_id, d.doc_id AS chunk_idx, round(coalesce(s, 0), 9) AS score FROM benchmark q CROSS JOIN documents d
  LEFT JOIN (SELECT qv.id AS a, dv.id AS b, sum(qv.x * dv.x) AS s FROM qv JOIN dv USING (p) GROUP BY ALL) ON a = q.item_id AND b = d.doc_id
), dense AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_idx)::INTEGER AS rank, chunk_idx, score FROM ds)"""
_ENTITY = f"""names AS (SELECT DISTINCT name FROM entities), ev AS (SELECT name, ('0x' || substr(md5(lower(name)), 1, 8))::BIGINT % 64 AS p FROM names),
es AS (SELECT item_id AS query_id, name, round(coalesce(x, 0), 9) AS score FROM benchmark CROSS JOIN ev LEFT JOIN qv ON qv.id = item_id AND qv.p = ev.p),
eh AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, name)::INTEGER AS rank, name, score FROM es)"""


@query(f"WITH {ENTITIES_SQL}, {_QUERY_VECTORS}, {_ENTITY} SELECT query_id, rank, name, round(score, 6) AS score FROM eh WHERE rank <= 15")
def knn_entities(spark: SparkSession, d: str) -> DataFrame:
    return _entity_hits(spark, d, cut(kg.bridge(entities(spark, d))), 15).withColumn("score", F.round("score", 6))


def _fused(spark: SparkSession, d: str, bridge: DataFrame) -> DataFrame:
    lexical = bm25.top_k(chunks(spark, d), questions(spark, d), hybrid.LEXICAL)
    return hybrid.fuse(_dense(spark, d), lexical, hybrid.entity_candidates(_entity_hits(spark, d, bridge), bridge))


_FUSED = f"""{_DENSE}, {_BM25}, {_ENTITY}, cand AS (
  SELECT query_id, 0 AS source, rank, chunk_idx FROM dense WHERE rank <= 4
  UNION ALL SELECT query_id, 1, rank, chunk_idx FROM bm WHERE rank <= 4
  UNION ALL SELECT query_id, 2, rank, chunk_idx FROM eh JOIN (SELECT DISTINCT name, chunk_idx FROM entities) USING (name) WHERE rank <= 3
), firsts AS (
  SELECT query_id, chunk_idx, min(source * 1000000 + rank) AS spot FROM cand GROUP BY ALL
), fused AS (
  SELECT query_id, place::INTEGER AS place, chunk_idx FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY spot, chunk_idx) AS place FROM firsts) WHERE place <= 6
)"""


@query(f"WITH {ENTITIES_SQL}, {_FUSED} SELECT * FROM fused")
def hybrid_fusion(spark: SparkSession, d: str) -> DataFrame:
    return _fused(spark, d, cut(kg.bridge(entities(spark, d))))


@query(
    f"""WITH {EDGES_SQL}, {_FUSED}, ce AS (SELECT DISTINCT query_id, name FROM fused JOIN entities USING (chunk_idx)),
cr AS (SELECT query_id, source, target, min(struct_pack(relation := relation, description := description)) AS r FROM ce JOIN edges ON source = name OR target = name GROUP BY ALL),
es2 AS (SELECT query_id, string_agg('• ' || name, chr(10) ORDER BY name) FILTER (i <= 15) AS names, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY name) AS i FROM ce) GROUP BY query_id),
rs AS (SELECT query_id, string_agg(line, chr(10) ORDER BY line) AS lines, count(*) AS n FROM (
  SELECT query_id, '• ' || source || ' --[' || r.relation || ']--> ' || target || CASE WHEN r.description <> '' THEN ' (' || r.description || ')' ELSE '' END AS line FROM cr) GROUP BY query_id),
cs AS (SELECT query_id, string_agg('[Chunk ' || place || ']: ' || text, chr(10) ORDER BY place) AS texts, count(*) AS n FROM fused JOIN documents ON doc_id = chunk_idx GROUP BY query_id),
said AS (
  SELECT item_id AS query_id, text AS query, coalesce(cs.n, 0) AS num_chunks, coalesce(es2.n, 0)::INTEGER AS num_entities, coalesce(rs.n, 0)::INTEGER AS num_relationships, coalesce(names, '') AS entities,
    '--- ENTITIES ---' || chr(10) || coalesce(names, '') || chr(10) || chr(10) || '--- RELATIONS ---' || chr(10) || coalesce(lines, '') || chr(10) || chr(10) || '--- CHUNKS ---' || chr(10) || coalesce(texts, '') AS context
  FROM benchmark LEFT JOIN es2 ON es2.query_id = item_id LEFT JOIN rs ON rs.query_id = item_id LEFT JOIN cs ON cs.query_id = item_id
)
SELECT query_id, num_chunks, num_entities, num_relationships, entities, sha256(context) AS context_sha256,
  sha256('Answer in one short paragraph, only from the context, with its legal basis. If the context does not say, answer: {hybrid.FALLBACK}' || chr(10) || chr(10) || context || chr(10) || chr(10) || 'Question: ' || query || chr(10) || 'Answer:') AS prompt_sha256
FROM said"""
)
def hybrid_context(spark: SparkSession, d: str) -> DataFrame:
    """Counts, the entities shown, and hashes of the whole context and the whole prompt."""
    bridge = cut(kg.bridge(entities(spark, d)))
    fused = cut(_fused(spark, d, bridge))
    names = cut(hybrid.context_entities(fused, bridge))
    out = hybrid.contexts(questions(spark, d), fused, chunks(spark, d), names, hybrid.context_relations(names, edges(spark, d)))
    shown = F.regexp_extract("context", r"(?s)^--- ENTITIES ---\n(.*?)\n\n--- RELATIONS ---", 1)
    return out.select("query_id", "num_chunks", "num_entities", "num_relationships", shown.alias("entities"), F.sha2("context", 256).alias("context_sha256"), F.sha2("prompt", 256).alias("prompt_sha256"))
