"""Queries of extraction, merging and the graph. Documents are the chunks; the rule extractor names the entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lineage import scratch
from ..operators import extract, graph, kg, upserts
from .base import TOKENS, chunks, query, table

_TYPES = "[" + ", ".join(f"'{t}'" for t in extract.ENTITY_TYPES) + "]"
_RELATIONS = "[" + ", ".join(f"'{t}'" for t in extract.RELATIONS) + "]"
ENTITIES_SQL = f"""w AS (SELECT doc_id AS chunk_idx, regexp_extract_all(text, '[A-Z][a-z]{{6,}}') AS w FROM documents),
entities AS (
  SELECT chunk_idx, (i - 1)::INTEGER AS pos, upper(w[i]) AS name, {_TYPES}[(length(w[i]) + i - 1) % 8 + 1] AS type, 'word ' || ((i - 1) % 5) AS description
  FROM w, unnest(range(1, len(w) + 1)) AS t(i)
)"""
RELATIONS_SQL = f"""{ENTITIES_SQL}, pairs AS (
  SELECT chunk_idx, pos, name AS source, lead(name) OVER (PARTITION BY chunk_idx ORDER BY pos) AS target FROM entities
), relations AS (
  SELECT chunk_idx, pos, source, target, {_RELATIONS}[pos % 13 + 1] AS relation, 'at ' || (pos % 3) AS description, greatest(0.1, least(1.0, (pos % 12) / 10.0))::DOUBLE AS weight
  FROM pairs WHERE target IS NOT NULL AND target <> source
)"""
MERGED_SQL = f"""{RELATIONS_SQL}, d AS (
  SELECT source, target, relation, description, min(chunk_idx * 1000000000 + pos) AS first FROM relations GROUP BY ALL
), dd AS (
  SELECT source, target, relation, string_agg(description, ' | ' ORDER BY first) AS description
  FROM (SELECT *, row_number() OVER (PARTITION BY source, target, relation ORDER BY first) AS n FROM d) WHERE n <= 2 GROUP BY ALL
), m AS (
  SELECT source, target, relation, avg(weight) AS weight, list_sort(list(DISTINCT chunk_idx)) AS chunks, min(chunk_idx * 1000000000 + pos) AS first FROM relations GROUP BY ALL
), merged AS (
  SELECT m.*, dd.description FROM m JOIN dd USING (source, target, relation)
)"""
EDGES_SQL = f"""{MERGED_SQL}, edges AS (
  SELECT source, target, relation, description, weight, chunks FROM (SELECT *, row_number() OVER (PARTITION BY source, target ORDER BY first DESC) AS n FROM merged) WHERE n = 1
)"""
NODES_SQL = f"""{EDGES_SQL}, t AS (
  SELECT name, type, count(*) AS n, min(chunk_idx * 1000000000 + pos) AS first FROM entities GROUP BY ALL
), bt AS (
  SELECT name, type AS entity_type FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY n DESC, first) AS r FROM t) WHERE r = 1
), ed AS (
  SELECT name, string_agg(description, ' | ' ORDER BY first) AS description FROM (
    SELECT *, row_number() OVER (PARTITION BY name ORDER BY first) AS r FROM (SELECT name, description, min(chunk_idx * 1000000000 + pos) AS first FROM entities GROUP BY ALL)
  ) WHERE r <= 3 GROUP BY name
), nodes AS (
  SELECT e.name, any_value(entity_type) AS entity_type, any_value(ed.description) AS description, list_sort(list(DISTINCT chunk_idx)) AS chunks, count(*) AS frequency
  FROM entities e JOIN bt USING (name) JOIN ed USING (name) GROUP BY e.name
)"""
SEED_SQL = f"""{NODES_SQL}, seed AS (SELECT name FROM nodes ORDER BY frequency DESC, name LIMIT 3),
inc AS (SELECT source AS here, target AS other FROM edges UNION SELECT target, source FROM edges)"""


def entities(spark: SparkSession, d: str) -> DataFrame:
    return extract.rule_entities(chunks(spark, d))


def relations(spark: SparkSession, d: str) -> DataFrame:
    e = entities(spark, d)
    return kg.filter_relations(extract.rule_relations(e), e)


def nodes(spark: SparkSession, d: str) -> DataFrame:
    return kg.merge_entities(entities(spark, d))


def edges(spark: SparkSession, d: str) -> DataFrame:
    return kg.collapse_edges(kg.merge_relations(relations(spark, d)))


def seeds(spark: SparkSession, d: str, n: int = 3) -> DataFrame:
    """The most frequent entities."""
    return nodes(spark, d).orderBy(F.desc("frequency"), "name").limit(n).select("name")


def _list(c: str):
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias("chunks")


_LIST = "array_to_string({}, ',') AS chunks".format


@query(f"WITH {ENTITIES_SQL} SELECT * FROM entities")
def raw_entities(spark: SparkSession, d: str) -> DataFrame:
    return kg.filter_entities(entities(spark, d))


@query(f"WITH {NODES_SQL} SELECT name, entity_type, description, {_LIST('chunks')}, frequency FROM nodes")
def entity_merge(spark: SparkSession, d: str) -> DataFrame:
    return nodes(spark, d).select("name", "entity_type", "description", _list("source_chunks"), "frequency")


@query(f"WITH {NODES_SQL} SELECT name, entity_type FROM nodes")
def entity_type_mode_first(spark: SparkSession, d: str) -> DataFrame:
    return nodes(spark, d).select("name", "entity_type")


@query(f"WITH {RELATIONS_SQL} SELECT * FROM relations")
def relation_filter_semi(spark: SparkSession, d: str) -> DataFrame:
    return relations(spark, d).select("chunk_idx", "pos", "source", "target", "relation", "description", "weight")


@query(f"WITH {MERGED_SQL} SELECT source, target, relation, description, round(weight, 6) AS weight, {_LIST('chunks')} FROM merged")
def relation_merge(spark: SparkSession, d: str) -> DataFrame:
    m = kg.merge_relations(relations(spark, d))
    return m.select("source", "target", "relation", "description", F.round("weight", 6).alias("weight"), _list("source_chunks"))


@query(f"WITH {EDGES_SQL} SELECT source, target, relation, description, round(weight, 6) AS weight, {_LIST('chunks')} FROM edges")
def edge_collapse_last(spark: SparkSession, d: str) -> DataFrame:
    return edges(spark, d).select("source", "target", "relation", "description", F.round("weight", 6).alias("weight"), _list("source_chunks"))


@query(
    """
WITH o AS (SELECT o_orderkey AS chunk_idx, o_custkey, o_orderpriority FROM orders),
r AS (SELECT o_orderpriority AS source, n_name AS target, r_name AS relation, count(*) AS n, round(avg(l_discount), 6) AS weight
  FROM lineitem JOIN o ON l_orderkey = chunk_idx JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL)
SELECT * FROM r
"""
)
def relation_merge_relational(spark: SparkSession, d: str) -> DataFrame:
    """The same merge over triples that joins of the order tables give."""
    t = lambda name: table(spark, d, name)
    triples = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    triples = triples.join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    triples = triples.groupBy(F.col("o_orderpriority").alias("source"), F.col("n_name").alias("target"), F.col("r_name").alias("relation"))
    return triples.agg(F.count("*").alias("n"), F.round(F.avg("l_discount"), 6).alias("weight"))


@query(
    rf"""
WITH {ENTITIES_SQL}, s AS (
  SELECT doc_id AS chunk_idx, unnest(regexp_split_to_array(text, '[.!?\n]+')) AS s, generate_subscripts(regexp_split_to_array(text, '[.!?\n]+'), 1) - 1 AS no FROM documents
), k AS (
  SELECT chunk_idx, no, unnest(list_filter(regexp_split_to_array(regexp_replace(lower(s), '[!-/:-@\[-`{{-~]', ' ', 'g'), '\s+'), lambda x: length(x) >= 3)) AS w FROM s
), f AS (
  SELECT chunk_idx, w, round(ln(ln(3.0 + min(no)) + 1) / (count(*) * (1 + count(DISTINCT no))), 9) AS score FROM k GROUP BY ALL
), b AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY chunk_idx ORDER BY score, w) AS n FROM f) WHERE n <= 5
)
SELECT chunk_idx, upper(replace(w, 'ß', 'ss')) AS name FROM b WHERE NOT EXISTS (SELECT 1 FROM entities e WHERE e.chunk_idx = b.chunk_idx AND e.name = upper(w))
"""
)
def keyword_anti(spark: SparkSession, d: str) -> DataFrame:
    """Keywords that no extracted entity of their chunk names."""
    both = kg.add_keywords(entities(spark, d), extract.keywords(chunks(spark, d)))
    return both.where("type = 'TERM_YAKE'").select("chunk_idx", "name")


#: DuckDB measures edits in bytes, so the letters beyond ASCII stand as characters that no token has.
_SPARE = " || ".join(f"chr({c})" for c in (*range(1, 32), *range(65, 91), *b"!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~"))


@query(
    rf"""
WITH RECURSIVE s AS (
  SELECT doc_id AS chunk_idx, unnest(regexp_split_to_array(text, '[.!?\n]+')) AS s, generate_subscripts(regexp_split_to_array(text, '[.!?\n]+'), 1) - 1 AS no FROM documents
), t AS (
  SELECT chunk_idx, no, {TOKENS('s')} AS t FROM s
), k AS (
  SELECT chunk_idx, no, unnest(t) AS w, generate_subscripts(t, 1) AS i FROM t
), f AS (
  SELECT chunk_idx, w, round(ln(ln(3.0 + min(no)) + 1) / (count(*) * (1 + count(DISTINCT no))), 9) AS score FROM k WHERE length(w) >= 3 GROUP BY ALL
), b AS (
  SELECT chunk_idx, no, i, w, score FROM k JOIN f USING (chunk_idx, w)
), g AS (
  SELECT chunk_idx, w AS p, min(score) AS score FROM b GROUP BY ALL
  UNION ALL
  SELECT chunk_idx, x.w || ' ' || y.w, round(min(x.score * y.score) / (count(*) * (1 + min(x.score + y.score))), 9) FROM b x JOIN b y USING (chunk_idx, no) WHERE y.i = x.i + 1 GROUP BY ALL
  UNION ALL
  SELECT chunk_idx, x.w || ' ' || y.w || ' ' || z.w, round(min(x.score * y.score * z.score) / (count(*) * (1 + min(x.score + y.score + z.score))), 9)
  FROM b x JOIN b y USING (chunk_idx, no) JOIN b z USING (chunk_idx, no) WHERE y.i = x.i + 1 AND z.i = x.i + 2 GROUP BY ALL
), letters AS (
  SELECT string_agg(c, '' ORDER BY c) AS c FROM (SELECT DISTINCT unnest(string_split(w, '')) AS c FROM k) WHERE ascii(c) > 127
), r AS MATERIALIZED (
  SELECT chunk_idx, p, score, translate(p, letters.c, {_SPARE}) AS q, row_number() OVER (PARTITION BY chunk_idx ORDER BY score, p) AS n FROM g, letters
), a AS (
  SELECT chunk_idx, 0::BIGINT AS n, []::STRUCT(p VARCHAR, q VARCHAR)[] AS kept FROM r WHERE n = 1
  UNION ALL
  SELECT chunk_idx, n, CASE WHEN len(list_filter(kept, lambda o: 1 - levenshtein(o.q, q) / greatest(length(o.q), length(q)) >= 0.9)) = 0 THEN list_append(kept, {{'p': p, 'q': q}}) ELSE kept END
  FROM (SELECT chunk_idx, n + 1 AS n, kept FROM a WHERE len(kept) < 5) JOIN r USING (chunk_idx, n)
)
SELECT chunk_idx, i::INTEGER AS rank, upper(replace(kept[i].p, 'ß', 'ss')) AS name
FROM (SELECT chunk_idx, arg_max(kept, n) AS kept FROM a GROUP BY ALL), unnest(range(1, len(kept) + 1)) AS u(i)
"""
)
def key_phrases(spark: SparkSession, d: str) -> DataFrame:
    """Keywords of up to three words, of which none is nearly another."""
    return extract.keywords(chunks(spark, d), words=3).select("chunk_idx", (F.col("pos") - 1_000_000).cast("int").alias("rank"), "name")


@query(f"WITH {ENTITIES_SQL} SELECT doc_id AS chunk_idx, coalesce(string_agg(DISTINCT name, ',' ORDER BY name), '') AS entities FROM documents LEFT JOIN entities ON chunk_idx = doc_id GROUP BY doc_id")
def chunk_entities(spark: SparkSession, d: str) -> DataFrame:
    return kg.chunk_entities(chunks(spark, d), entities(spark, d)).select("chunk_idx", F.array_join("entities", ",").alias("entities"))


@query(f"WITH {ENTITIES_SQL} SELECT name, array_to_string(list_sort(list(DISTINCT chunk_idx)), ',') AS chunks FROM entities GROUP BY name")
def entity_to_chunks(spark: SparkSession, d: str) -> DataFrame:
    return kg.entity_chunks(entities(spark, d)).select("name", _list("chunks"))


@query(
    f"""WITH {NODES_SQL}, new AS (SELECT n_name AS name, 'NATION' AS type FROM nation)
SELECT * FROM new UNION ALL SELECT name, entity_type AS type FROM nodes WHERE name NOT IN (SELECT name FROM new)"""
)
def node_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Through a stored table, of which the second upsert rewrites the buckets it touches."""
    held = upserts.Keyed(spark, scratch(spark, "nodes"), "name")
    held.upsert(kg.graph_nodes(nodes(spark, d)).select("name", "type"))
    held.upsert(table(spark, d, "nation").select(F.col("n_name").alias("name"), F.lit("NATION").alias("type")))
    return held.read()


@query(
    f"""WITH {EDGES_SQL}, new AS (SELECT source, relation, target, 1.0::DOUBLE AS weight FROM edges WHERE relation = 'liên_quan')
SELECT * FROM new UNION ALL SELECT source, relation, target, round(weight, 6) AS weight FROM edges WHERE relation <> 'liên_quan'"""
)
def edge_upsert(spark: SparkSession, d: str) -> DataFrame:
    held = upserts.Keyed(spark, scratch(spark, "edges"), "source", "relation", "target")
    held.upsert(edges(spark, d).select("source", "relation", "target", F.round("weight", 6).alias("weight")))
    new = held.read().where("relation = 'liên_quan'").withColumn("weight", F.lit(1.0))
    held.upsert(kg.known_edges(new, nodes(spark, d)).select("source", "relation", "target", "weight"))
    return held.read()


@query(f"WITH {SEED_SQL} SELECT name, entity_type, frequency FROM nodes WHERE name IN (SELECT name FROM seed)")
def entity_lookup(spark: SparkSession, d: str) -> DataFrame:
    return nodes(spark, d).join(seeds(spark, d), "name", "left_semi").select("name", "entity_type", "frequency")


@query(
    f"""WITH {SEED_SQL}
SELECT DISTINCT s.name, e.source, e.target, e.relation, e.description, round(e.weight, 6) AS weight FROM seed s JOIN edges e ON e.source = s.name OR e.target = s.name"""
)
def entity_relationships(spark: SparkSession, d: str) -> DataFrame:
    return graph.entity_relations(edges(spark, d), seeds(spark, d)).withColumn("weight", F.round("weight", 6))


_NEIGHBORS = """, found AS (
  SELECT DISTINCT near.seed, e.source, e.relation, e.target, e.description, round(e.weight, 6) AS weight FROM near JOIN edges e ON e.source = near.here OR e.target = near.here
)
SELECT seed, source, relation, target, description, weight, r::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY seed ORDER BY source, relation, target) AS r FROM found) WHERE r <= 50"""


@query(f"WITH {SEED_SQL}, near AS (SELECT name AS seed, name AS here FROM seed){_NEIGHBORS}")
def neighbors_d1(spark: SparkSession, d: str) -> DataFrame:
    return graph.neighbors(edges(spark, d), seeds(spark, d), 1).withColumn("weight", F.round("weight", 6))


@query(f"WITH {SEED_SQL}, near AS (SELECT name AS seed, name AS here FROM seed UNION SELECT name, other FROM seed JOIN inc ON here = name){_NEIGHBORS}")
def neighbors_d2(spark: SparkSession, d: str) -> DataFrame:
    return graph.neighbors(edges(spark, d), seeds(spark, d), 2).withColumn("weight", F.round("weight", 6))


_SUB_SQL = f"{SEED_SQL}, sub AS (SELECT name FROM seed UNION SELECT other FROM seed JOIN inc ON here = name)"


@query(f"WITH {_SUB_SQL} SELECT source, target, relation, description, round(weight, 6) AS weight FROM edges WHERE source IN (SELECT name FROM sub) AND target IN (SELECT name FROM sub)")
def subgraph_d1(spark: SparkSession, d: str) -> DataFrame:
    return graph.subgraph_edges(nodes(spark, d), edges(spark, d), seeds(spark, d), 1).select("source", "target", "relation", "description", F.round("weight", 6).alias("weight"))


_SUB2_SQL = f"{_SUB_SQL}, sub2 AS (SELECT name FROM sub UNION SELECT other FROM sub JOIN inc ON here = name)"


@query(f"WITH {_SUB2_SQL} SELECT source, target, relation, description, round(weight, 6) AS weight FROM edges WHERE source IN (SELECT name FROM sub2) AND target IN (SELECT name FROM sub2)")
def subgraph_d2(spark: SparkSession, d: str) -> DataFrame:
    return graph.subgraph_edges(nodes(spark, d), edges(spark, d), seeds(spark, d), 2).select("source", "target", "relation", "description", F.round("weight", 6).alias("weight"))


@query(f"WITH {ENTITIES_SQL} SELECT name, chunk_idx // 1000 AS page, array_to_string(list_sort(list(DISTINCT chunk_idx)), ',') AS chunks FROM entities GROUP BY ALL")
def entity_pages(spark: SparkSession, d: str) -> DataFrame:
    return kg.entity_pages(kg.bridge(entities(spark, d))).select("name", "page", _list("chunks"))


@query(
    f"""WITH {ENTITIES_SQL}, p AS (SELECT name, chunk_idx // 1000 AS page, count(DISTINCT chunk_idx) AS n FROM entities GROUP BY ALL)
SELECT name, count(*) AS pages, min(page) AS first_page, max(page) AS last_page, sum(n)::BIGINT AS n_chunks FROM p GROUP BY name"""
)
def entity_directory(spark: SparkSession, d: str) -> DataFrame:
    return kg.page_directory(kg.entity_pages(kg.bridge(entities(spark, d))))


@query(f"WITH {_SUB_SQL} SELECT name, entity_type FROM nodes WHERE name IN (SELECT name FROM sub)")
def subgraph_nodes_d1(spark: SparkSession, d: str) -> DataFrame:
    return graph.subgraph_nodes(nodes(spark, d), edges(spark, d), seeds(spark, d), 1).select("name", "entity_type")


@query(f"WITH {NODES_SQL} SELECT (SELECT count(*) FROM nodes) AS nodes, (SELECT count(*) FROM edges) AS edges")
def graph_stats(spark: SparkSession, d: str) -> DataFrame:
    return graph.stats(nodes(spark, d), edges(spark, d))
