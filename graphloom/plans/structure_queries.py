"""Queries of parsing, packing and chunk building."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import markers, text as T
from ..operators import chunking, stats, structure
from .base import LEGAL_SQL, STRIP, WORDS, documents, legal, query
from .text_queries import lines_sql

_UNIT_STRIP = STRIP("string_agg(line, chr(10) ORDER BY line_no)")
_PARTS = []
for _rank, _level in enumerate(markers.LEVELS):
    _above = ", ".join(f"'{x}'" for x in markers.LEVELS[:_rank]) or "NULL"
    _PARTS.append(
        f"CASE WHEN max(CASE WHEN level = '{_level}' THEN no END) OVER w > coalesce(max(CASE WHEN level IN ({_above}) THEN no END) OVER w, -1) "
        f"THEN last_value(CASE WHEN level = '{_level}' THEN marker END IGNORE NULLS) OVER w END"
    )
def units_sql(rules: list, sep: str) -> str:
    return f"""{lines_sql(rules)}, numbered AS (
  SELECT *, sum(CASE WHEN level <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS no FROM lines
), grouped AS (
  SELECT doc_id, no, arg_min(level, line_no) AS level, arg_min(label, line_no) AS marker, {_UNIT_STRIP} AS content FROM numbered GROUP BY doc_id, no
), units AS (
  SELECT doc_id, no::BIGINT AS unit_no, level, marker, content, concat_ws('{sep}', {", ".join(_PARTS)}) AS hierarchy_path
  FROM grouped WINDOW w AS (PARTITION BY doc_id ORDER BY no ROWS UNBOUNDED PRECEDING)
)"""


UNITS_SQL = units_sql(markers.RULES, " > ")


@query(f"WITH {UNITS_SQL} SELECT * FROM units WHERE content <> ''")
def legal_units(spark: SparkSession, d: str) -> DataFrame:
    return structure.units(legal(spark, d), ["doc_id"])


@query(
    f"""WITH {units_sql(markers.TITLES, ' - ')}, t AS (SELECT *, CASE WHEN hierarchy_path = '' THEN 'Phần mở đầu' ELSE hierarchy_path END AS title FROM units WHERE length(content) >= 10)
SELECT doc_id, unit_no AS passage, title AS context_title, regexp_replace(replace(replace(title, ' ', '_'), '-', '_'), '[^A-Za-z0-9_À-ỹ]', '', 'g') AS passage_id, content FROM t"""
)
def titled_passages(spark: SparkSession, d: str) -> DataFrame:
    return structure.titled_passages(legal(spark, d), ["doc_id"])


@query(
    f"""WITH {UNITS_SQL}, p AS (SELECT doc_id, count(*) AS n, max(CASE WHEN hierarchy_path = '' THEN 0 ELSE len(string_split(hierarchy_path, ' > ')) END)::INTEGER AS depth FROM units WHERE content <> '' GROUP BY doc_id)
SELECT round(avg(n), 6) AS mean, min(n) AS least, max(n) AS most, round(avg(depth), 6) AS mean_depth, max(depth) AS most_depth FROM p"""
)
def tree_profile(spark: SparkSession, d: str) -> DataFrame:
    return stats.tree_profile(structure.units(legal(spark, d), ["doc_id"]), "doc_id")


def _spread(spark: SparkSession, d: str) -> DataFrame:
    """Documents with every word of up to twelve letters that ends a sentence as a paragraph of its own."""
    return documents(spark, d).select("doc_id", F.regexp_replace("text", r" ", "\n\n").alias("content"))


@query(
    r"""
WITH p AS (
  SELECT doc_id, unnest(regexp_split_to_array(replace(text, ' ', chr(10) || chr(10)), '\n{2,}')) AS p,
    generate_subscripts(regexp_split_to_array(replace(text, ' ', chr(10) || chr(10)), '\n{2,}'), 1) AS no FROM documents
), l AS (
  SELECT *, list_filter(list_transform(string_split(p, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS lines FROM p
), c AS (
  SELECT doc_id, no, CASE WHEN len(lines) >= 6 AND len(list_filter(lines, lambda x: length(x) <= 12)) >= 0.6 * len(lines) THEN array_to_string(lines, ' ') ELSE p END AS p FROM l
), s AS (
  SELECT *, length(regexp_replace(p, '^\s+|\s+$', '', 'g')) BETWEEN 1 AND 15 AS short FROM c
), i AS (
  SELECT *, sum(CASE WHEN short THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY no) AS island FROM s
), n AS (
  SELECT *, short AND count(*) FILTER (short) OVER (PARTITION BY doc_id, island) >= 6 AS merged, min(no) FILTER (short) OVER (PARTITION BY doc_id, island) AS first FROM i
), g AS (
  SELECT doc_id, CASE WHEN merged THEN first ELSE no END AS place, string_agg(CASE WHEN merged THEN regexp_replace(p, '^\s+|\s+$', '', 'g') ELSE p END, ' ' ORDER BY no) AS p
  FROM n GROUP BY ALL
)
SELECT doc_id, string_agg(p, chr(10) || chr(10) ORDER BY place) AS content FROM g GROUP BY doc_id
"""
)
def short_run_collapse(spark: SparkSession, d: str) -> DataFrame:
    return structure.clean_paragraphs(_spread(spark, d), ["doc_id"])


@query(
    f"""
WITH RECURSIVE {UNITS_SQL}, u AS (
  SELECT doc_id, content, length(content) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY unit_no) AS i FROM units WHERE content <> ''
), f AS (
  SELECT doc_id, i, CASE WHEN n > 10000 THEN 0 ELSE n END AS acc, 0 AS g, CASE WHEN n > 10000 THEN 1 ELSE 0 END AS next FROM u WHERE i = 1
  UNION ALL
  SELECT u.doc_id, u.i, CASE WHEN n > 10000 THEN 0 WHEN acc + n > 10000 THEN n ELSE acc + n END,
    CASE WHEN n > 10000 THEN next + CASE WHEN acc > 0 THEN 1 ELSE 0 END WHEN acc + n > 10000 THEN next + 1 ELSE next END,
    CASE WHEN n > 10000 THEN next + CASE WHEN acc > 0 THEN 2 ELSE 1 END WHEN acc + n > 10000 THEN next + 1 ELSE next END
  FROM f JOIN u ON u.doc_id = f.doc_id AND u.i = f.i + 1
), p AS (
  SELECT f.doc_id, g, string_agg(content, chr(10) || chr(10) ORDER BY f.i) AS content FROM f JOIN u ON u.doc_id = f.doc_id AND u.i = f.i GROUP BY f.doc_id, g
), k AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY g)::INTEGER AS passage_no, content FROM p WHERE length(content) >= 100
)
SELECT * FROM k UNION ALL SELECT doc_id, NULL, content FROM legal WHERE length(content) >= 100 AND doc_id NOT IN (SELECT doc_id FROM k)
"""
)
def passages_char_pack(spark: SparkSession, d: str) -> DataFrame:
    return structure.passages(legal(spark, d), ["doc_id"])


# fixed values: what begins a sentence of its own, as in chunking.SENTENCES
_MARK = r"^\s*(?:\d+(?:\.\d+)*[.\-)]\s|[a-zđ][.)]\s|[IVXLC]+[.)]\s|Điều\s+\d+|Khoản\s+\d+|Mục\s+[IVXLC\d])"
_SHOWN = "list_filter({}, lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g') <> '')".format
_STRIPPED = f"list_filter(list_transform(regexp_split_to_array(content, '\\n{{2,}}'), lambda x: {STRIP('x')}), lambda x: x <> '')"


def pieces_sql(source: str, keys: str, target: int, most: int = chunking.MAX) -> str:
    """CTEs from ``source`` (keys, content): ``segments``, its sentences, and ``packed`` (keys, piece, content), the pieces of texts above ``most`` words.

    Chr(1) stands for a cut. RE2 has no look-around, so signs beside a cut are matched and put back. A word that is packed alone counts two, so a part
    above the limit falls into runs of half as many words.
    """
    half = most // 2
    return f"""cuts AS (
  SELECT {keys}, content, {_STRIPPED} AS paragraphs,
    array_to_string(list_transform(string_split(content, chr(10)), lambda x, i:
      CASE WHEN regexp_matches(array_to_string(string_split(content, chr(10))[i:], chr(10)), '{_MARK}') THEN chr(1) WHEN i > 1 THEN chr(10) ELSE '' END || x), '') AS s0,
    regexp_replace(content, '([.;:])\\s*\\n|\\s{{2,}}', '\\1' || chr(1), 'g') AS s2, regexp_replace(content, '([.;])\\s+([A-ZÀ-ỸĐ-])', '\\1' || chr(1) || '\\2', 'g') AS s3
  FROM {source}
), shown AS (
  SELECT {keys}, content, paragraphs, {_SHOWN("string_split(s0, chr(1))")} AS p0, {_SHOWN("string_split(s2, chr(1))")} AS p2, {_SHOWN("string_split(s3, chr(1))")} AS p3 FROM cuts
), segments AS MATERIALIZED (
  SELECT {keys}, content, paragraphs, CASE WHEN len(p0) > 1 THEN p0 WHEN len(paragraphs) > 1 THEN paragraphs WHEN len(p2) > 1 THEN p2 WHEN len(p3) > 1 THEN p3 ELSE [content] END AS parts FROM shown
), parts AS (
  SELECT {keys}, unnest(CASE WHEN len(paragraphs) > 1 THEN paragraphs ELSE parts END) AS p, generate_subscripts(CASE WHEN len(paragraphs) > 1 THEN paragraphs ELSE parts END, 1) AS i
  FROM segments WHERE {WORDS("content")} > {most}
), runs AS (
  SELECT {keys}, i, CASE WHEN {WORDS("p")} <= {most} THEN [p]
    ELSE list_transform(range(0, ({WORDS("p")} + {half - 1}) // {half}), lambda k: array_to_string(regexp_extract_all(p, '\\S+')[k * {half} + 1:(k + 1) * {half}], ' ')) END AS r
  FROM parts
), fine AS (
  SELECT {keys}, i, unnest(r) AS p, generate_subscripts(r, 1) AS j FROM runs
), items AS MATERIALIZED (
  SELECT {keys}, p, {WORDS("p")} AS n, row_number() OVER (PARTITION BY {keys} ORDER BY i, j) AS i FROM fine
), filled AS (
  SELECT {keys}, i, n AS used, 0 AS piece FROM items WHERE i = 1
  UNION ALL
  SELECT {keys}, b.i, CASE WHEN used + n <= {target} THEN used + n ELSE n END, CASE WHEN used + n <= {target} THEN piece ELSE piece + 1 END
  FROM (SELECT {keys}, i + 1 AS i, used, piece FROM filled) JOIN items b USING ({keys}, i)
), packed AS MATERIALIZED (
  SELECT {keys}, piece, string_agg(p, chr(10) || chr(10) ORDER BY i) AS content FROM filled JOIN items USING ({keys}, i) GROUP BY {keys}, piece
)"""


def _pieces(target: int) -> str:
    return f"""
WITH RECURSIVE texts AS (SELECT doc_id, coalesce(text, '') AS content FROM documents), {pieces_sql('texts', 'doc_id', target)}
SELECT doc_id, piece, content, {WORDS('content')}::INTEGER AS tokens
FROM (SELECT * FROM packed UNION ALL SELECT doc_id, 0, content FROM texts WHERE {WORDS('content')} <= {chunking.MAX})
"""


@query(_pieces(chunking.MAX))
def flat_chunks(spark: SparkSession, d: str) -> DataFrame:
    out = chunking.flat_chunks(documents(spark, d), "text")
    return out.select("doc_id", F.posexplode("pieces").alias("piece", "content")).withColumn("tokens", T.n_tokens(F.col("content")))


@query(
    f"""WITH RECURSIVE {LEGAL_SQL}, {pieces_sql('legal', 'doc_id', chunking.MAX)} SELECT doc_id, (i - 1)::INTEGER AS no, parts[i] AS part FROM segments, unnest(range(1, len(parts) + 1)) AS t(i)
UNION ALL SELECT doc_id, (i - 1)::INTEGER, parts[i] FROM (
  SELECT -doc_id - 1 AS doc_id, CASE WHEN len(p2) > 1 THEN p2 WHEN len(p3) > 1 THEN p3 ELSE [content] END AS parts FROM (
    SELECT doc_id, content, {_SHOWN("string_split(regexp_replace(content, '([.;:])\\s*\\n|\\s{2,}', '\\1' || chr(1), 'g'), chr(1))")} AS p2,
      {_SHOWN("string_split(regexp_replace(content, '([.;])\\s+([A-ZÀ-ỸĐ-])', '\\1' || chr(1) || '\\2', 'g'), chr(1))")} AS p3 FROM (SELECT doc_id, replace(text, chr(10), ' | ') AS content FROM documents)
  )), unnest(range(1, len(parts) + 1)) AS t(i)"""
)
def sentences(spark: SparkSession, d: str) -> DataFrame:
    """Documents under headings, and (with ids below 0) documents without line breaks, so that the last ways to cut apply, too."""
    plain = documents(spark, d).select((-F.col("doc_id") - 1).alias("doc_id"), F.regexp_replace("text", "\n", " | ").alias("content"))
    parts = chunking.sentence_parts(legal(spark, d).unionByName(plain))
    return parts.select("doc_id", F.posexplode("parts").alias("no", "part"))


@query(f"WITH {UNITS_SQL} SELECT doc_id, unit_no, hierarchy_path FROM units WHERE content <> '' AND contains(lower(hierarchy_path), 'điều 2')")
def path_search(spark: SparkSession, d: str) -> DataFrame:
    return stats.path_matching(structure.units(legal(spark, d), ["doc_id"]), "Điều 2").select("doc_id", "unit_no", "hierarchy_path")


@query(_pieces(chunking.TARGET))
def oversized_split(spark: SparkSession, d: str) -> DataFrame:
    out = chunking.oversized_pieces(documents(spark, d), "text")
    return out.select("doc_id", F.posexplode("pieces").alias("piece", "content")).withColumn("tokens", T.n_tokens(F.col("content")))


_HELD = "STRUCT(c VARCHAR, u BIGINT, n BIGINT)[]"


@query(
    f"""
WITH RECURSIVE {UNITS_SQL}, asked AS (SELECT doc_id, unit_no, content FROM units WHERE content <> ''), {pieces_sql('asked', 'doc_id, unit_no', chunking.TARGET)}, u AS MATERIALIZED (
  SELECT doc_id, unit_no AS u, content AS c, {WORDS('content')} AS n, parts, list_transform(parts, lambda x, i: list_sum(list_transform(parts[:i], lambda y: {WORDS('y')}))) AS upto,
    regexp_extract_all(content, '\\S+') AS words, cut, row_number() OVER (PARTITION BY doc_id ORDER BY unit_no) AS i
  FROM segments LEFT JOIN (SELECT doc_id, unit_no, list(content ORDER BY piece) AS cut FROM packed GROUP BY ALL) USING (doc_id, unit_no)
), f AS (
  SELECT doc_id, 0::BIGINT AS i, []::{_HELD} AS held, []::{_HELD}[] AS made FROM u WHERE i = 1
  UNION ALL
  SELECT doc_id, i,
    CASE WHEN n > 1200 THEN []::{_HELD} WHEN size + n <= 1200 THEN held || [{{'c': c, 'u': u, 'n': n}}] WHEN size >= 800 THEN [{{'c': c, 'u': u, 'n': n}}]
      WHEN {STRIP('rest')} <> '' THEN [{{'c': rest, 'u': u, 'n': {WORDS('rest')}}}] ELSE []::{_HELD} END,
    CASE WHEN n > 1200 THEN CASE WHEN len(held) > 0 THEN [held] ELSE []::{_HELD}[] END || list_transform(cut, lambda x: [{{'c': x, 'u': u, 'n': {WORDS('x')}}}])
      WHEN size + n <= 1200 THEN []::{_HELD}[] WHEN size >= 800 THEN [held]
      ELSE [held || CASE WHEN {STRIP('first')} <> '' THEN [{{'c': first, 'u': u, 'n': {WORDS('first')}}}] ELSE []::{_HELD} END] END
  FROM (
    SELECT *, CASE WHEN len(parts) > 1 AND k > 0 THEN array_to_string(parts[:k], chr(10)) ELSE array_to_string(words[:(1000 - size) // 2], ' ') END AS first,
      CASE WHEN len(parts) > 1 AND k > 0 THEN array_to_string(parts[k + 1:], chr(10)) ELSE array_to_string(words[(1000 - size) // 2 + 1:], ' ') END AS rest
    FROM (
      SELECT u.*, held, size, len(list_filter(upto, lambda x: x <= 1000 - size)) AS k
      FROM (SELECT doc_id, i + 1 AS i, held, coalesce(list_sum(list_transform(held, lambda x: x.n)), 0) AS size FROM f) JOIN u USING (doc_id, i)
    )
  )
), made AS (
  SELECT doc_id, i, unnest(made) AS b, generate_subscripts(made, 1) AS j FROM f
  UNION ALL SELECT doc_id, i + 1, held, 0 FROM f WHERE len(held) > 0 AND (doc_id, i) IN (SELECT (doc_id, max(i)) FROM u GROUP BY doc_id)
), numbered_blocks AS (
  SELECT doc_id, b, row_number() OVER (PARTITION BY doc_id ORDER BY i, j) - 1 AS no, count(*) OVER (PARTITION BY doc_id) AS n_blocks, list_sum(list_transform(b, lambda x: x.n)) AS tokens FROM made
), merged AS (
  SELECT *, CASE WHEN no > 0 AND no = n_blocks - 1 AND tokens < 400 THEN 1 ELSE 0 END AS tail FROM numbered_blocks
), pieces AS (
  SELECT doc_id, no, tail, unnest(b) AS p, generate_subscripts(b, 1) AS j FROM merged
), named AS (
  SELECT doc_id, no - tail AS block_no, no, tail, j, p.c AS c, p.n AS n, level, marker, hierarchy_path AS path FROM pieces JOIN units USING (doc_id) WHERE unit_no = p.u
), paths AS (
  SELECT doc_id, block_no, string_agg(path, ' | ' ORDER BY j) AS hierarchy_path
  FROM (SELECT doc_id, block_no, path, min(j) AS j FROM named WHERE tail = 0 AND path <> '' GROUP BY ALL) GROUP BY ALL
)
SELECT doc_id, block_no::INTEGER AS block_no, string_agg(c, chr(10) || chr(10) ORDER BY no, j) AS content, arg_min(marker, (no, j)) AS start_marker, arg_max(marker, (no, j)) AS end_marker,
  arg_min(level, (no, j)) AS start_level, arg_max(level, (no, j)) AS end_level, coalesce(any_value(hierarchy_path), '') AS hierarchy_path, sum(n)::INTEGER AS tokens
FROM named LEFT JOIN paths USING (doc_id, block_no) GROUP BY doc_id, block_no
"""
)
def token_blocks(spark: SparkSession, d: str) -> DataFrame:
    return chunking.array_blocks(structure.unit_arrays(legal(spark, d), ["doc_id"]).where(F.size("u") > 0), ["doc_id"])


@query(
    f"""
WITH {UNITS_SQL}, b AS (
  SELECT doc_id, unit_no, 'chunk_' || (doc_id % 5) || '_' || coalesce(nullif(regexp_replace(regexp_replace(lower(strip_accents(replace(replace(marker, 'đ', 'd'), 'Đ', 'd'))), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'root') AS base_id
  FROM units WHERE content <> '' AND level <> 'sub_item'
)
SELECT doc_id, unit_no, CASE WHEN n = 0 THEN base_id ELSE base_id || '_' || n END AS id
FROM (SELECT *, row_number() OVER (PARTITION BY base_id ORDER BY doc_id, unit_no) - 1 AS n FROM b)
"""
)
def chunk_ids_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Of all units but sub-items; their ids never meet another base, so that SQL can number them."""
    return _unit_ids(structure.units(legal(spark, d), ["doc_id"]).where("level <> 'sub_item'"))


@query()
def chunk_ids_all(spark: SparkSession, d: str) -> DataFrame:
    """Of all units; SQL cannot say the loop over ids that other bases have taken."""
    return _unit_ids(structure.units(legal(spark, d), ["doc_id"]))


def _unit_ids(u: DataFrame) -> DataFrame:
    u = u.withColumn("base_id", T.range_id((F.col("doc_id") % 5).cast("string"), F.col("marker"), F.col("marker")))
    return chunking.unique_ids(u, "base_id", "doc_id", "unit_no").select("doc_id", "unit_no", "id")


@query()
def chunk_meta(spark: SparkSession, d: str) -> DataFrame:
    """The whole chunk builder over documents with headings."""
    docs = legal(spark, d).select(F.col("doc_id"), F.format_string("doc/%012d", "doc_id").alias("path"), F.col("doc_id").cast("string").alias("doc_number"), "content")
    return chunking.build_chunks(structure.passages(docs, ["doc_id", "path", "doc_number"]))
