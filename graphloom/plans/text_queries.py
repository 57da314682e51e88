"""Queries of the text functions and of the statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import markers, subwords, text as T
from ..operators import stats
from .base import LEGAL_SQL, STRIP, TOKENS, WORDS, chunks, documents, legal, query, questions, table

_NORMAL = STRIP("regexp_replace(regexp_replace(replace(coalesce(text, ''), chr(13), chr(10)), '[ \\t]+', ' ', 'g'), '\\n{3,}', chr(10) || chr(10), 'g')")


@query(f"SELECT doc_id, {_NORMAL} AS normal FROM documents")
def normalize_text(spark: SparkSession, d: str) -> DataFrame:
    return documents(spark, d).select("doc_id", T.normalize_text(F.col("text")).alias("normal"))


@query(
    r"""
WITH a AS (SELECT doc_id, regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'), '\n\s*\n', chr(10) || chr(10), 'g') AS t FROM documents),
b AS (SELECT doc_id, array_to_string(list_transform(string_split(t, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), chr(10)) AS t FROM a),
c AS (SELECT doc_id, regexp_replace(regexp_replace(t, '\n\*+\n', chr(10), 'g'), '(?m)^\*+$', '', 'g') AS t FROM b)
SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(t, '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') AS clean
FROM c
"""
)
def clean_text_advanced(spark: SparkSession, d: str) -> DataFrame:
    return documents(spark, d).select("doc_id", T.clean_text(F.col("text")).alias("clean"))


@query(
    r"""
WITH n AS (SELECT doc_id, doc_id || '_' || source || '_' || (doc_id % 7) AS stem, text FROM documents),
l AS (SELECT doc_id, stem, list_filter(list_transform(list_slice(string_split(text, chr(10)), 1, 10), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')),
  lambda x: x <> '' AND x <> '********' AND NOT contains(x, 'CỘNG') AND NOT contains(x, 'Độc lập')) AS lines FROM n)
SELECT doc_id, replace(regexp_replace(stem, '_(\d+)$', ''), '_', '/') AS doc_number, coalesce(lines[1], '') AS issuing_body FROM l
"""
)
def doc_metadata(spark: SparkSession, d: str) -> DataFrame:
    stem = F.concat_ws("_", F.col("doc_id").cast("string"), "source", (F.col("doc_id") % 7).cast("string"))
    return table(spark, d, "documents").select("doc_id", T.doc_number(stem).alias("doc_number"), T.issuing_body(F.col("text")).alias("issuing_body"))


@query(
    r"""SELECT doc_id, regexp_replace(regexp_replace(lower(strip_accents(replace(replace(replace(replace(text, 'đ', 'd'), 'Đ', 'd'), 'ø', 'o'), 'ß', '_'))), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug FROM documents"""
)
def slugify(spark: SparkSession, d: str) -> DataFrame:
    return documents(spark, d).select("doc_id", T.slugify(F.col("text")).alias("slug"))


@query(f"SELECT doc_id, array_to_string({TOKENS('text')}, ' ') AS tokens, len({TOKENS('text')})::INTEGER AS n FROM documents")
def tokenize_vi(spark: SparkSession, d: str) -> DataFrame:
    t = T.tokenize(F.col("text"))
    return documents(spark, d).select("doc_id", F.array_join(t, " ").alias("tokens"), F.size(t).alias("n"))


@query(
    r"""
WITH p AS (SELECT doc_id, list_filter(regexp_split_to_array(regexp_replace(text, '([.;:])\s*\n', '\1  ', 'g'), '\s{2,}'), lambda x: x <> '') AS parts FROM documents)
SELECT doc_id, (i - 1)::INTEGER AS no, parts[i] AS part FROM p, unnest(range(1, len(parts) + 1)) AS t(i)
"""
)
def sentence_split_l3(spark: SparkSession, d: str) -> DataFrame:
    """The third way to cut sentences: after punctuation at a line's end, or at runs of blanks."""
    parts = F.filter(F.split("text", r"(?<=[.;:])\s*\n|\s{2,}", -1), lambda x: T.strip(x) != "")
    return documents(spark, d).select("doc_id", F.posexplode(parts).alias("no", "part")).withColumn("part", F.regexp_replace("part", "^[ \n]+", ""))


_SHOWN = "list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '')"


@query(
    f"""
WITH l AS (SELECT doc_id, {_SHOWN} AS lines FROM documents)
SELECT doc_id, len(lines) >= 6 AND len(list_filter(lines, lambda x: length(x) <= 12)) >= 0.6 * len(lines) AS corrupted, array_to_string(lines, ' ') AS collapsed FROM l
"""
)
def corrupted_block(spark: SparkSession, d: str) -> DataFrame:
    return documents(spark, d).select("doc_id", T.is_corrupted_block(F.col("text")).alias("corrupted"), T.collapse_block(F.col("text")).alias("collapsed"))


@query("SELECT doc_id, substr(text, 1, 3500) AS nim, substr(text, 1, 6000) AS gpt, CASE WHEN length(text) > 8000 THEN substr(text, 1, 8000) || ' [cut]' ELSE text END AS marked FROM documents")
def truncate_prefix(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return documents(spark, d).select("doc_id", T.truncate(t, 3500).alias("nim"), T.truncate(t, 6000).alias("gpt"), T.truncate(t, 8000, " [cut]").alias("marked"))


@query("SELECT event_id, 1::INTEGER AS n, (props->>'$.k') AS k FROM events")
def json_array_parse(spark: SparkSession, d: str) -> DataFrame:
    """Objects of an array inside other text, as a language model answers."""
    answer = F.concat(F.lit("Here:\n```json\n["), "props", F.lit(", 7]\n```"))
    objects = table(spark, d, "events").select("event_id", T.json_objects(answer).alias("o"))
    return objects.select("event_id", F.size("o").alias("n"), F.get_json_object(F.col("o")[0], "$.k").alias("k"))


@query("SELECT event_id, greatest(0.1, least(1.0, coalesce(value / 10, 0.5)))::DOUBLE AS weight, greatest(0.1, least(1.0, coalesce(TRY_CAST(event_type AS DOUBLE), 0.5)))::DOUBLE AS fallback FROM events")
def weight_clamp(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", T.weight((F.col("value") / 10).cast("string")).alias("weight"), T.weight(F.col("event_type")).alias("fallback"))


@query(
    """SELECT conv_id, turn, 'query: ' || text AS dense, CASE WHEN role = 'user' THEN '[Tình huống thực tế]: ' || role || chr(10) || '[Câu hỏi]: ' || text ELSE text END AS question
FROM conversations"""
)
def eval_questions(spark: SparkSession, d: str) -> DataFrame:
    case = F.when(F.col("role") == "user", F.col("role"))
    return table(spark, d, "conversations").select("conv_id", "turn", T.query_text(F.col("text")).alias("dense"), T.question(F.col("text"), case).alias("question"))


def lines_sql(rules: list) -> str:
    """SQL of the lines of the legal view with level and label by these rules."""
    level, label = "", ""
    for name, pattern, before in rules:
        p = pattern.replace("(?iu)", "(?i)").replace("'", "''")
        level += f" WHEN regexp_matches(s, '{p}') THEN '{name}'"
        label += f" WHEN regexp_matches(s, '{p}') THEN " + ("s" if before is None else f"'{before}' || regexp_extract(s, '{p}', 1)")
    return f"""{LEGAL_SQL}, raw AS (
  SELECT doc_id, unnest(string_split(content, chr(10))) AS line, generate_subscripts(string_split(content, chr(10)), 1) - 1 AS line_no FROM legal
), lines AS (
  SELECT doc_id, line_no, line, CASE{level} ELSE '' END AS level, CASE{label} ELSE '' END AS label FROM (SELECT *, {STRIP("line")} AS s FROM raw)
)"""


LINES_SQL = lines_sql(markers.RULES)


@query(f"WITH {LINES_SQL} SELECT doc_id, line_no::INTEGER AS line_no, level, label FROM lines")
def marker_classify(spark: SparkSession, d: str) -> DataFrame:
    lines = legal(spark, d).select("doc_id", F.posexplode(F.split("content", "\n", -1)).alias("line_no", "line"))
    return lines.select("doc_id", "line_no", markers.classify(F.col("line")).alias("m")).select("doc_id", "line_no", "m.level", "m.label")


@query(f"""WITH {LEGAL_SQL} SELECT l.doc_id, regexp_matches(d.text, '{markers.ANY}') AS raw, regexp_matches(l.content, '{markers.ANY}') AS legal FROM legal l JOIN documents d USING (doc_id)""")
def has_markers_branch(spark: SparkSession, d: str) -> DataFrame:
    both = legal(spark, d).join(documents(spark, d), "doc_id")
    return both.select("doc_id", markers.has_markers(F.col("text")).alias("raw"), markers.has_markers(F.col("content")).alias("legal"))


def sized(spark: SparkSession, d: str) -> DataFrame:
    return chunks(spark, d).select("chunk_idx", T.n_tokens(F.col("content")).alias("tokens"))


_SIZED = f"sized AS (SELECT doc_id AS chunk_idx, {WORDS('text')}::INTEGER AS tokens FROM documents)"


@query(f"WITH {_SIZED} SELECT count(*) AS n, max(tokens) AS most, min(tokens) AS least, avg(tokens) AS mean FROM sized")
def chunk_token_stats(spark: SparkSession, d: str) -> DataFrame:
    return stats.token_stats(sized(spark, d))


@query(f"WITH {_SIZED} SELECT quantile_cont(tokens, 0.25)::DOUBLE AS q1, quantile_cont(tokens, 0.5)::DOUBLE AS q2, quantile_cont(tokens, 0.75)::DOUBLE AS q3 FROM sized")
def token_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return stats.token_quartiles(sized(spark, d))


@query(
    f"""WITH {_SIZED}, bins(low, high) AS (VALUES (0, 400), (400, 800), (800, 1000), (1000, 1201))
SELECT low::INTEGER AS low, count(tokens)::BIGINT AS n, round(100.0 * count(tokens) / (SELECT count(*) FROM sized), 4)::DOUBLE AS percent
FROM bins LEFT JOIN sized ON tokens >= low AND tokens < high GROUP BY low"""
)
def token_histogram(spark: SparkSession, d: str) -> DataFrame:
    return stats.token_histogram(sized(spark, d))


@query(f"WITH {_SIZED} SELECT chunk_idx, tokens FROM sized ORDER BY tokens, chunk_idx LIMIT 1")
def smallest_chunk(spark: SparkSession, d: str) -> DataFrame:
    return stats.smallest_chunk(sized(spark, d))


@query("SELECT lang, source, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 4)::DOUBLE AS percent FROM documents GROUP BY lang, source")
def docs_by_group_pct(spark: SparkSession, d: str) -> DataFrame:
    return stats.share_by(table(spark, d, "documents"), "lang", "source")


@query("SELECT year(o_orderdate)::INTEGER AS year, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, year LIMIT 10")
def top_groups(spark: SparkSession, d: str) -> DataFrame:
    return stats.top_groups(table(spark, d, "orders").select(F.year("o_orderdate").alias("year")), "year")


@query("SELECT min(strlen(text))::INTEGER AS least, avg(strlen(text)) AS mean, max(strlen(text))::INTEGER AS most FROM documents")
def size_profile(spark: SparkSession, d: str) -> DataFrame:
    return stats.size_profile(documents(spark, d), "text")


@query("SELECT doc_id AS chunk_idx, substr(text, 1, 800) AS preview FROM documents WHERE contains(lower(text), 'example.com') OR contains(lower(text), 'password') OR contains(text, '555-') OR contains(text, '63,5')")
def substring_search(spark: SparkSession, d: str) -> DataFrame:
    return stats.matching(chunks(spark, d), ["example.com", "password"], ["555-", "63,5"])


@query("SELECT item_id AS query_id, 'List' AS head, length(text)::INTEGER AS n FROM benchmark")
def prompt_render(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.extract import entity_prompt

    q = questions(spark, d).withColumn("p", entity_prompt(F.col("query")))
    return q.select("query_id", F.substring("p", 1, 4).alias("head"), F.length(F.element_at(F.split("p", "TEXT:\n", 2), 2)).alias("n"))


#: A public vocabulary, one base64 piece and its rank in a line.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


@query()
def subword_tokens(spark: SparkSession, d: str, path: str = VOCABULARY) -> DataFrame:
    """Tokens of each document under a public vocabulary, and as words."""
    counter = subwords.SubwordCounter.of(subwords.vocabulary(spark, path))
    return documents(spark, d).select("doc_id", subwords.n_subwords(F.col("text"), counter).alias("subwords"), T.n_tokens(F.col("text")).alias("words"))
