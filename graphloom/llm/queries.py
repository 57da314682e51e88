"""The queries of the training-data operators and, where SQL can say it, their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversations, html_text, line_dedup, media, mixing, near_dup, ngram_join, packing, sharding, spelling, substring_dedup, topk, toxicity
from .common import table


def op1_mix_pivotal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op2_avi_mjpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = media.read_media(media.store_texts(table(spark, sf_dir, "documents").select("doc_id", "text")))
    size = F.octet_length("payload")
    return read.select(
        "doc_id", "n_bytes", size.cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", size - 63, F.lit(64))).alias("tail_crc32"), "media_bytes", "media_sha256", "feature", F.size("clips").alias("n_clips"),
    )


def op3_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


def op4_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, lines removed, SHA-256 of the text that stays."""
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("_removed_lines").alias("removed_lines"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH l AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents
), h AS (
  SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h FROM l
), b AS (
  SELECT *, CASE WHEN i = 1 THEN 1 WHEN (coalesce(lag(h, 2) OVER w, 0) * 31 + lag(h) OVER w) % 4 = 0 THEN 1 ELSE 0 END AS begins
  FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), c AS (
  SELECT doc_id, line, i, sum(begins) OVER (PARTITION BY doc_id ORDER BY i) AS no FROM b
), chunk AS (
  SELECT doc_id, no, string_agg(line, chr(10) ORDER BY i) AS body, count(*) AS n FROM c GROUP BY ALL
), m AS (
  SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, no) > 1 AND n > 1 AND regexp_matches(body, '[^\s]') AS gone FROM chunk
), r AS (
  SELECT doc_id, sum(n) FILTER (gone) AS removed, coalesce(string_agg(body, chr(10) ORDER BY no) FILTER (NOT gone), '') AS kept FROM m GROUP BY doc_id
)
SELECT d.doc_id, coalesce(removed, 0)::BIGINT AS removed_lines, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN r USING (doc_id)
"""


def op5_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_text.extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", F.col("_text").alias("text"))


def op6_dual_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", topk.scaled(F.col("embedding")).alias("v"))
    return topk.top_k(vectors.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id"), vectors, 20)


OP6_SQL = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), q AS (
  SELECT DISTINCT vec_id AS query_id, v FROM v WHERE vec_id % 20 = 0
), s AS (
  SELECT query_id, q.v, p.vec_id, list_inner_product(q.v, p.v)::BIGINT AS score FROM q JOIN v p ON q.query_id <> p.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id, v ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
"""


def op7_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80).drop("th", "part")


OP8_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS g FROM d, unnest(range(1, greatest(len(w) - 2, 2))) AS t(i) WHERE len(w) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL
), e AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)
), r AS (
  SELECT a AS doc_id, a AS other FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.other
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(least(d.doc_id, m.least_id), d.doc_id)::BIGINT AS component_id,
  coalesce(least(d.doc_id, m.least_id), d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(other) AS least_id FROM r GROUP BY doc_id) m USING (doc_id)
"""


def op9_de_bruijn(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("_n_words").alias("n_words"), F.col("_n_removed").alias("n_removed"), F.sha2("_kept", 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS h FROM d, unnest(range(1, len(w) - 48)) AS t(i)
), f AS (
  SELECT h, min(doc_id) AS source FROM win GROUP BY h
), c AS (
  SELECT DISTINCT doc_id, i + j AS p FROM win JOIN f USING (h), range(50) AS r(j) WHERE source < doc_id
), k AS (
  SELECT d.doc_id, p, w[p] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(p)
), s AS (
  SELECT k.doc_id, string_agg(word, ' ' ORDER BY k.p) AS kept, count(*) AS n FROM k LEFT JOIN c ON c.doc_id = k.doc_id AND c.p = k.p
  WHERE c.p IS NULL GROUP BY k.doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s USING (doc_id)
"""


def op10_noisy_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    out = toxicity.score(docs, model)
    return out.select(
        "doc_id", (toxicity.fold(F.col("doc_id")) == 0).alias("held_out"), F.col("_score").alias("score"),
        (F.col("_score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op11_q_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.counted(spelling.damaged_words(table(spark, sf_dir, "documents")))
    return spelling.variants(words)


#: CRC-32 of the bytes of x, with T its table; DuckDB has no such function.
_CRC = """T AS MATERIALIZED (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
)"""
_CRC_OF = """xor(list_reduce(list_prepend(4294967295, list_transform(range(1, 2 * strlen({x}), 2), lambda i: ('0x' || substr(hex({x}), i, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)""".format

OP11_SQL = f"""
WITH {_CRC}, runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' AS d, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w
  FROM documents
), one AS (
  SELECT d || w AS x, w, count(*) AS n FROM runs GROUP BY ALL
), h AS (
  SELECT w, n, {_CRC_OF(x='x')} AS h FROM one, T
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 97 = 0 THEN substr(w, 1, (h % length(w))::BIGINT) || substr(w, (h % length(w))::BIGINT + 2) ELSE w END AS word FROM h
  ) WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), v AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS d FROM words, unnest(range(1, length(word) + 1)) AS r(i)
), pairs AS (
  SELECT DISTINCT a.word AS a, b.word AS b FROM v a JOIN v b ON a.i = b.i AND a.d = b.d AND a.word <> b.word
  UNION SELECT v.word, w.word FROM v JOIN words w ON v.d = w.word UNION SELECT w.word, v.word FROM v JOIN words w ON v.d = w.word
), near AS (
  SELECT a AS word, count(*) AS n_near, arg_min(b, (-n, b)) AS best, max(n) AS best_n FROM pairs JOIN words ON word = b GROUP BY a
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * w.n THEN best END AS form, CASE WHEN best_n >= 2 * w.n THEN best_n END AS form_n FROM words w LEFT JOIN near USING (word)
), chain AS (
  SELECT word, form AS at FROM forms WHERE form IS NOT NULL UNION SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.at WHERE f.form IS NOT NULL
), tops AS (
  SELECT c.word, c.at FROM chain c JOIN forms f ON f.word = c.at WHERE f.form IS NULL
)
SELECT f.word, f.form, coalesce(t.at, f.word) AS root, f.n, f.n_near, f.form_n FROM forms f LEFT JOIN tops t USING (word)
""".replace("WITH T AS", "WITH RECURSIVE T AS")


def op12_audit_dp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.audit_report(table(spark, sf_dir, "conversations"))


OP12_SQL = f"""
WITH {_CRC}, raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS x FROM conversations
), h AS (
  SELECT *, {_CRC_OF(x='x')} % 20 AS h FROM raw, T
), dam AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role, CASE WHEN h = 1 THEN '' WHEN h = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) AS copy FROM h WHERE h <> 0
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    left(role, 1) AS ini, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last FROM dam
), rows AS (
  SELECT *, CASE WHEN last = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(ini) OVER (PARTITION BY conv_id ORDER BY i) AS ini0 FROM o
), ed(s, letter, ini, s2, c) AS (
  VALUES (0, 'K', 's', 1, 0), (0, 'K', 'u', 2, 0), (1, 'K', 'u', 2, 0), (2, 'K', 'a', 3, 0), (3, 'K', 'u', 2, 0), (0, 'R', NULL, 2, 1), (1, 'R', NULL, 2, 1), (2, 'R', NULL, 3, 1), (3, 'R', NULL, 2, 1),
    (0, 'D', NULL, 0, 2), (1, 'D', NULL, 1, 2), (2, 'D', NULL, 2, 2), (3, 'D', NULL, 3, 2)
), ins(s, s2, letters, c) AS (
  VALUES (0, 0, '', 0), (1, 1, '', 0), (2, 2, '', 0), (3, 3, '', 0), (0, 2, 'I', 5), (0, 3, 'II', 10), (1, 2, 'I', 5), (1, 3, 'II', 10), (2, 3, 'I', 5), (3, 2, 'I', 5)
), dp AS (
  SELECT conv_id, 0::BIGINT AS i, s2 AS s, struct_pack(c := c::BIGINT, a := letters) AS best FROM (SELECT DISTINCT conv_id FROM rows), ins WHERE s = 0
  UNION ALL
  SELECT r.conv_id, r.i, ins.s2 AS s, min(struct_pack(c := best.c + ed.c + ins.c + CASE WHEN letter <> 'D' AND fault = 'truncated' THEN 5 ELSE 0 END, a := best.a || letter || letters)) AS best
  FROM dp JOIN rows r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.i = dp.i + 1 JOIN ed ON ed.s = dp.s AND (ed.ini IS NULL OR ed.ini = r.ini) AND (letter = 'D' OR fault NOT IN ('blank', 'duplicate'))
    JOIN ins ON ins.s = ed.s2 GROUP BY r.conv_id, r.i, ins.s2
), fin AS (
  SELECT dp.conv_id, min(best) AS best FROM dp JOIN (SELECT conv_id, max(i) AS i FROM rows GROUP BY conv_id) m USING (i) WHERE dp.conv_id IS NOT DISTINCT FROM m.conv_id AND s IN (0, 3) GROUP BY dp.conv_id
), play AS (
  SELECT conv_id, 0 AS p, 0::BIGINT AS i, 0 AS s, NULL::VARCHAR AS said FROM fin
  UNION ALL
  SELECT conv_id, p, i, CASE WHEN letter = 'D' THEN s ELSE CASE step WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END END,
    CASE WHEN letter = 'D' THEN said ELSE coalesce(said || chr(10), '') || CASE WHEN letter = 'K' THEN role WHEN step = 'u' THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, '') END
  FROM (
    SELECT f.conv_id, p + 1 AS p, play.i + (l.letter <> 'I')::BIGINT AS i, s, said, l.letter, r.role, r.text, CASE WHEN l.letter = 'K' THEN r.ini WHEN s = 2 THEN 'a' ELSE 'u' END AS step
    FROM play JOIN fin f ON f.conv_id IS NOT DISTINCT FROM play.conv_id AND p < length(best.a), LATERAL (SELECT substr(best.a, p + 1, 1) AS letter) l
      LEFT JOIN rows r ON r.conv_id IS NOT DISTINCT FROM f.conv_id AND l.letter <> 'I' AND r.i = play.i + 1
  )
), stats AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (ini0 IS NOT NULL AND ini0 || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM rows GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN stats s ON s.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN fin f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
  LEFT JOIN play p ON p.conv_id IS NOT DISTINCT FROM c.conv_id AND p.p = length(best.a)
""".replace("WITH T AS", "WITH RECURSIVE T AS")


def op13_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"), size=5, percent=80).select("doc_id", "n_shingles", "component_id")


OP13_SQL = (
    OP8_SQL.replace("i + 3", "i + 4").replace("len(w) - 2, 2", "len(w) - 3, 2")
    .replace(""" AS component_id,
  coalesce(least(d.doc_id, m.least_id), d.doc_id) = d.doc_id AS kept""", " AS component_id")
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mix_pivotal": op1_mix_pivotal,
        "op2_avi_mjpeg": op2_avi_mjpeg,
        "op3_virtual_slots": op3_virtual_slots,
        "op4_line_chunks": op4_line_chunks,
        "op5_html_layout": op5_html_layout,
        "op6_dual_tree": op6_dual_tree,
        "op7_best_fit": op7_best_fit,
        "op8_chosen_path": op8_chosen_path,
        "op9_de_bruijn": op9_de_bruijn,
        "op10_noisy_channel": op10_noisy_channel,
        "op11_q_chunks": op11_q_chunks,
        "op12_audit_dp": op12_audit_dp,
        "op13_orders": op13_orders,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_line_chunks": OP4_SQL, "op6_dual_tree": OP6_SQL, "op8_chosen_path": OP8_SQL, "op9_de_bruijn": OP9_SQL, "op11_q_chunks": OP11_SQL, "op12_audit_dp": OP12_SQL, "op13_orders": OP13_SQL}
