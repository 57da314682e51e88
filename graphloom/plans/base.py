"""Views of the given tables that the registered queries work on, and the registry itself."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with the DuckDB SQL of the same result."""
    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as chunks."""
    return documents(spark, sf_dir).select(F.col("doc_id").alias("chunk_idx"), F.col("text").alias("content"))


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def legal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with headings put before their lines in a fixed cycle."""
    def head(i):
        six = (i % 6).cast("int")
        roman = F.substring(F.lit("IVXL"), (F.floor(i / 6) % 4 + 1).cast("int"), F.lit(1))
        n = i.cast("string")
        return (
            F.when(six == 0, F.concat(F.lit("Chương "), roman, F.lit(" ")))
            .when(six == 1, F.concat(F.lit("Điều "), (i + 1).cast("string"), F.lit(". ")))
            .when(six == 2, F.concat(n, F.lit(". ")))
            .when(six == 3, F.lit("a) "))
            .when(six == 4, F.lit("1.2 "))
            .otherwise(F.lit(""))
        )

    lines = F.transform(F.split("text", "\n", -1), lambda x, i: F.concat(head(i), x))
    return documents(spark, sf_dir).select("doc_id", F.array_join(lines, "\n").alias("content"))


STRIP = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')".format
LEGAL_SQL = """legal AS (
  SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda x, i:
    CASE (i - 1) % 6 WHEN 0 THEN 'Chương ' || substr('IVXL', ((i - 1) // 6) % 4 + 1, 1) || ' ' WHEN 1 THEN 'Điều ' || i || '. '
      WHEN 2 THEN (i - 1) || '. ' WHEN 3 THEN 'a) ' WHEN 4 THEN '1.2 ' ELSE '' END || x), chr(10)) AS content
  FROM documents
)"""
TOKENS = "list_filter(regexp_split_to_array(regexp_replace(lower({}), '[!-/:-@\\[-`{{-~]', ' ', 'g'), '\\s+'), lambda x: x <> '')".format
WORDS = "len(regexp_extract_all({}, '\\S+'))".format
