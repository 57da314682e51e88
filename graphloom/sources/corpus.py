"""Reading text corpora and question sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_text, doc_number, issuing_body, question

MIN_CHARS = 50
EVAL_FIELDS = "type:string,query:string,expected_answer:string,`case`:string"


def text_files(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """(path, content) of all *.txt files below a folder, content as bytes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", "*.txt")
    return files.load(root).select("path", "content")


def decoded(content):
    """UTF-8 without a byte order mark; anything else as Latin-1."""
    text = F.when(F.is_valid_utf8(content.cast("string")), content.cast("string")).otherwise(F.decode(content, "ISO-8859-1"))
    return F.regexp_replace(text, "^﻿", "")


def load_documents(spark: SparkSession, root: str, dataset: str = "DATASET") -> DataFrame:
    """(doc_id, path, content, doc_number, issuing_body) of cleaned texts of 50 characters or more."""
    files = text_files(spark, root)
    base = root.rstrip("/").split(":", 1)[-1].lstrip("/")
    relative = F.regexp_replace(F.regexp_replace("path", r"^[a-z]+:/+", ""), F.lit(rf"^\Q{base}\E/"), F.lit(""))
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.txt$", "")
    raw = F.regexp_replace(decoded(F.col("content")), r"\r\n?", "\n")
    docs = files.select(stem.alias("doc_id"), F.concat(F.lit(f"{dataset}::"), relative).alias("path"), clean_text(raw).alias("content"))
    docs = docs.where(F.length("content") >= MIN_CHARS)
    return docs.select("doc_id", "path", "content", doc_number(F.col("doc_id")).alias("doc_number"), issuing_body(F.col("content")).alias("issuing_body"))


def load_questions(spark: SparkSession, path: str) -> DataFrame:
    """(query_id, type, query, expected_answer, case, question) of a JSON array file; query_id is the place in the file, from 1."""
    file = spark.read.text(path, wholetext=True)
    rows = file.select(F.posexplode(F.from_json("value", f"array<struct<{EVAL_FIELDS}>>")).alias("i", "r"))
    asked = rows.select((F.col("i") + 1).cast("long").alias("query_id"), "r.*")
    return asked.withColumn("question", question(F.col("query"), F.col("case")))
