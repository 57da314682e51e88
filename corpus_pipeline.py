"""The corpus pipeline: five stages, each over all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's docs. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm import line_dedup, mixing, near_dup, packing, toxicity
from graphloom.llm.common import carried, table, unpacked
from graphloom.llm.common import stage as written


def _aside(docs: DataFrame, name: str) -> tuple[DataFrame, list]:
    """docs with a column of an operator's own name under another one, and the columns to select at last, under their names."""
    other = name
    while other in docs.columns:
        other += "_"
    return docs.withColumnRenamed(name, other), [F.col(f"`{other if c == name else c}`").alias(c) for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose toxicity score is below the threshold; no text is no reason to go. A column called ``_score`` stays what it is."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    named, columns = _aside(docs, "_score")
    return toxicity.score(named, model).where(F.col("_score") < toxicity.THRESHOLD).select(*columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated chunks of lines; the number of characters follows the text. A column called ``_removed_lines`` stays what it is."""
    named, columns = _aside(docs, "_removed_lines")
    out = line_dedup.dedup_lines(named)
    n_chars = F.when(F.col("_removed_lines") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", n_chars).select(*columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies (five words, 80 %), that of the smallest doc_id, and every one without words."""
    rows = near_dup.near_duplicates(docs, size=5, percent=80)
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "th")
    firsts = rows.where("part is not null").groupBy("part").agg(F.min(place).alias("p")).select(F.col("p.doc_id").alias("d"), F.col("p.th").alias("t"))
    keyed = docs.select("doc_id", F.xxhash64("text").alias("th"), carried(docs).alias("row"))
    marked = keyed.join(firsts.hint("merge"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")))
    # of rows equal in doc_id and text the one whose other columns have the least hash
    one = marked.groupBy("d", "t").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select(*unpacked(docs))
    words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return one.union(docs.where(~words))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, with their words, in sequences of the permitted lengths; the mixture's copies of a document are told apart by ``copy``."""
    return packing.pack(docs, texts=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near copies", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can express neither the toxicity model nor the rounding; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, f in STAGES[:-1]:
        docs = written(f(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
