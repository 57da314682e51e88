"""Corpus and chunk statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Lower ends of the token histogram's bins; 1201 and more is in none.
BINS = (0, 400, 800, 1000)
TOP_BIN = 1201


def token_stats(chunks: DataFrame) -> DataFrame:
    return chunks.agg(F.count("*").alias("n"), F.max("tokens").alias("most"), F.min("tokens").alias("least"), F.avg("tokens").alias("mean"))


def token_quartiles(chunks: DataFrame) -> DataFrame:
    """Exact quartiles, linear between ranks."""
    q = F.percentile("tokens", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return chunks.agg(q.alias("q")).select(F.col("q")[0].alias("q1"), F.col("q")[1].alias("q2"), F.col("q")[2].alias("q3"))


def token_histogram(chunks: DataFrame) -> DataFrame:
    """(low, n, percent) for each bin, empty ones too; one aggregation, a column a bin."""
    ends = [*BINS[1:], TOP_BIN]
    row = chunks.agg(F.count("*").alias("all"), *[F.count_if((F.col("tokens") >= lo) & (F.col("tokens") < hi)).alias(f"b{lo}") for lo, hi in zip(BINS, ends, strict=True)])
    bins = F.array(*[F.struct(F.lit(lo).alias("low"), F.col(f"b{lo}").alias("n")) for lo in BINS])
    return row.select("all", F.inline(bins)).select("low", "n", F.round(100 * F.col("n") / F.greatest("all", F.lit(1)), 4).alias("percent"))


def smallest_chunk(chunks: DataFrame) -> DataFrame:
    """The chunk of fewest tokens, the first on ties."""
    return chunks.agg(F.min_by(F.struct("chunk_idx", "tokens"), F.struct("tokens", "chunk_idx")).alias("c")).select("c.*")


def share_by(df: DataFrame, *keys: str) -> DataFrame:
    """(keys, n, percent of all)."""
    n = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return n.withColumn("percent", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy()), 4))


def top_groups(df: DataFrame, key: str, k: int = 10) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key).limit(k)


def size_profile(df: DataFrame, text: str) -> DataFrame:
    size = F.octet_length(text)
    return df.agg(F.min(size).alias("least"), F.avg(size).alias("mean"), F.max(size).alias("most"))


def matching(chunks: DataFrame, anywhere: list[str], exact: list[str], preview: int = 800) -> DataFrame:
    """(chunk_idx, preview) of chunks that hold one of the phrases, the first list in any case."""
    test: Column = F.lit(False)
    for s in anywhere:
        test = test | F.contains(F.lower("content"), F.lit(s))
    for s in exact:
        test = test | F.contains(F.col("content"), F.lit(s))
    return chunks.where(test).select("chunk_idx", F.substring("content", 1, preview).alias("preview"))


def path_matching(chunks: DataFrame, phrase: str) -> DataFrame:
    """Chunks under a heading that holds the phrase."""
    return chunks.where(F.contains(F.lower("hierarchy_path"), F.lit(phrase.lower())))


def tree_profile(units: DataFrame, *keys: str) -> DataFrame:
    """One row: headings per document (mean, least, most) and depth of their paths (mean, most)."""
    depth = F.when(F.col("hierarchy_path") == "", 0).otherwise(F.size(F.split("hierarchy_path", " > ")))
    per = units.groupBy(*keys).agg(F.count("*").alias("n"), F.max(depth).alias("depth"))
    return per.agg(F.round(F.avg("n"), 6).alias("mean"), F.min("n").alias("least"), F.max("n").alias("most"), F.round(F.avg("depth"), 6).alias("mean_depth"), F.max("depth").alias("most_depth"))
