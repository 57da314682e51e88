"""The build's tables as Parquet, and its metadata and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lineage import cut
from ..operators.structure import joined

#: What a build writes; the vector table is partitioned by collection.
TABLES = (
    "chunks", "entities_raw", "relations_raw", "nodes", "edges", "bridge", "chunk_entities", "entity_to_chunks", "entity_directory", "chunks_meta", "graph_nodes", "entity_names", "vectors", "meta",
)


def save(df: DataFrame, root: str, name: str, mode: str = "overwrite", partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Writes a table and gives it back as read from there, which also cuts the plan."""
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{root}/{name}")
    return load(df.sparkSession, root, name)


def load(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}")


def exists(spark: SparkSession, root: str, name: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def save_vectors(vectors: DataFrame, root: str) -> DataFrame:
    """(collection, idx, embedding)."""
    return save(vectors, root, "vectors", partition_by=("collection",))


def load_collection(spark: SparkSession, root: str, collection: str) -> DataFrame:
    """One named collection; KeyError if there is none."""
    found = load(spark, root, "vectors").where(F.col("collection") == collection)
    if found.isEmpty():
        raise KeyError(collection)
    return found


def collection_sizes(vectors: DataFrame) -> DataFrame:
    return vectors.groupBy("collection").agg(F.count("*").alias("n"))


def save_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines; non-ASCII letters stay."""
    df.write.mode(mode).json(path)


def save_json_array(df: DataFrame, path: str, *order: str, mode: str = "overwrite") -> None:
    """One pretty JSON array over ordered part files: read one after the other by name, they are the array. An empty table gives ``[]``.

    Rows are dealt by ranges of their order; only how many rows each range has is gathered, to know where the array begins and ends.
    """
    columns = [F.col(c) for c in order] or [F.lit(0)]
    rows = df.select(*columns, F.to_json(F.struct(*df.columns), {"pretty": "true", "ignoreNullFields": "false"}).alias("_json"))
    dealt = rows.repartitionByRange(*[c.asc_nulls_first() for c in columns]).sortWithinPartitions(*[c.asc_nulls_first() for c in columns])
    dealt = cut(dealt.select("_json", F.monotonically_increasing_id().alias("_at")))
    first, last = dealt.agg(F.min("_at"), F.max("_at")).first()
    if first is None:
        df.sparkSession.range(1).select(F.lit("[]").alias("value")).coalesce(1).write.mode(mode).text(path)
        return
    body = F.concat(F.when(F.col("_at") == first, "[\n").otherwise(""), F.regexp_replace("_json", "(?m)^", "  "), F.when(F.col("_at") == last, "\n]").otherwise(","))
    dealt.repartitionByRange("_at").sortWithinPartitions("_at").select(body.alias("value")).write.mode(mode).text(path)


def build_meta(spark: SparkSession, config: dict, mode: str, **counts: DataFrame) -> DataFrame:
    """One row: when and how a build was made (``mode``: by rules or an extractor), and the sizes of its tables."""
    sizes = {name: df.count() for name, df in counts.items()}
    row = spark.range(1).select(F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"))
    row = row.withColumn("mode", F.lit(mode)).withColumn("config", F.struct(*[F.lit(str(v)).alias(k) for k, v in sorted(config.items())]))
    return row.withColumn("counts", F.struct(*[F.lit(n).alias(k) for k, n in sizes.items()]))


def markdown_reports(chunks: DataFrame, entities: DataFrame, relations: DataFrame) -> DataFrame:
    """(doc_id, markdown): a document's entities, triples and size as one report."""
    ids = chunks.select("chunk_idx", "doc_id")
    e = entities.join(ids, "chunk_idx").select("doc_id", "name", "type").distinct().groupBy("doc_id")
    e = e.agg(F.array_join(F.array_sort(F.collect_list(F.concat(F.lit("- "), "name", F.lit(" ("), "type", F.lit(")")))), "\n").alias("e"))
    r = relations.join(ids, "chunk_idx").select("doc_id", "source", "relation", "target").distinct().groupBy("doc_id")
    r = r.agg(F.array_join(F.array_sort(F.collect_list(F.concat(F.lit("- "), "source", F.lit(" -["), "relation", F.lit("]-> "), "target"))), "\n").alias("r"))
    c = chunks.groupBy("doc_id").agg(F.count("*").alias("n"))
    body = F.concat(F.lit("# "), F.col("doc_id").cast("string"), F.lit("\n\n## Entities\n"), F.coalesce("e", F.lit("")), F.lit("\n\n## Triples\n"), F.coalesce("r", F.lit("")), F.lit("\n\n## Chunks\n"), F.col("n").cast("string"))
    return c.join(e, "doc_id", "left").join(r, "doc_id", "left").select("doc_id", body.alias("markdown"))


def save_reports(reports: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The merged report: all reports in order of doc_id, a rule behind each, over as many files as there are ranges of ids; read one after the other by name."""
    reports.repartitionByRange("doc_id").sortWithinPartitions("doc_id").select("markdown").write.mode(mode).option("lineSep", "\n\n---\n\n").text(path)


def listing(chunks: DataFrame) -> DataFrame:
    """(doc_id, listing): a document's chunks in order with their sizes."""
    line = F.concat(F.lit("["), F.col("chunk_idx").cast("string"), F.lit("] "), F.col("tokens").cast("string"), F.lit(" tokens\n"), "content")
    return chunks.withColumn("line", line).groupBy("doc_id").agg(joined("chunk_idx", "line", "\n\n---\n\n").alias("listing"))
