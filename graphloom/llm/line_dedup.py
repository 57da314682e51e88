"""Line dedup by content-defined chunks of lines.

A rolling hash over the hashes of two neighbouring lines ends a chunk where it
is divisible by ``DIVISOR``, so an inserted line moves only the chunk it is in.
A chunk of several lines that also occurs elsewhere stays where it comes
first (by doc_id, then text hash, then position) and is removed from every other
place. Hashes find the repeats, and the bytes behind them are compared before anything goes.

Defined results: null and empty texts stay as they are; a chunk of one line or
without a visible character is never removed; rows with a null doc_id come
last in order; rows equal in doc_id and text are treated alike, so they keep
what the first of them keeps; an empty table stays empty; other columns are carried, whatever their
names, but for one called ``_removed_lines``, which the result replaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import carried, spread_join, stage, unpacked

DIVISOR = 4


def line_hash(line: Column) -> Column:
    """32 bits of the line's MD5."""
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def chunks_of(text: Column, divisor: int = DIVISOR) -> Column:
    """The text's chunks, an array of strings that give the text again when joined by newlines.

    Every line gets a mark in front, b where a chunk begins and c elsewhere; as each
    line has one, a newline with b can be nothing but a chunk's begin.
    """
    lines = F.split(text, "\n", -1)
    hashes = F.transform(lines, line_hash)
    before = F.concat(F.array(F.lit(-1).cast("long")), hashes)
    before2 = F.concat(F.array(F.lit(0).cast("long"), F.lit(0).cast("long")), hashes)
    rows = F.arrays_zip(lines.alias("l"), before.alias("p1"), before2.alias("p2"))
    begins = lambda r: (r["p1"] == -1) | (F.pmod(r["p2"] * 31 + r["p1"], F.lit(divisor)) == 0)
    marked = F.transform(F.filter(rows, lambda r: r["l"].isNotNull()), lambda r: F.concat(F.when(begins(r), "b").otherwise("c"), r["l"]))
    parts = F.split(F.concat(F.lit("\n"), F.array_join(marked, "\n")), "\nb", -1)
    parts = F.filter(parts, lambda _, i: i > 0)  # what stands before the first mark
    return F.transform(parts, lambda p: F.replace(p, F.lit("\nc"), F.lit("\n")))


def n_lines(chunk: Column) -> Column:
    return F.length(chunk) - F.length(F.replace(chunk, F.lit("\n"), F.lit(""))) + 1


def chunk_hash(body: Column) -> Column:
    return F.xxhash64(body)


def _on_key(keyed: DataFrame, more: DataFrame, how: str) -> DataFrame:
    """Joins more, keyed by (d, t), to documents keyed by (doc_id, th)."""
    return keyed.join(more.hint("merge"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")), how).drop("d", "t")


def repeated_chunks(docs: DataFrame, divisor: int = DIVISOR) -> DataFrame:
    """(d, t, gone): doc_id, hash of the text, and the numbers of the chunks to remove from it.

    Places of chunks, without texts, find the repeated hashes; the bytes behind these are then
    grouped. Should a hash stand for different bytes, each of these keeps its own first place.
    """
    solid = lambda body: (n_lines(body) > 1) & body.rlike(r"[^\s]")
    keyed = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "th", "no")
    rows = keyed.where(F.col("text").contains("\n")).select("doc_id", "th", F.posexplode(chunks_of(F.col("text"), divisor)).alias("no", "body"))
    rows = stage(rows.where(solid(F.col("body"))).select("doc_id", "th", "no", chunk_hash(F.col("body")).alias("h")))
    # added up before the shuffle, so a frequent chunk is one row a task
    known = rows.groupBy("h").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.count("*").alias("n")).where(F.col("first") != F.col("last"))
    again = spread_join(rows, stage(known.select("h", "first", "n")), ["h"])
    again = stage(again.select("h", "doc_id", "th", "no", (place != F.col("first")).alias("late")))
    marks = again.groupBy(F.col("doc_id").alias("d"), F.col("th").alias("t")).agg(F.collect_set(F.struct("no", "h")).alias("marks"))
    bodies = _on_key(keyed, marks, "inner").select("doc_id", "th", "marks", F.posexplode(chunks_of(F.col("text"), divisor)).alias("no", "body"))
    bodies = bodies.withColumn("mark", F.filter("marks", lambda m: m["no"] == F.col("no"))).where(F.size("mark") > 0).withColumn("h", F.col("mark")[0]["h"])
    unlike = stage(bodies.groupBy("h", "body").agg(F.lit(1).alias("one")).groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"))
    lost = again.where("late").select("h", "doc_id", "th", "no")
    if not unlike.isEmpty():
        own = stage(bodies.join(unlike, "h", "left_semi").select("h", "doc_id", "th", "no", "body"))
        firsts = own.groupBy("h", "body").agg(F.min(place).alias("first"))
        late = own.join(firsts, ["h", "body"]).where(place != F.col("first")).select("h", "doc_id", "th", "no")
        lost = lost.join(unlike, "h", "left_anti").union(late.withColumn("h", F.col("h") + 0))
    return lost.groupBy(F.col("doc_id").alias("d"), F.col("th").alias("t")).agg(F.collect_set("no").alias("gone"))


def dedup_lines(docs: DataFrame, divisor: int = DIVISOR) -> DataFrame:
    """``docs`` with repeated chunks removed from ``text``, and ``_removed_lines``: how many lines went."""
    docs = docs.drop("_removed_lines")
    keyed = docs.select("doc_id", F.xxhash64("text").alias("th"), "text", carried(docs.drop("text")).alias("row"))
    joined = _on_key(keyed, repeated_chunks(docs, divisor), "left")
    parts, never = chunks_of(F.col("text"), divisor), F.col("gone").isNull()
    kept = F.filter(parts, lambda _, i: ~F.array_contains(F.col("gone"), i))
    text = F.when(never, F.col("text")).otherwise(F.array_join(kept, "\n"))
    lines = F.aggregate(F.filter(parts, lambda _, i: F.array_contains(F.col("gone"), i)), F.lit(0), lambda a, p: a + n_lines(p))
    removed = F.when(never, 0).otherwise(lines).cast("long")
    done = joined.select("row", text.alias("kept"), removed.alias("removed"))
    columns = dict(zip(docs.drop("text").columns, unpacked(docs.drop("text")), strict=True))
    return done.select(*[columns.get(c, F.col("kept").alias(c)) for c in docs.columns], F.col("removed").alias("_removed_lines"))
