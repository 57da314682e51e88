"""Spelling variants by asymmetric q-chunks: words one edit apart, and for each word the commoner form it is a variant of.

Of two words one edit apart the longer one (of equally long ones each in its turn) gives two disjoint chunks, its first and its last
half; the edit spoils one of them at most. The other word gives its positional grams of the chunks' length. A chunk that is
not spoilt is a gram at the chunk's own place or, behind a letter that is missing, one place before; other grams
can match no chunk and are not sent. Candidates meet in an equi-join on (length, shift, side, gram) and are verified
by edit distance.

A gram shared by more than ``HOT`` chunks is hot. Its words are dealt further by the same scheme, applied to what the chunk leaves
of each word: the edit lies there, so one half of that rest must agree, too. No group of words is so compared pair by pair
because of one frequent ending.

Defined results: a null text has no words; a null doc_id is written as nothing in the key of the damage; rows that are
repeated count each time; an empty table gives no words; of near words equal in count the one smallest in code-point order is the form.
Only ``doc_id`` and ``text`` are read, so other columns and their names do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import spread_join, stage

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words have this many code points and occurrences at least; a form has RATIO times the count of its variant.
SHORTEST, LEAST, RATIO = 5, 3, 2
#: Chunks of a key that are not dealt further.
HOT = 256


def damaged_words(docs: DataFrame, every: int = 97) -> DataFrame:
    """(word): the runs of letters of whole texts, A-Z lower-cased; from those whose checksum with the doc_id ``every`` divides one letter is deleted."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"), F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.select("d", F.translate("run", UPPER, LOWER).alias("w"))
    runs = runs.withColumn("h", F.crc32(F.concat("d", F.lit(":"), "w")))
    at = (F.col("h") % F.length("w")).cast("int")
    cut = F.concat(F.substring("w", F.lit(1), at), F.substring("w", at + 2, F.length("w")))
    return runs.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("w")).alias("word"))


def counted(words: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """(word, n) of words long and frequent enough."""
    return words.where(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def _halves(text: Column, q: Column) -> list[Column]:
    """The first and the last q letters, each with what it leaves."""
    size = F.length(text)
    return [
        F.struct(F.lit(0).alias("side"), F.substring(text, F.lit(1), q).alias("gram"), F.substring(text, q + 1, size).alias("rest")),
        F.struct(F.lit(1).alias("side"), F.substring(text, size - q + 1, q).alias("gram"), F.substring(text, F.lit(1), size - q).alias("rest")),
    ]


def _sent(rows: DataFrame, text: str, shifts: Column, names: tuple[str, str, str]) -> DataFrame:
    """rows for each shift (letters the partner lacks, or is short of) and each half of ``text``; ``size`` is the chunk word's length."""
    rows = rows.withColumn("shift", F.explode(shifts)) if shifts is not None else rows
    grown = F.length(text) + F.when(F.col("grams"), F.col("shift")).otherwise(0)
    q = F.floor(grown / 2).cast("int")
    out = rows.withColumn("_size", grown).withColumn("_half", F.explode(F.array(*_halves(F.col(text), q))))
    side, gram, rest = names
    return out.withColumns({side: F.col("_half.side"), gram: F.col("_half.gram"), rest: F.col("_half.rest")}).drop("_half")


def near_pairs(words: DataFrame, hot: int = HOT) -> DataFrame:
    """(a, n_a, b, n_b): each two words of (word, n) that differ by one inserted, deleted or replaced code point, once; a is the longer or smaller one."""
    shifts = F.array(F.lit(0), F.lit(1))
    key = ["size", "shift", "side", "gram"]
    dealt = [_sent(words.withColumn("grams", F.lit(g)), "word", shifts, ("side", "gram", "rest")).withColumnRenamed("_size", "size") for g in (False, True)]
    chunks, grams = (stage(x) for x in dealt)
    crowd = stage(chunks.groupBy(*key).agg(F.count("*").alias("chunks")).where(F.col("chunks") > hot))
    found = []
    for over, how in ((False, "left_anti"), (True, "left_semi")):
        c, g = (x.join(crowd, key, how) for x in (chunks, grams))
        on = list(key)
        if over:
            c, g = (_sent(x, "rest", None, ("side2", "gram2", "rest2")).drop("_size", "rest2") for x in (c, g))
            on += ["side2", "gram2"]
        c = c.select(*on, F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("rest").alias("rest_a"))
        g = g.select(*on, F.col("word").alias("b"), F.col("n").alias("n_b"), F.col("rest").alias("rest_b"))
        pairs = c.join(g, on).where((F.col("shift") == 1) | (F.col("a") < F.col("b"))).where(_first("a", "b", "side"))
        pairs = pairs.where(_first("rest_a", "rest_b", "side2")) if over else pairs
        found.append(pairs.where(F.levenshtein("a", "b", 1) == 1).select("a", "n_a", "b", "n_b"))
    return found[0].unionByName(found[1])


def _first(a: str, b: str, side: str) -> Column:
    """Both halves of a pair may agree; it is taken by the first one that does."""
    q = F.floor(F.length(a) / 2).cast("int")
    return (F.col(side) == 0) | (F.substring(a, F.lit(1), q) != F.substring(b, F.lit(1), q))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last, twice as far in each round; a form's count is above its word's, so there are no rings."""
    now = stage(forms.select("word", F.col("form").alias("at"), F.lit(False).alias("done")))
    while not now.where("not done").isEmpty():
        on = now.select(F.col("word").alias("at"), F.col("at").alias("next"), F.col("done").alias("ends"))
        met = stage(now.groupBy("at").agg(F.count("*").alias("n")).join(on, "at", "left"))
        now = stage(
            spread_join(now, met, ["at"]).select("word", F.when(F.col("done"), F.col("at")).otherwise(F.coalesce("next", "at")).alias("at"), (F.col("done") | F.col("next").isNull() | F.col("ends")).alias("done"))
        )
    return now.select("word", F.col("at").alias("root"))


def variants(words: DataFrame, ratio: float = RATIO, hot: int = HOT) -> DataFrame:
    """word, form, root, n, n_near, form_n of (word, n): a word's form is its commonest near word, if that has ``ratio`` times its count; root is the last form."""
    words = stage(words)
    pairs = stage(near_pairs(words, hot))
    ends = F.array(*(F.struct(F.col(x).alias("word"), F.col(y).alias("other"), F.col(f"n_{y}").alias("other_n")) for x, y in (("a", "b"), ("b", "a"))))
    near = pairs.select(F.inline(ends)).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), "other")).alias("best"))
    rows = words.join(near, "word", "left")
    is_form = -F.col("best.m") >= ratio * F.col("n")
    rows = stage(
        rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best.other")).alias("form"), F.when(is_form, -F.col("best.m")).alias("form_n"))
    )
    rooted = rows.join(_roots(rows.where("form is not null")), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
