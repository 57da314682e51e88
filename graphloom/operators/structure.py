"""Structural parsing: cleaning of broken paragraphs, units under their headings, passages.

Each operator takes rows keyed by ``keys`` with a text column; a text is parsed within its row, as
arrays of its lines and units, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import markers
from ..functions.text import collapse_blocks, strip

MAX_PASSAGE, MIN_PASSAGE = 10_000, 100
SHORT, RUN = 15, 6


def joined(no: Column | str, text: Column | str, sep: str) -> Column:
    """Texts of a group in the order of no."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(no).alias("n") if isinstance(no, str) else no.alias("n"), F.col(text).alias("t") if isinstance(text, str) else text.alias("t"))))
    return F.array_join(F.transform(pairs, lambda p: p["t"]), sep)


def _settled(x: Column) -> Column:
    """x as a generated value: a condition on it is tested on the value; it is not carried below, where all that x is made of would be worked out again for each element."""
    return F.explode(F.array(x))


def _slices(at: str, items: str, f: Callable[[Column, Column, Column], Column]) -> Column:
    """f(where it begins, its length, its number) of each slice of the array column ``items`` that begins at a place (from 0) in the array column ``at``."""
    return F.transform(at, lambda begin, i: f(begin, F.coalesce(F.get(F.col(at), i + 1), F.size(items)) - begin, i))


def _places(items: str, begins: Callable[[Column], Column]) -> Column:
    """The places (from 0) in an array column where ``begins`` holds, and 0."""
    return F.filter(F.sequence(F.lit(0), F.size(items) - 1), lambda i: (i == 0) | begins(i))


def clean_paragraphs(df: DataFrame, keys: Sequence[str], text: str = "content") -> DataFrame:
    """Broken tables become one line each; six or more short paragraphs in a row become one. (keys, text)

    Texts stay in their rows; nothing is shuffled.
    """
    p = df.where(F.col(text).isNotNull()).select(*keys, collapse_blocks(F.split(text, r"\n{2,}", -1)).alias("_p"))
    p = p.withColumn("_s", F.transform("_p", strip)).withColumn("_short", F.transform("_s", lambda x: F.length(x).between(1, SHORT)))
    # a run is one or more short paragraphs, or one that is not short
    p = p.withColumn("_at", _places("_p", lambda i: ~F.get("_short", i) | ~F.get("_short", i - 1)))
    run = lambda begin, n, _: F.when(n >= RUN, F.array_join(F.slice("_s", begin + 1, n), " ")).otherwise(F.array_join(F.slice("_p", begin + 1, n), "\n\n"))
    return p.select(*keys, _settled(F.array_join(_slices("_at", "_p", run), "\n\n")).alias(text))


def headed(df: DataFrame, keys: Sequence[str], text: str = "content", rules: list = markers.RULES, where: Column | None = None) -> DataFrame:
    """Texts (those ``where`` holds; others get null) as arrays of what stands under each heading: (keys, text, u), u of (unit_no, level, marker, content), blank ones included.

    What stands before the first heading has number 0. Texts stay in their rows; nothing is shuffled.
    """
    lines = F.split(text, "\n", -1)
    rows = df.select(*keys, text, (lines if where is None else F.when(where, lines)).alias("_lines"))
    rows = rows.withColumn("_m", F.transform(F.transform("_lines", strip), lambda s: markers.classify_stripped(s, rules)))
    rows = rows.withColumn("_at", _places("_m", lambda i: F.get("_m", i)["level"] != ""))
    before = F.when(F.get("_m", F.lit(0))["level"] == "", 0).otherwise(1)

    def unit(begin, n, i):
        m = F.get("_m", begin)
        return F.struct((i + before).cast("long").alias("unit_no"), m["level"].alias("level"), m["label"].alias("marker"), strip(F.array_join(F.slice("_lines", begin + 1, n), "\n")).alias("content"))

    return rows.select(*keys, text, _settled(_slices("_at", "_lines", unit)).alias("u"))


def _paths(sep: str) -> Callable[[Column, Column], Column]:
    """The headings that hold at each of a text's units, of the units' levels and labels: a heading ends all of lower levels."""
    rank = {level: i for i, level in enumerate(markers.LEVELS)}

    def path(levels: list[str], labels: list[str]) -> list[str]:
        held, out = [], []
        for level, label in zip(levels, labels):
            if level:
                while held and held[-1][0] >= rank[level]:
                    held.pop()
                held.append((rank[level], label))
            out.append(sep.join(x for _, x in held))
        return out

    def run(levels: pa.Array, labels: pa.Array) -> pa.Array:
        # a few texts at a time
        made = [pa.array([x if x is None else path(x, y) for x, y in zip(levels.slice(lo, 256).to_pylist(), labels.slice(lo, 256).to_pylist())], pa.list_(pa.string())) for lo in range(0, len(levels), 256)]
        return pa.concat_arrays(made) if made else pa.array([], pa.list_(pa.string()))

    return F.arrow_udf(run, "array<string>")


def unit_arrays(df: DataFrame, keys: Sequence[str], text: str = "content", rules: list = markers.RULES, sep: str = " > ", where: Column | None = None) -> DataFrame:
    """(keys, text, u): ``units`` of each text as an array of (unit_no, level, marker, content, hierarchy_path)."""
    rows = headed(df, keys, text, rules, where)
    paths = _paths(sep)(F.transform("u", lambda x: x["level"]), F.transform("u", lambda x: x["marker"]))
    both = F.zip_with("u", "_paths", lambda x, path: F.struct(*[x[c].alias(c) for c in ("unit_no", "level", "marker", "content")], path.alias("hierarchy_path")))
    return rows.withColumn("_paths", paths).select(*keys, text, _settled(F.filter(both, lambda x: x["content"] != "")).alias("u"))


def units(df: DataFrame, keys: Sequence[str], text: str = "content", rules: list = markers.RULES, sep: str = " > ") -> DataFrame:
    """Parses headings: (keys, unit_no, level, marker, content, hierarchy_path).

    A heading closes the unit before and clears all lower levels. A level counts in the
    path if it was set after every higher level was last set.
    """
    return unit_arrays(df, keys, text, rules, sep).select(*keys, F.explode("u").alias("u")).select(*keys, "u.*")


def titled_passages(df: DataFrame, keys: Sequence[str], text: str = "content", least: int = 10) -> DataFrame:
    """(keys, passage, context_title, passage_id, content): passages under titles of five levels; short ones drop out."""
    u = units(df, keys, text, markers.TITLES, " - ").where(F.length("content") >= least)
    title = F.when(F.col("hierarchy_path") == "", F.lit("Phần mở đầu")).otherwise(F.col("hierarchy_path"))
    name = F.regexp_replace(F.translate(title, " -", "__"), "[^A-Za-z0-9_À-ỹ]", "")
    return u.select(*keys, F.col("unit_no").alias("passage"), title.alias("context_title"), name.alias("passage_id"), "content")


def unit_texts(df: DataFrame, keys: Sequence[str], text: str = "content") -> DataFrame:
    """(keys, text, texts): an array of parsed units where there are headings, else of paragraphs, else of the text."""
    marked = markers.has_markers(F.col(text))
    legal = F.transform(F.filter("u", lambda x: x["content"] != ""), lambda x: x["content"])
    rows = headed(df, keys, text, where=marked).select(*keys, text, legal.alias("_legal"), F.col("u").isNotNull().alias("_marked"))
    rows = rows.withColumn("_flat", F.when(~F.col("_marked"), F.filter(F.transform(F.split(text, r"\n{2,}", -1), strip), lambda x: x != "")))
    return rows.select(*keys, text, F.when(F.col("_marked"), F.col("_legal")).when(F.size("_flat") > 0, F.col("_flat")).otherwise(F.array(text)).alias("texts"))


#: SQL: group number of each length in an array, packed greedily up to a limit; what is longer stands alone.
def greedy_groups(lengths: str, limit: int) -> str:
    return f"""aggregate({lengths}, named_struct('g', 0, 'sum', 0, 'out', cast(array() as array<int>)),
      (a, n) -> if(n > {limit}, named_struct('g', a.g + if(a.sum > 0, 2, 1), 'sum', 0, 'out', array_append(a.out, a.g + if(a.sum > 0, 1, 0))),
                if(a.sum + n > {limit}, named_struct('g', a.g + 1, 'sum', n, 'out', array_append(a.out, a.g + 1)),
                   named_struct('g', a.g, 'sum', a.sum + n, 'out', array_append(a.out, a.g)))), a -> a.out)"""


def passages(docs: DataFrame, keys: Sequence[str] = ("path",), text: str = "content", most: int = MAX_PASSAGE, least: int = MIN_PASSAGE) -> DataFrame:
    """(keys, passage_no, content): units packed by characters; short passages drop out without a number.

    A document that gives none is one passage itself (number null), if it is long enough.
    """
    rows = unit_texts(docs, keys, text)
    rows = rows.withColumn("_g", F.expr(greedy_groups("transform(texts, x -> length(x))", most)))
    rows = rows.withColumn("_at", F.when(F.size("texts") > 0, _places("_g", lambda i: F.get("_g", i) != F.get("_g", i - 1))))
    rows = rows.withColumn("_kept", F.filter(_slices("_at", "texts", lambda begin, n, _: F.array_join(F.slice("texts", begin + 1, n), "\n\n")), lambda x: F.length(x) >= least))
    passage = lambda no, content: F.struct(no.cast("int").alias("passage_no"), content.alias(text))
    own = F.when(F.size("_kept") > 0, F.transform("_kept", lambda x, i: passage(i + 1, x))).when(F.length(text) >= least, F.array(passage(F.lit(None), F.col(text))))
    return rows.select(*keys, F.explode(own).alias("_x")).select(*keys, "_x.*")
