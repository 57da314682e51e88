"""Token-budgeted chunks.

Packing is sequential inside a passage (about 10,000 characters), so it runs in Arrow
batches of whole passages; everything around it (cleaning, parsing, ids) is DataFrame work.
The token counter is any function of a string; words by default.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import markers, text as T
from ..functions.lineage import cut
from . import structure

MIN, TARGET, MAX, TAIL = 800, 1000, 1200, 400
MIN_CHARS, LEGAL_CHARS = 120, 30

Counter = Callable[[str], int]

# fixed values: the four ways to cut a text into sentences, tried in this order
SENTENCES = [
    re.compile(r"(?=(?:^|\n)\s*(?:\d+(?:\.\d+)*[.\-)]\s|[a-zđ][.)]\s|[IVXLC]+[.)]\s|Điều\s+\d+|Khoản\s+\d+|Mục\s+[IVXLC\d]))", re.M),
    re.compile(r"\n{2,}"),
    re.compile(r"(?<=[.;:])\s*\n|\s{2,}"),
    re.compile(r"(?<=[.;])\s+(?=[A-ZÀ-ỸĐ\-])"),
]


def count_words(s: str) -> int:
    return len(s.split())


def sentences(s: str) -> list[str]:
    """The first way that gives two or more parts that are not blank; else the text."""
    for way in SENTENCES:
        parts = [p for p in way.split(s) if p and p.strip()]
        if len(parts) > 1:
            return [p.strip() for p in parts] if way is SENTENCES[1] else parts
    return [s]


def paragraphs(s: str) -> list[str]:
    return [p.strip() for p in re.split(r"\n{2,}", s) if p.strip()]


def _greedy(items: Sequence[str], cost: Callable[[str], int], limit: int, sep: str, extra: int = 0) -> list[str]:
    """Joins neighbours while their costs (and ``extra`` for each but one that opens after an overflow) stay within the limit."""
    groups: list[list[str]] = []
    used = 0
    for item in items:
        c = cost(item)
        if groups and used + c + extra <= limit:
            groups[-1].append(item)
            used += c + extra
        elif not groups and c + extra <= limit:
            groups.append([item])
            used = c + extra
        else:
            groups.append([item])
            used = c
    return [sep.join(g) for g in groups]


def pack_text(s: str, count: Counter, limit: int, most: int = MAX) -> list[str]:
    """A text in pieces of at most ``limit`` tokens, cut at paragraphs, else sentences, else words; whole if it has at most ``most``."""
    if count(s) <= most:
        return [s]
    parts = paragraphs(s)
    if len(parts) < 2:
        parts = sentences(s)
    fine = [x for p in parts for x in ([p] if count(p) <= most else _greedy(p.split(), count, most, " ", 1))]
    return _greedy(fine, count, limit, "\n\n")


def split_at(s: str, count: Counter, n: int) -> tuple[str, str]:
    """A first part of at most n tokens and the rest, cut between sentences or else words."""
    if count(s) <= n:
        return s, ""
    for parts, sep, extra in ((sentences(s), "\n", 0), (s.split(), " ", 1)):
        used = taken = 0
        for p in parts:
            used += count(p) + extra
            if used > n:
                break
            taken += 1
        if len(parts) > 1 and taken or extra:
            return sep.join(parts[:taken]), sep.join(parts[taken:])
    raise AssertionError


#: A part of a block: its text, the unit it is of, its tokens.
Part = tuple[str, dict, int]


def _block(parts: Sequence[Part]) -> dict:
    """The parts of one block as a row."""
    (_, first, _), (_, last, _) = parts[0], parts[-1]
    paths = dict.fromkeys(u["hierarchy_path"] for _, u, _ in parts if u["hierarchy_path"])
    return {
        "content": "\n\n".join(p[0] for p in parts), "start_marker": first["marker"], "end_marker": last["marker"],
        "start_level": first["level"], "end_level": last["level"], "hierarchy_path": " | ".join(paths), "tokens": sum(p[2] for p in parts),
    }


def _placed(held: list[Part], unit: dict, count: Counter, least: int, target: int, most: int) -> list[list[Part]]:
    """What one more unit makes of the open block: closed blocks, and at last the new open one.

    The unit falls into shares, each with whether a block ends behind it; an open block takes the first share.
    """
    text, n, size = unit["content"], count(unit["content"]), sum(p[2] for p in held)
    if n > most:  # a unit beyond all budgets stands in blocks of its own
        shares = [("", True), *((piece, True) for piece in pack_text(text, count, target, most))]
    elif size + n <= most:
        shares = [(text, False)]
    else:
        # a block that is full enough takes nothing; a small one is filled up to its target, or to the limit if little is missing
        room = 0 if size >= least else target - size if target - size >= 50 else most - size
        head, rest = split_at(text, count, room) if room else ("", text)
        shares = [(head, True), (rest, False)]
    out = [list(held)]
    for share, ends in shares:
        if share.strip():
            out[-1].append((share, unit, n if share is text else count(share)))
        if ends:
            out.append([])
    return out


def blocks(units: Sequence[dict], count: Counter, least: int = MIN, target: int = TARGET, most: int = MAX, tail: int = TAIL) -> list[dict]:
    """Units gathered in order into blocks near the budget, as one fold over them; a small last block goes with the one before."""
    made: list[list[Part]] = [[]]
    for unit in units:
        made[-1:] = _placed(made[-1], unit, count, least, target, most)
    out = [_block(parts) for parts in made if parts]
    if len(out) > 1 and out[-1]["tokens"] < tail:
        end = out.pop()
        out[-1] |= {"content": f"{out[-1]['content']}\n\n{end['content']}", "end_marker": end["end_marker"], "end_level": end["end_level"], "tokens": out[-1]["tokens"] + end["tokens"]}
    return out


BLOCK = "struct<content:string,start_marker:string,end_marker:string,start_level:string,end_level:string,hierarchy_path:string,tokens:int>"
_BLOCK = pa.struct([(c, pa.string()) for c in ("content", "start_marker", "end_marker", "start_level", "end_level", "hierarchy_path")] + [("tokens", pa.int32())])


#: Rows whose texts a task holds in Python at once.
ROWS = 256


def _with(df: DataFrame, column: str, kind: str, arrow: pa.DataType, of: str, f: Callable) -> DataFrame:
    """df with column = f(of), an array, computed a few rows of a batch at a time."""
    def run(batches):
        for b in (b.slice(lo, ROWS) for b in batches for lo in range(0, b.num_rows, ROWS)):
            yield pa.record_batch([*b.columns, pa.array([f(x) for x in b.column(of).to_pylist()], pa.list_(arrow))], names=[*b.schema.names, column])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema.fields)
    return df.mapInArrow(run, f"{fields}`{column}` array<{kind}>")


def _counted(count: Counter):
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda s: count(s or ""))

    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return run


def flat_chunks(df: DataFrame, text: str = "content", count: Counter = count_words, most: int = MAX) -> DataFrame:
    """df with ``pieces``: its text packed to at most ``most`` tokens."""
    return _with(df, "pieces", "string", pa.string(), text, lambda s: pack_text(s or "", count, most, most))


def sentence_parts(df: DataFrame, text: str = "content") -> DataFrame:
    """df with ``parts``: its text in sentences, as ``sentences`` cuts it."""
    return _with(df, "parts", "string", pa.string(), text, lambda s: sentences(s or ""))


def oversized_pieces(df: DataFrame, text: str = "content", count: Counter = count_words, target: int = TARGET, most: int = MAX) -> DataFrame:
    """df with ``pieces``: a unit above ``most`` tokens in pieces of about ``target``."""
    return _with(df, "pieces", "string", pa.string(), text, lambda s: pack_text(s or "", count, target, most))


def token_blocks(units: DataFrame, keys: Sequence[str], count: Counter = count_words, least: int = MIN, target: int = TARGET, most: int = MAX, tail: int = TAIL) -> DataFrame:
    """(keys, block_no, block fields) of parsed units."""
    unit = F.struct("unit_no", "level", "marker", "content", "hierarchy_path")
    rows = units.groupBy(*keys).agg(F.array_sort(F.collect_list(unit)).alias("u"))
    return array_blocks(rows, keys, count, least, target, most, tail)


def array_blocks(rows: DataFrame, keys: Sequence[str], count: Counter = count_words, least: int = MIN, target: int = TARGET, most: int = MAX, tail: int = TAIL) -> DataFrame:
    """token_blocks of (keys, u), an array of a text's units."""
    packed = _with(rows.select(*keys, "u"), "b", BLOCK, _BLOCK, "u", lambda u: blocks(u, count, least, target, most, tail)).drop("u")
    return packed.select(*keys, F.posexplode("b").alias("block_no", "b")).select(*keys, "block_no", "b.*")


def _taken(events: list[dict]) -> dict:
    """One base's rows (i) and the first rows of bases named base_j (j), in order, for a base whose own name is free (0) or not (1).

    lost: the j whose name a row of this base took first. steps: the i from which numbers lie one higher.
    """
    out = {}
    for begin in (0, 1):
        free, held, lost, steps = begin, set(), [], []
        for e in events:
            if e["j"] is None:
                at = free
                while at in held:
                    at += 1
                steps += [e["i"]] * (at - free)
                free = at + 1
            elif e["j"] < free:
                lost.append(e["j"])
            else:
                held.add(e["j"])
        out |= {f"lost{begin}": lost, f"steps{begin}": steps}
    return out


_TAKEN = ("lost0", "steps0", "lost1", "steps1")


def unique_ids(df: DataFrame, base: str, *order: str) -> DataFrame:
    """df with ``id``: base, or else base_1, base_2, ..., the first that no row before it has, as a loop over the rows in order gives them.

    A made id base_j can only meet the base of that very name, so a base is settled with the first rows of
    such bases alone, once for each state of its own name; which of both holds comes down from
    the base it may be made of, in as many rounds as names are nested.
    """
    df = cut(df.withColumn("_n", (F.row_number().over(Window.partitionBy(base).orderBy(*order)) - 1).cast("long")))
    at, made = F.struct(*order).alias("at"), r"(?s)^(.*)_([1-9]\d{0,17})$"
    firsts = df.where("_n = 0").select(F.col(base).alias("_base"), at)
    inner = firsts.where(F.col("_base").rlike(made)).select(F.regexp_extract("_base", made, 1).alias("_of"), F.regexp_extract("_base", made, 2).cast("long").alias("j"), "_base", "at")
    inner = cut(inner.join(firsts.select(F.col("_base").alias("_of")), "_of", "left_semi"))
    number = lambda n: F.when(n == 0, F.col(base)).otherwise(F.concat_ws("_", base, n.cast("string")))
    if inner.isEmpty():
        return df.withColumn("id", number(F.col("_n"))).drop("_n")
    none = F.lit(None).cast("long")
    most = inner.groupBy("_of").agg(F.max("j").alias("_most"))
    rows = df.select(F.col(base).alias("_of"), at, "_n").join(most, "_of").where("_n <= _most").select("_of", F.struct("at", none.alias("j"), F.col("_n").alias("i")).alias("e"))
    names = inner.select("_of", F.struct("at", "j", none.alias("i")).alias("e"))
    # the key is written as a new expression in both parts, as in hybrid.fuse
    every = [x.select(F.concat("_of", F.lit("")).alias("_of"), "e") for x in (rows, names)]
    events = every[0].unionByName(every[1]).groupBy("_of").agg(F.transform(F.array_sort(F.collect_list("e")), lambda e: F.struct(e["j"].alias("j"), e["i"].alias("i"))).alias("e"))
    kind = ",".join(f"{c}:array<bigint>" for c in _TAKEN)
    taken = _with(events, "t", f"struct<{kind}>", pa.struct([(c, pa.list_(pa.int64())) for c in _TAKEN]), "e", lambda e: [_taken(e)])
    taken = cut(taken.select("_of", F.col("t")[0].alias("t")))
    lost = [F.array_contains(F.col(f"t.lost{x}"), F.col("j")) for x in (0, 1)]
    nested = inner.join(taken, "_of").select("_base", "_of", lost[0].alias("_a"), lost[1].alias("_b")).withColumn("_s", F.when(F.col("_a") == F.col("_b"), F.col("_a")))
    while True:
        above = nested.select(F.col("_base").alias("_of"), F.col("_s").alias("_up"), F.lit(True).alias("_in"))
        known = F.when(F.col("_in").isNull(), F.col("_a")).when(F.col("_up"), F.col("_b")).when(~F.col("_up"), F.col("_a"))
        nested = cut(nested.join(above, "_of", "left").select("_base", "_of", "_a", "_b", F.coalesce("_s", known).alias("_s")))
        if nested.where("_s is null").isEmpty():
            break
    out = df.join(nested.select(F.col("_base").alias(base), "_s"), base, "left").join(taken.withColumnRenamed("_of", base), base, "left")
    begin = F.coalesce(F.col("_s"), F.lit(False))
    steps = F.coalesce(F.when(begin, F.col("t.steps1")).otherwise(F.col("t.steps0")), F.array().cast("array<bigint>"))
    n = F.col("_n") + begin.cast("long") + F.size(F.filter(steps, lambda i: i <= F.col("_n")))
    return out.withColumn("id", number(n)).drop("_n", "_s", "t").select(*[c for c in df.columns if c != "_n"], "id")


def build_chunks(
    passages: DataFrame, count: Counter = count_words, least: int = MIN, target: int = TARGET, most: int = MAX, tail: int = TAIL, min_chars: int = MIN_CHARS
) -> DataFrame:
    """Passages (doc_id, path, passage_no, content, doc_number) to chunks with ids, levels and markers.

    Parsed passages go through units and blocks, others through the flat packer; short chunks
    drop out and leave gaps in chunk_index, which starts anew in each passage.
    """
    keys = ["doc_id", "path", "passage_no", "doc_number"]
    p = passages.withColumn("passage_no", F.coalesce("passage_no", F.lit(0)))
    clean = cut(structure.clean_paragraphs(p.where(F.length(T.strip("content")) > 0), keys).where(F.length(T.strip("content")) > 0))
    legal = array_blocks(structure.unit_arrays(clean.where(markers.has_markers(F.col("content"))), keys).where(F.size("u") > 0), keys, count, least, target, most, tail)
    legal = legal.withColumn("content", T.normalize_text(F.col("content"))).where(F.length("content") >= LEGAL_CHARS)
    legal = legal.select(*keys, F.col("block_no").alias("chunk_index"), "content", "start_marker", "end_marker", F.coalesce(F.nullif("start_level", F.lit("")), F.lit("preamble")).alias("semantic_level"), "hierarchy_path")
    flat = flat_chunks(clean.where(~markers.has_markers(F.col("content"))), count=count, most=most)
    flat = flat.select(*keys, F.size("pieces").alias("n"), F.posexplode("pieces").alias("chunk_index", "content")).withColumn("content", T.normalize_text(F.col("content")))
    flat = flat.where((F.length("content") >= min_chars) | (F.col("n") == 1) & (F.length("content") >= LEGAL_CHARS))
    empty = F.lit("")
    flat = flat.select(*keys, "chunk_index", "content", empty.alias("start_marker"), empty.alias("end_marker"), F.lit("paragraph").alias("semantic_level"), F.lit("Văn bản").alias("hierarchy_path"))
    start = F.when(F.col("semantic_level") == "paragraph", F.format_string("para_%d", "chunk_index")).otherwise(F.col("start_marker"))
    chunks = legal.unionByName(flat).withColumn("base_id", T.range_id(F.col("doc_number"), start, F.col("end_marker")))
    order = ["path", "passage_no", "chunk_index"]
    chunks = unique_ids(chunks, "base_id", *order).drop("base_id")
    tokens = T.n_tokens(F.col("content")) if count is count_words else F.pandas_udf(_counted(count), "int")("content")
    # counted last, as dealing by ranges works its rows out twice
    return number(chunks, *order).select(*chunks.columns, tokens.alias("tokens"), "chunk_idx")


def number(chunks: DataFrame, *order: str) -> DataFrame:
    """chunks with ``chunk_idx``, 0-based over all in the order given, which must be total.

    Rows are dealt by ranges of the order and numbered within each; a row for each range, with its count, is all that
    meets in one window, and what is broadcast.
    """
    dealt = chunks.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order]).sortWithinPartitions(*order)
    dealt = cut(dealt.withColumn("_range", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    counts = dealt.groupBy("_range").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_range", before.alias("_offset"))
    return dealt.join(F.broadcast(offsets), "_range").withColumn("chunk_idx", F.col("_offset") + F.col("_place")).drop("_range", "_place", "_offset")
