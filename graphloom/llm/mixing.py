"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source asks for ``target / source size`` copies. The whole
part is taken at once; the fractional parts are rounded in pairs: mass moves
between two documents, at random but without bias, until one of them is
integral, and the other goes on. Mass is counted in words, so each source's
taken words equal its target but for one last document. Leaves of about
``FAN`` documents are folded first, their residuals meet ``FAN`` at a time in a
tree. The one residual a source is left with at its root is rounded. As that residual tends to be a large document, what its rounding adds or takes is settled against smaller documents that are
decided already: of ``POOL`` of the source's, chosen by hash, the largest that still fit change sides, and the residual goes to that whole number
that is made up for better.

Defined results: a null text or one without words has size 0 and takes 0 words;
a null source is a source of its own, last in order; rows that agree in
doc_id, source and text are one unit whose copies are dealt evenly over its
rows; an empty table gives an empty result. Columns other than
doc_id, source and text are carried, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import carried, n_words, stage, unpacked

FAN = 64
CAP = 3.0
WEIGHTS = (1.0, 2.0, 3.0)
SEED = 20240517
#: Decided documents of a source that its last rounding may be settled against.
POOL = 512

UNIT = "struct<s:bigint,k:bigint,id:bigint,m:bigint,base:bigint,f:double>"


def source_targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """(source, size) rows -> one row a source: n, source_size, weight, target.

    All targets together are the total size. A target stops at ``cap`` times its
    source's size and what is above goes to the others by weight; that is
    ``least(cap * size, level * weight)`` with one level for all sources, found
    with running sums over the sources in order of cap / weight. One row a
    source reaches the ordering windows, never documents.
    """
    by_source = sized.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    ranked = by_source.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("most", F.lit(float(cap)) * F.col("source_size"))
    order = Window.orderBy(F.col("most") / F.col("weight"), "place")
    before = F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    everything = F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    levelled = ranked.withColumn("level", (everything - before) / rest)
    fits = F.when(F.col("level") * F.col("weight") <= F.col("most") * (1 + 1e-12), F.col("level"))
    level = F.max(fits).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return levelled.withColumn("target", F.least(F.col("most"), level * F.col("weight"))).select(
        "source", "n", "source_size", "weight", F.coalesce("target", F.lit(0.0)).alias("target")
    )


def _fold(level: int) -> str:
    """SQL: folds an array of units; gives the decided ones (x 0 or 1) and the one residual (x null)."""
    # v: the residual a, the next unit u, and how much mass may go up (a gains) or down (a loses)
    moved = f"""
      transform(array(named_struct('a', acc.c, 'u', u,
          'up', least(acc.c.s * (1D - acc.c.f), u.s * u.f), 'down', least(acc.c.s * acc.c.f, u.s * (1D - u.f)),
          'r', shiftrightunsigned(xxhash64(acc.c.k, u.k, {level}, {SEED}), 11) / 9007199254740992D)),
        w -> named_struct('a', w.a, 'u', w.u, 'up', w.up, 'down', w.down,
          'gains', coalesce(w.r < try_divide(w.down, w.up + w.down), false)))[0]"""
    hit = f"""
      transform(array({moved}), v -> named_struct('a', v.a, 'u', v.u, 'gains', v.gains,
          'step', if(v.gains, v.up, v.down),
          'a_ends', if(v.gains, v.a.s * (1D - v.a.f) <= v.u.s * v.u.f, v.a.s * v.a.f <= v.u.s * (1D - v.u.f))))[0]"""
    keep = "if(q.a_ends, q.u, q.a)"
    left = f"least(1D, greatest(0D, {keep}.f + if(q.a_ends = q.gains, -1D, 1D) * q.step / {keep}.s))"
    fields = lambda x, f: f"named_struct('s', {x}.s, 'k', {x}.k, 'id', {x}.id, 'm', {x}.m, 'base', {x}.base, 'f', {f})"
    ended = "if(q.a_ends, q.a, q.u)"
    step = f"""
      transform(array({hit}), q -> named_struct(
          'c', {fields(keep, left)},
          'out', concat(acc.out, array(named_struct('u', {ended}, 'x', if(q.a_ends = q.gains, 1, 0))))))[0]"""
    zero = f"named_struct('c', cast(null as {UNIT}), 'out', cast(array() as array<struct<u:{UNIT},x:int>>))"
    return f"""aggregate(units, {zero},
      (acc, u) -> if(acc.c is null, named_struct('c', u, 'out', acc.out), {step}),
      acc -> concat(acc.out, array(named_struct('u', acc.c, 'x', cast(null as int)))))"""


def round_copies(docs: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """One row for each unit (rows equal in doc_id, source and text): its rows ``m`` and copies ``total``.

    Columns: doc_id, source, k (hash of the unit), size, source_size, target, m, total.
    """
    # words are counted once; what is written holds four numbers a document
    sized = stage(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("doc_id", "source", "text").alias("k")))
    targets = stage(source_targets(sized, weights, cap))
    largest = targets.agg(F.max("n")).first()[0] or 0
    # equal rows are put together before the shuffle, so copies of one row cannot fill one leaf
    units = sized.groupBy("source", "doc_id", "size", "k").agg(F.count("*").alias("m"))
    t = targets.select(F.col("source").alias("t_source"), "n", "source_size", "target")
    units = units.join(t, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
    wanted = F.col("m") * F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(cap)))).otherwise(1.0)
    units = units.withColumn("wanted", wanted).withColumn("base", F.floor("wanted"))
    unit = F.struct(
        F.greatest("size", F.lit(1)).alias("s"), "k", F.col("doc_id").cast("long").alias("id"), "m", "base", (F.col("wanted") - F.col("base")).alias("f")
    )
    keys = ["source", "source_size", "target", "void"]  # documents without words are rounded among themselves
    leaves = F.ceil(F.col("n") / FAN)
    level = units.select("source", "source_size", "target", (F.col("size") == 0).alias("void"), F.pmod(F.xxhash64("k"), leaves).alias("leaf"), unit.alias("unit"))
    decided, spread, depth = [], -(-largest // FAN), 0
    while True:
        folded = level.groupBy(*keys, "leaf").agg(F.sort_array(F.collect_list("unit"), asc=False).alias("units"))
        rows = stage(folded.select(*keys, "leaf", F.explode(F.expr(_fold(depth))).alias("d")).select(*keys, "leaf", "d.u", "d.x"))
        decided.append(rows.where("x is not null"))
        rest = rows.where("x is null")
        if spread <= 1:
            roots = rest.withColumn("x", (F.col("u.f") >= 0.5).cast("int"))
            decided.append(roots)
            break
        level = rest.select(*keys, F.floor(F.col("leaf") / FAN).alias("leaf"), F.col("u").alias("unit"))
        spread, depth = -(-spread // FAN), depth + 1
    out = decided[0]
    for more in decided[1:]:
        out = out.unionByName(more)
    return _settled(out, roots, cap).select(
        F.col("u.id").alias("doc_id"), "source", F.col("u.k").alias("k"), F.when(F.col("void"), 0).otherwise(F.col("u.s")).cast("long").alias("size"),
        "source_size", "target", F.col("u.m").alias("m"), (F.col("u.base") + F.col("x")).alias("total"),
    )


def _settled(decided: DataFrame, roots: DataFrame, cap: float) -> DataFrame:
    """``decided``, where documents of each source change sides to make up for what the rounding at its root adds or takes.

    The root is rounded down or up, whichever can be made up for better.
    """
    ways = F.array(F.struct(F.lit(0).alias("way"), (F.col("u.f") * F.col("u.s")).alias("off")), F.struct(F.lit(1).alias("way"), ((F.col("u.f") - 1) * F.col("u.s")).alias("off")))
    off = roots.where("not void").select(F.col("source").alias("o_source"), F.col("u.k").alias("o_k"), F.col("x").alias("now"), F.inline(ways))
    some = decided.where("not void").join(off, F.col("source").eqNullSafe(F.col("o_source")) & (F.col("u.k") != F.col("o_k")) & (F.col("u.s") <= F.abs("off")))
    more = (F.col("off") > 0) & (F.col("x") == 0) & (F.col("u.base") + 1 <= F.lit(float(cap)) * F.col("u.m"))
    order = Window.partitionBy("o_source", "way").orderBy(F.xxhash64("u.k", F.lit(SEED)), "u.k")
    some = some.where(more | (F.col("off") < 0) & (F.col("x") == 1)).select("o_source", "way", "off", F.struct("u.s", "u.k").alias("c"), F.row_number().over(order).alias("r")).where(F.col("r") <= POOL)
    pools = some.groupBy("o_source", "way").agg(F.first(F.abs("off")).alias("off"), F.sort_array(F.collect_list("c"), asc=False).alias("pool"))
    fits = """aggregate(pool, named_struct('left', off, 'ks', cast(array() as array<bigint>)),
      (acc, c) -> if(c.s <= acc.left, named_struct('left', acc.left - c.s, 'ks', array_append(acc.ks, c.k)), acc))"""
    pools = pools.select(F.col("o_source").alias("p_source"), F.col("way").alias("p_way"), F.expr(fits).alias("p"))
    told = off.join(pools, F.col("o_source").eqNullSafe(F.col("p_source")) & (F.col("way") == F.col("p_way")), "left")
    left = F.coalesce(F.col("p.left"), F.abs("off"))
    best = told.groupBy("o_source").agg(F.min_by(F.struct("way", "now", "o_k", F.coalesce("p.ks", F.array().cast("array<bigint>")).alias("ks")), F.struct(left, F.abs("off"), "way")).alias("b"))
    own = F.when(F.col("b.way") == F.col("b.now"), F.array().cast("array<bigint>")).otherwise(F.array("b.o_k"))
    turned = stage(best.select(F.explode(F.concat("b.ks", own)).alias("t_k")))
    out = decided.withColumn("k", F.col("u.k")).join(turned, F.col("k") == F.col("t_k"), "left")
    return out.withColumn("x", F.when(F.col("t_k").isNull(), F.col("x")).otherwise(1 - F.col("x"))).drop("k", "t_k")


def _dealt(total, m, j):
    """Copies of the j-th (from 1) of m equal rows."""
    return (F.floor(total / m) + (j <= F.pmod(total, m)).cast("long")).cast("long")


def mix_report(docs: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """One row a document: doc_id, size, source_size, target, taken, source, copies."""
    units = round_copies(docs, weights, cap)
    rows = units.withColumn("j", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))))
    rows = rows.withColumn("copies", _dealt(F.col("total"), F.col("m"), F.col("j")))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """The mixture itself: every row of ``docs`` as often as it is taken, with all its columns.

    Of rows that agree in doc_id, source and text, those whose other columns have the smaller hash come first.
    """
    names = [f"`{c}`" for c in docs.columns]
    units = round_copies(docs, weights, cap).select("k", "m", "total")
    keyed = docs.select(F.xxhash64("doc_id", "source", "text").alias("k"), carried(docs).alias("row"), F.xxhash64(*names).alias("tie")).join(units.hint("merge"), "k")
    # equal rows only: their order among themselves changes nothing
    j = F.when(F.col("m") == 1, 1).otherwise(F.row_number().over(Window.partitionBy("k").orderBy("tie")))
    copies = keyed.withColumn("c", _dealt(F.col("total"), F.col("m"), j)).where("c > 0")
    return copies.withColumn("c", F.explode(F.sequence(F.lit(1).cast("long"), F.col("c")))).select(*unpacked(docs))
