"""Mixing sources to target weights by hash-threshold histograms (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN, cut, shield

#: A document's hash has LEVELS digits of DIGIT_BITS bits.
DIGIT_BITS, LEVELS = 12, 5


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def place(id_col: Column, text: Column) -> Column:
    """60 uniform bits that depend on a document's id and text only."""
    key = F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.md5(text), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, DIGIT_BITS * LEVELS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size, target): share of all sizes split by weight, no target above cap times its source's size.

    The excess is reshared by weight until no target is above: with sources in
    ascending order of size/weight, the first k are capped, where k is the least
    number that leaves a level no further source falls below. One row a source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    t = sizes.withColumn("rank", F.row_number().over(order) - 1).withColumn("w", w)
    fill = Window.orderBy(F.col("source_size") / F.col("w"), "rank")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    t = t.withColumns({
        "room": F.lit(share) * F.sum("source_size").over(everything).cast("double") - F.lit(cap) * F.coalesce(F.sum("source_size").over(before), F.lit(0)).cast("double"),
        "open": F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)),
    }).withColumn("level", F.col("room") / F.col("open"))
    fits = F.col("level") * F.col("w") <= F.lit(cap) * F.col("source_size")
    t = t.withColumn("final", F.min(F.when(fits, F.struct((F.col("source_size") / F.col("w")).alias("o"), "rank", "level"))).over(everything)["level"])
    target = F.least(F.coalesce(F.col("final") * F.col("w"), F.lit(float("inf"))), F.lit(cap) * F.col("source_size"))
    return t.select("source", "source_size", target.alias("target"))


def _boundary(hist: DataFrame) -> DataFrame:
    """Of (source, prefix, n, base, budget): the one bucket of each source whose words pass the budget, with the words before it."""
    run = Window.partitionBy("source").orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)
    h = hist.withColumn("upto", F.col("base") + F.sum("n").over(run)).where("upto > budget")
    least = F.min_by(F.struct("prefix", (F.col("upto") - F.col("n")).alias("base"), "upto"), "prefix")
    return h.groupBy("source", "budget").agg(least.alias("b")).select("source", "budget", "b.prefix", "b.base", "b.upto")


def mix_thresholds(base: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """Of (source, size, place): one row a source with `whole` and `below`. A document is taken `whole` times, and once more if its place is below `below`."""
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share, cap)
    goal = F.floor(F.col("target") + 0.5).cast("long")
    targets = targets.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0).cast("long"))
    targets = cut(targets.withColumn("budget", goal - F.col("whole") * F.col("source_size")), "mix-targets")

    found = targets.select(F.col("source").alias("_s"), "budget", F.lit(0).cast("long").alias("_p"), F.lit(0).cast("long").alias("base"))
    for level in range(1, LEVELS + 1):
        shift = DIGIT_BITS * (LEVELS - level)
        parent = F.shiftright("place", shift + DIGIT_BITS)
        inside = base.join(found, F.col("source").eqNullSafe(F.col("_s")) & (parent == F.col("_p")))
        hist = inside.groupBy("source", "base", "budget", F.shiftright("place", shift).alias("prefix")).agg(F.sum("size").alias("n"))
        last = cut(_boundary(hist), "mix-boundary")
        found = last.select(F.col("source").alias("_s"), "budget", F.col("prefix").alias("_p"), "base")
    # the boundary place itself is taken if that comes nearer to the budget
    over = last.select(F.col("source").alias("_b"), (F.col("prefix") + F.when(F.col("base") + F.col("upto") <= 2 * F.col("budget"), 1).otherwise(0)).alias("below"))
    return targets.join(over, F.col("source").eqNullSafe(F.col("_b")), "left").select(F.col("source").alias("_s"), "source_size", "target", "whole", F.coalesce("below", F.lit(0)).alias("below"))


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    size, spot = word_count(F.col(text_col)).alias("size"), place(F.col(id_col), F.col(text_col)).alias("place")
    return cut(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size, spot), "mix-sizes")


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    cap: float = 2.0,
) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies): how many words the mix takes from each document.

    Every document has a fixed place in [0, 2**60). A source gives all its
    documents floor(target/size) times and those below a threshold place once
    more. The threshold comes from words summed by (source, leading digit): only
    the bucket that holds the boundary is refined by the next digit, so no level
    sorts documents or looks at more than one bucket of a source. The document
    on the boundary is taken if that comes nearer to the target. Thresholds are
    nested: a greater share takes all that a lesser one takes. Reruns agree.

    Null texts have size 0 and are taken 0 times over; null sources are one
    source, last in order; rows equal in id and text share a place and are taken
    together; an empty table gives an empty result; other columns are ignored.
    A source's partial sums merge before the shuffle, so one source may hold any
    part of the rows.
    """
    base = _sized(docs, id_col, text_col, source_col)
    out = base.join(mix_thresholds(base, weights, share, cap), F.col("source").eqNullSafe(F.col("_s")), "left")
    copies = F.col("whole") + F.when(F.col("place") < F.col("below"), 1).otherwise(0)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), copies.alias("copies"))


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The rows of docs, each as many times as mix_sources takes it (0, 1 or more), with docs' own columns.

    Each row meets its source's threshold only; sizes and thresholds are read
    from written tables, never joined by document.
    """
    docs, (id_col, text_col, source_col), back = shield(docs, id_col, text_col, source_col)
    t = mix_thresholds(_sized(docs, id_col, text_col, source_col), **how)
    copies = F.col("whole") + F.when(place(F.col(id_col), F.col(text_col)) < F.col("below"), 1).otherwise(0)
    taken = docs.join(t, F.col(source_col).eqNullSafe(F.col("_s")))
    return back(taken.select(*docs.columns, F.explode(F.array_repeat(F.lit(0), copies.cast("int")))))
