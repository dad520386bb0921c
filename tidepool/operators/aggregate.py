"""Aggregation operators (group E): grouped counts, shares, binning, surfaces.

All are single-pass ``groupBy`` plans with map-side partial aggregation;
the only broadcasts are of one-row scalar frames (min/max) or fixed class /
bin dimensions whose size is set by a parameter, never by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions import columns as C
from tidepool.operators import ordered as O


def pct1(n: Column, total: Column) -> Column:
    """100 * n / total rounded half-up to one decimal, in exact integer arithmetic."""
    return F.floor((F.lit(2000) * n + total) / (F.lit(2) * total)) / 10.0


def class_dim(spark: SparkSession, classes: list[str], name: str = "class") -> DataFrame:
    return F.broadcast(spark.createDataFrame(list(enumerate(classes)), f"class_order int, {name} string"))


def complete_domain(
    spark: SparkSession, counts: DataFrame, key: str, classes: list[str], fill_cols: list[str]
) -> DataFrame:
    """Left join from a fixed ordered list; missing -> 0."""
    dim = class_dim(spark, classes, key)
    return dim.join(counts, key, "left").na.fill(0, subset=fill_cols)


def class_counts(spark: SparkSession, df: DataFrame, label: str, classes: list[str]) -> DataFrame:
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return complete_domain(spark, counts, label, classes, ["n"])


def class_shares(spark: SparkSession, df: DataFrame, label: str, classes: list[str]) -> DataFrame:
    counts = class_counts(spark, df, label, classes)
    total = df.agg(F.count(F.lit(1)).alias("total"))
    return counts.crossJoin(F.broadcast(total)).withColumn("pct", pct1(F.col("n"), F.col("total")))


def contingency(df: DataFrame, row: str, col: str, values: list[str]) -> DataFrame:
    """row x col count matrix with a fixed column domain, zeros kept."""
    return df.groupBy(row).pivot(col, values).agg(F.count(F.lit(1))).na.fill(0, subset=values)


def region_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("region").agg(
        F.count("reef_health").alias("observations"),
        pct1(F.sum((F.col("reef_health") == "healthy").cast("long")), F.count("reef_health")).alias("healthy_pct"),
        pct1(
            F.sum((F.col("restoration_suitability") == "suitable").cast("long")), F.count("restoration_suitability")
        ).alias("suitable_pct"),
    )


def group_means(df: DataFrame, key: str, cols: list[str], digits: int = 3) -> DataFrame:
    return df.groupBy(key).agg(*[F.round(F.avg(c), digits).alias(c) for c in cols])


def min_max(df: DataFrame, c: str) -> DataFrame:
    """One-row frame of min/max (safe to broadcast: exactly one row)."""
    return F.broadcast(df.agg(F.min(c).alias(f"{c}__lo"), F.max(c).alias(f"{c}__hi")))


def cut_right_closed(x: Column, lo: Column, hi: Column, bins: int) -> tuple[Column, Column]:
    """``pd.cut(bins=N)``: equal bins over [min, max], right-closed, first edge
    lowered by 0.1 % of the range. Returns (bin index, interval midpoint rounded 1).
    A constant column gets a range of 0.1 % of its value (0.001 for 0) to either side."""
    room = F.when(hi > lo, 0.0).when(lo == 0, 0.001).otherwise(F.abs(lo) * 0.001)
    lo, hi, lowered = lo - room, hi + room, F.when(hi > lo, (hi - lo) * 0.001).otherwise(0.0)
    w = (hi - lo) / bins
    idx = F.greatest(F.lit(0), F.ceil((x - lo) / w) - 1).cast("int")
    idx = F.least(F.lit(bins - 1), idx)
    left = F.when(idx == 0, lo - lowered).otherwise(lo + idx * w)
    right = lo + (idx + 1) * w
    return idx, F.round((left + right) / 2, 1)


def binned_surface(
    spark: SparkSession,
    df: DataFrame,
    xcol: str,
    xbins: int,
    ycol: str,
    ybins: int,
    value: Column,
    out: str,
    min_n: int = 5,
) -> DataFrame:
    """Two right-closed cuts -> mean of ``value`` and count per cell; every
    cell of the N x M grid is returned; cells with n < min_n get a null mean."""
    rng = F.broadcast(
        df.agg(
            F.min(xcol).alias("xlo"), F.max(xcol).alias("xhi"), F.min(ycol).alias("ylo"), F.max(ycol).alias("yhi")
        )
    )
    xi, _ = cut_right_closed(F.col(xcol), F.col("xlo"), F.col("xhi"), xbins)
    yi, _ = cut_right_closed(F.col(ycol), F.col("ylo"), F.col("yhi"), ybins)
    cells = (
        df.crossJoin(rng)
        .select(xi.alias("x_bin"), yi.alias("y_bin"), value.alias("_v"))
        .groupBy("x_bin", "y_bin")
        .agg(F.count("_v").alias("n"), F.avg("_v").alias("_mean"))
    )
    # complete grid: fixed-size axes (N x M rows, set by the parameters)
    axes = (
        spark.range(xbins)
        .select(F.col("id").cast("int").alias("x_bin"))
        .crossJoin(spark.range(ybins).select(F.col("id").cast("int").alias("y_bin")))
        .crossJoin(rng)
    )
    xw = (F.col("xhi") - F.col("xlo")) / xbins
    yw = (F.col("yhi") - F.col("ylo")) / ybins

    def mid(i, lo, hi, w):
        left = F.when(i == 0, lo - (hi - lo) * 0.001).otherwise(lo + i * w)
        return F.round((left + lo + (i + 1) * w) / 2, 1)

    grid = axes.select(
        "x_bin",
        "y_bin",
        mid(F.col("x_bin"), F.col("xlo"), F.col("xhi"), xw).alias("x_mid"),
        mid(F.col("y_bin"), F.col("ylo"), F.col("yhi"), yw).alias("y_mid"),
    )
    res = grid.join(F.broadcast(cells), ["x_bin", "y_bin"], "left").na.fill(0, subset=["n"])
    return res.withColumn(out, F.when(F.col("n") >= min_n, F.round("_mean", 6))).drop("_mean")


def histogram(spark: SparkSession, df: DataFrame, c: str, bins: int = 26, lo=None, hi=None) -> DataFrame:
    """Left-closed equal-width histogram; max lands in the last bin, values
    below range clamp to bin 0; non-finite values dropped; all bins returned."""
    data = df.filter(C.is_finite(c))
    stats = data.agg(
        (F.lit(lo) if lo is not None else F.min(c)).cast("double").alias("lo"),
        (F.lit(hi) if hi is not None else F.max(c)).cast("double").alias("hi0"),
    )
    stats = F.broadcast(
        stats.withColumn("hi", F.when(F.col("hi0") <= F.col("lo"), F.col("lo") + 1.0).otherwise(F.col("hi0")))
        .withColumn("width", (F.col("hi") - F.col("lo")) / bins)
        .drop("hi0")
    )
    idx = F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.floor((F.col(c) - F.col("lo")) / F.col("width")))).cast(
        "int"
    )
    counts = data.crossJoin(stats).groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    axis = spark.range(bins).select(F.col("id").cast("int").alias("bin")).crossJoin(stats)
    return (
        axis.join(F.broadcast(counts), "bin", "left")
        .na.fill(0, subset=["count"])
        .select(
            "bin",
            F.round(F.col("lo") + F.col("width") * (F.col("bin") + 0.5), 6).alias("centre"),
            "count",
            F.round("width", 6).alias("width"),
        )
    )


def duplicate_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows beyond the first occurrence (pandas ``duplicated().sum()``)."""
    cols = cols or df.columns
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(
        F.sum("_n").alias("rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
    ).withColumn("duplicate_share_gt_half", F.col("duplicate_rows") > F.col("rows") * 0.5)


def nonfinite_cells(df: DataFrame, cols: list[str]) -> DataFrame:
    exprs = [F.sum((~C.is_finite(c)).cast("long")).alias(c) for c in cols]
    per_col = df.agg(*exprs)
    return per_col.select(*cols, sum((F.col(c) for c in cols), F.lit(0)).alias("total_nonfinite"))


def ratio_round(n: Column, total: Column, digits: int) -> Column:
    """n / total rounded half-up to ``digits`` places in exact integer arithmetic."""
    scale = 10**digits
    return F.floor((F.lit(2 * scale) * n + total) / (F.lit(2) * total)) / float(scale)


def label_distribution(spark: SparkSession, df: DataFrame, col: str, classes: list[str], digits: int = 4) -> DataFrame:
    """Counts and shares in a given label order, zeros kept."""
    counts = df.groupBy(F.col(col).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    total = F.broadcast(df.agg(F.count(F.lit(1)).alias("_total")))
    out = complete_domain(spark, counts, "class", classes, ["n"]).crossJoin(total)
    return out.select("class_order", "class", F.col("n").cast("long"), ratio_round(F.col("n"), F.col("_total"), digits).alias("share"))


def grouped_histogram(spark: SparkSession, df: DataFrame, group: str, c: str, bins: int = 30) -> DataFrame:
    """Shared [lo, hi] over all groups, ``bins`` left-closed bins per group,
    with per-group peak and total and the global peak."""
    from pyspark.sql import Window

    data = df.filter(C.is_finite(c)).select(F.col(group).alias("_g"), F.col(c).alias("_x"))
    stats = data.agg(F.min("_x").cast("double").alias("lo"), F.max("_x").cast("double").alias("hi0"))
    stats = F.broadcast(
        stats.withColumn("hi", F.when(F.col("hi0") <= F.col("lo"), F.col("lo") + 1.0).otherwise(F.col("hi0")))
        .withColumn("width", (F.col("hi") - F.col("lo")) / bins)
        .drop("hi0")
    )
    idx = F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.floor((F.col("_x") - F.col("lo")) / F.col("width")))).cast("int")
    counts = data.crossJoin(stats).groupBy("_g", idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    groups = counts.select("_g").distinct()
    axis = groups.crossJoin(spark.range(bins).select(F.col("id").cast("int").alias("bin"))).crossJoin(stats)
    full = axis.join(counts, ["_g", "bin"], "left").na.fill(0, subset=["count"])
    wg = Window.partitionBy("_g")
    return full.select(
        F.col("_g").alias(group),
        "bin",
        F.round(F.col("lo") + F.col("width") * (F.col("bin") + 0.5), 6).alias("centre"),
        "count",
        F.max("count").over(wg).alias("group_peak"),
        F.sum("count").over(wg).cast("long").alias("group_total"),
        F.max("count").over(Window.partitionBy()).alias("global_peak"),
    )


def quantiles_by_group(df: DataFrame, group: str, spec: dict, count_col: str | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles per group, from counts of distinct values dealt by ranges."""
    if count_col:
        df = df.filter(C.is_finite(count_col))
    cols = sorted({c for c, _ in spec.values()})
    probs = {f"q{i}": q for i, q in enumerate(sorted({q for _, q in spec.values()}))}
    names = {q: n for n, q in probs.items()}
    q = O.exact_quantiles(df, [group], cols, probs)
    wide = q.groupBy(group).agg(*[F.round(F.max(F.when(F.col("column") == c, F.col(names[p]))), 6).alias(name) for name, (c, p) in spec.items()])
    if not count_col:
        return wide
    return df.groupBy(group).agg(F.count(count_col).alias("n")).join(wide, group, "left")


def value_range(df: DataFrame, c: str) -> DataFrame:
    """min/max ignoring nulls; empty -> (0, 1); equal -> widen by 1."""
    lo = F.coalesce(F.min(c), F.lit(0.0))
    hi = F.coalesce(F.max(c), F.lit(1.0))
    return df.agg(
        lo.alias("zmin"), F.when(hi <= lo, lo + 1.0).otherwise(hi).alias("zmax"), F.count(c).alias("finite_cells")
    )
