"""Drift monitoring (group J): two windows of one table, told apart by a ``side`` column.

One scan collapses both windows to counts per distinct value; sizes, means,
deviations, distances and quantiles all come from that table. Every finish is a
column expression. A side without rows gives the neutral result: statistic 0,
p-value 1, no drift.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool import schema as S
from tidepool.functions import columns as C
from tidepool.operators import ordered as O
from tidepool.operators import scalar as B

METHODS = ("ks", "wasserstein_normed")


def reference_window(df: DataFrame, n: int = S.SAMPLE_WINDOW_ROWS, seed: int = 42) -> DataFrame:
    """``min(n, rows)`` rows in md5 order of the seed, labels dropped."""
    return B.drop_labels(O.seeded_sample(df, n, seed))


def production_window(df: DataFrame, n: int = S.SAMPLE_WINDOW_ROWS, seed: int = 43, scale: float = 1.0) -> DataFrame:
    """``min(n, rows)`` rows of another seed, shifted by ``scale``, labels dropped."""
    return B.drop_labels(B.apply_shift(O.seeded_sample(df, n, seed), scale))


def split_windows(df: DataFrame, cut: str = S.WINDOW_CUT, scale: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """Rows before the cut as they are, rows from the cut on shifted; labels dropped."""
    before = F.col("timestamp") < F.lit(cut).cast("timestamp")
    return B.drop_labels(df.where(before)), B.drop_labels(B.apply_shift(df.where(~before), scale))


def sided(df: DataFrame, cut: str = S.WINDOW_CUT, scale: float = 1.0) -> DataFrame:
    """Both windows of ``split_windows`` in one frame, with ``side`` (reference or current): one scan."""
    current = F.col("timestamp") >= F.lit(cut).cast("timestamp")
    shifted = {}
    for c, magnitude in S.SHIFTS.items():
        low, high = S.SHIFT_CLIP[c]
        if c in df.columns and scale:
            shifted[c] = F.when(current, C.clip(F.col(c) + scale * magnitude, low, high)).otherwise(F.col(c))
    return B.drop_labels(df.withColumns({"side": F.when(current, "current").otherwise("reference"), **shifted}))


def stack(ref: DataFrame, cur: DataFrame, columns: list[str]) -> DataFrame:
    """Two windows with equal columns in one frame with ``side``."""
    return ref.select(F.lit("reference").alias("side"), *columns).unionByName(cur.select(F.lit("current").alias("side"), *columns))


def value_counts(both: DataFrame, columns: list[str], finite: bool = True) -> DataFrame:
    """(column, value, n_ref, n_cur) per distinct value; non-finite values dropped or kept."""
    long = both.select("side", *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(["side"], columns, "column", "value")
    if finite:
        long = long.filter(C.is_finite("value"))
    return long.groupBy("column", "value").agg(
        F.sum((F.col("side") == "reference").cast("long")).alias("n_ref"),
        F.sum((F.col("side") == "current").cast("long")).alias("n_cur"),
    )


def ks_p_asymptotic(d, n1, n2):
    """Kolmogorov asymptotic two-sample p-value as a Column expression."""
    en = F.sqrt(n1 * n2 / (n1 + n2))
    lam = (en + 0.12 + 0.11 / en) * d
    terms = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(-2.0 * k * k * lam * lam),
    )
    return F.when((d <= 0) | (n1 <= 0) | (n2 <= 0), F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), terms)))


def distances(spark: SparkSession, counts: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: KS D, Wasserstein-1, sizes, means, the reference's population std. Every column has a row."""
    pre = O.value_prefix(counts, "column", "value", ["n_ref", "n_cur"])
    totals = pre.groupBy("column").agg(
        F.max("cum_n_ref").alias("n_reference"),
        F.max("cum_n_cur").alias("n_current"),
        F.try_divide(F.sum(F.col("value") * F.col("n_ref")), F.sum("n_ref")).alias("mean_reference"),
        F.try_divide(F.sum(F.col("value") * F.col("n_cur")), F.sum("n_cur")).alias("mean_current"),
    )
    apart = F.abs(F.try_divide("cum_n_ref", "n_reference") - F.try_divide("cum_n_cur", "n_current"))
    away = F.col("value") - F.col("mean_reference")
    found = pre.join(totals, "column").groupBy("column").agg(
        F.max(apart).alias("ks_statistic"),
        F.sum(apart * F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0))).alias("wasserstein"),
        F.first("n_reference").alias("n_reference"),
        F.first("n_current").alias("n_current"),
        F.first("mean_reference").alias("mean_reference"),
        F.first("mean_current").alias("mean_current"),
        F.sqrt(F.try_divide(F.sum(F.col("n_ref") * away * away), F.sum("n_ref"))).alias("std_reference"),
    )
    every = spark.createDataFrame([(c,) for c in columns], "column string").join(found, "column", "left")
    return every.select(
        "column",
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("ks_statistic", "wasserstein", "mean_reference", "mean_current", "std_reference")],
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_reference", "n_current")],
    ).withColumns(
        {
            "normed": F.col("wasserstein") / F.greatest(F.col("std_reference"), F.lit(0.001)),
            "ks_p": ks_p_asymptotic(F.col("ks_statistic"), F.col("n_reference"), F.col("n_current")),
        }
    )


def feature_drift(d: DataFrame, method: str = "wasserstein_normed", threshold: float = 0.1) -> DataFrame:
    """Of ``distances``: per column the method's value, the threshold, drifted, legacy_flag, and both statistics.

    ``drifted`` uses the comparison that fits the method (p < threshold,
    distance >= threshold); ``legacy_flag`` keeps the old ``value < threshold``.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    value = F.col("ks_p" if method == "ks" else "normed")
    return d.select(
        "column",
        F.lit(method).alias("method"),
        F.round(value, 6).alias("value"),
        F.lit(float(threshold)).alias("threshold"),
        ((value < threshold) if method == "ks" else (value >= threshold)).alias("drifted"),
        (value < threshold).alias("legacy_flag"),
        F.round("ks_statistic", 6).alias("ks_statistic"),
        F.round("normed", 6).alias("wasserstein_normed"),
    )


def drift_share(per_column: DataFrame) -> DataFrame:
    return per_column.agg(
        F.sum(F.col("drifted").cast("long")).alias("drifted_count"),
        F.count(F.lit(1)).alias("total_columns"),
        F.round(F.sum(F.col("drifted").cast("long")) / F.count(F.lit(1)), 4).alias("drifted_share"),
    )


def chi2_sf(stat: Column, dof: Column, most: int) -> Column:
    """Chi-squared survival function for 1 to ``most`` degrees of freedom, as an expression.

    One less the regularised lower incomplete gamma function, summed by its
    power series, each term from the one before; 1 without freedom.
    """
    a, x = dof / 2.0, stat / 2.0
    gammas = F.array(*[F.lit(math.gamma(k / 2 + 1)) for k in range(1, most + 1)])
    first = F.pow(x, a) * F.exp(-x) / F.try_element_at(gammas, dof.cast("int"))
    start = F.struct(first.alias("term"), first.alias("total"))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(1500)),
        start,
        lambda acc, n: F.struct((acc["term"] * x / (a + n)).alias("term"), (acc["total"] + acc["term"] * x / (a + n)).alias("total")),
        lambda acc: F.greatest(F.lit(0.0), 1.0 - acc["total"]),
    )
    return F.when((dof <= 0) | (stat <= 0), F.lit(1.0)).when(x > 650, F.lit(0.0)).otherwise(series)


def prediction_drift(both: DataFrame, tasks: dict[str, tuple[str, list[str]]], threshold: float = 0.1) -> DataFrame:
    """Chi-squared test on the 2 x k counts of predicted classes, one row per task, in one aggregate.

    ``tasks`` names each task's class column and classes. Classes without rows
    are left out; fewer than two classes or a side without rows give statistic 0
    and p 1; Yates' correction when two classes remain. Both share maps are
    included, rounded to 4 places.
    """
    sums = {}
    for task, (column, classes) in tasks.items():
        for i, c in enumerate(classes):
            for side in ("reference", "current"):
                hit = (F.col(column) == c) & (F.col("side") == side)
                sums[f"{task}_{i}_{side}"] = F.coalesce(F.sum(hit.cast("long")), F.lit(0))
    one = both.agg(*[v.alias(k) for k, v in sums.items()])
    rows = []
    for task, (_, classes) in tasks.items():
        cells = F.array(*[F.struct(F.lit(c).alias("class"), F.col(f"{task}_{i}_reference").alias("r"), F.col(f"{task}_{i}_current").alias("c")) for i, c in enumerate(classes)])
        rows.append(F.struct(F.lit(task).alias("task"), cells.alias("cells")))
    t = one.select(F.explode(F.array(*rows)).alias("t")).select("t.*")

    def total(side: str) -> Column:
        return F.aggregate("cells", F.lit(0).cast("long"), lambda acc, x: acc + x[side])

    t = t.withColumns({"n_reference": total("r"), "n_current": total("c"), "k": F.size(F.filter("cells", lambda x: x["r"] + x["c"] > 0))})
    able = (F.col("n_reference") > 0) & (F.col("n_current") > 0) & (F.col("k") >= 2)
    every = F.col("n_reference") + F.col("n_current")
    yates = F.when(F.col("k") == 2, 0.5).otherwise(0.0)

    def part(x: Column, side: str, n: str) -> Column:
        expected = F.col(n) * (x["r"] + x["c"]) / every
        off = F.greatest(F.abs(x[side] - expected) - yates, F.lit(0.0))
        return F.when(expected > 0, off * off / expected).otherwise(0.0)

    stat = F.aggregate("cells", F.lit(0.0), lambda acc, x: acc + part(x, "r", "n_reference") + part(x, "c", "n_current"))
    most = max(len(classes) for _, classes in tasks.values())
    t = t.withColumns({"stat": F.when(able, stat).otherwise(0.0), "dof": F.when(able, F.col("k") - 1).otherwise(0)})
    t = t.withColumn("p", F.round(chi2_sf(F.col("stat"), F.col("dof"), most), 6))

    def shares(side: str, n: str) -> Column:
        return F.map_from_entries(F.transform("cells", lambda x: F.struct(x["class"], F.round(F.coalesce(F.try_divide(x[side], F.col(n)), F.lit(0.0)), 4))))

    return t.select(
        "task",
        F.round("stat", 4).alias("statistic"),
        "dof",
        F.col("p").alias("p_value"),
        (F.col("p") < threshold).alias("drifted"),
        "n_reference",
        "n_current",
        shares("r", "n_reference").alias("reference_distribution"),
        shares("c", "n_current").alias("current_distribution"),
    )


def confidence_drift(spark: SparkSession, both: DataFrame, columns: dict[str, str], threshold: float = 0.1) -> DataFrame:
    """Two-sample KS on each task's confidence column: D (exact), asymptotic p, means and their difference."""
    return confidence_of(distances(spark, value_counts(both, list(columns.values())), list(columns.values())), columns, threshold)


def confidence_of(d: DataFrame, columns: dict[str, str], threshold: float = 0.1) -> DataFrame:
    """confidence_drift from distances that hold the confidence columns."""
    d = d.where(F.col("column").isin(list(columns.values())))
    name = F.create_map(*[F.lit(x) for task, c in columns.items() for x in (c, task)])
    return d.select(
        name[F.col("column")].alias("task"),
        F.round("ks_statistic", 4).alias("statistic"),
        F.round("ks_p", 6).alias("p_value_asymptotic"),
        (F.col("ks_p") < threshold).alias("drifted"),
        F.round("mean_reference", 4).alias("mean_reference"),
        F.round("mean_current", 4).alias("mean_current"),
        F.round(F.col("mean_current") - F.col("mean_reference"), 4).alias("delta"),
        "n_reference",
        "n_current",
    )


def data_summary(both: DataFrame, columns: list[str]) -> DataFrame:
    """Per column and window: count, nulls, mean, population std, min, quartiles, max, all from the count table."""
    long = both.select("side", *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(["side"], columns, "column", "value")
    counts = long.groupBy("column", "side", "value").agg(F.count(F.lit(1)).alias("n"))
    pre = O.value_prefix(counts, ["column", "side"], "value", ["n"])
    there = F.col("value").isNotNull()
    # nulls sort first: places of values start after them
    totals = pre.groupBy(F.col("column").alias("__c"), F.col("side").alias("__s")).agg(
        F.sum(F.when(there, F.col("n")).otherwise(0)).alias("count"),
        F.sum(F.when(there, 0).otherwise(F.col("n"))).alias("nulls"),
        F.try_divide(F.sum(F.col("value") * F.col("n")), F.sum(F.when(there, F.col("n")))).alias("avg"),
    )
    d = pre.join(totals, (F.col("column") == F.col("__c")) & (F.col("side") == F.col("__s"))).withColumn("cum", F.col("cum_n") - F.col("nulls"))
    away = F.col("value") - F.col("avg")
    return d.groupBy("column", "side").agg(
        F.first("count").alias("count"),
        F.first("nulls").alias("nulls"),
        F.round(F.first("avg"), 6).alias("mean"),
        F.round(F.sqrt(F.try_divide(F.sum(F.col("n") * away * away), F.first("count"))), 6).alias("std"),
        F.min("value").alias("min"),
        *[F.round(O.quantile_of("value", "cum", "count", q), 6).alias(n) for n, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))],
        F.max("value").alias("max"),
    )


def share_change_flags(both: DataFrame, label: str, min_change: float = 0.05) -> DataFrame:
    """Class shares of both windows side by side (missing -> 0), flag |change| >= min_change."""
    n = both.groupBy(F.col(label).alias("class")).agg(
        F.sum((F.col("side") == "reference").cast("long")).alias("r"), F.sum((F.col("side") == "current").cast("long")).alias("c")
    )
    totals = n.agg(F.sum("r").alias("all_r"), F.sum("c").alias("all_c"))
    j = n.crossJoin(totals).select(
        "class",
        F.coalesce(F.try_divide("r", "all_r"), F.lit(0.0)).alias("_r"),
        F.coalesce(F.try_divide("c", "all_c"), F.lit(0.0)).alias("_c"),
    )
    return j.select(
        "class",
        F.round("_r", 6).alias("reference_share"),
        F.round("_c", 6).alias("current_share"),
        F.round(F.col("_c") - F.col("_r"), 6).alias("change"),
        (F.abs(F.col("_c") - F.col("_r")) >= min_change).alias("flagged"),
    )


def feature_skew(df: DataFrame, a: str, b: str) -> DataFrame:
    """How far two definitions of one feature disagree: rows differing, max/mean |diff|."""
    diff = F.abs(F.col(a) - F.col(b))
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum((diff > 1e-12).cast("long")).alias("rows_differing"),
        F.round(F.max(diff), 6).alias("max_abs_diff"),
        F.round(F.avg(diff), 6).alias("mean_abs_diff"),
    )
