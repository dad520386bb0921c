"""Gridded daily products and rasters as long tables.

Cells are keyed by integer grid indices (never by float coordinates), so
cross-source and space-time joins are equi-joins on (time, lat_idx, lon_idx)
that shuffle on the cell key. Per-product/region statistics are single
grouped passes; time-step statistics collapse to distinct days first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.operators import ordered as O


CELL = ["lat_idx", "lon_idx"]


def normalise_values(df: DataFrame, fill: float = -327.68, col: str = "value") -> DataFrame:
    """Fill value or NaN -> NULL (two fill conventions exist upstream)."""
    v = F.col(col)
    return df.withColumn(col, F.when(v.isNull() | F.isnan(v) | (v == fill), F.lit(None).cast("double")).otherwise(v))


def grid_stats(df: DataFrame, keys: list[str]) -> DataFrame:
    v = F.col("value")
    median = O.exact_quantiles(df, keys, ["value"], {"median": 0.5}).select(*keys, F.round("median", 6).alias("median"))
    stats = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"),
        F.count(v).alias("valid"),
        F.round(100.0 * (F.count(F.lit(1)) - F.count(v)) / F.count(F.lit(1)), 6).alias("nan_pct"),
        F.round(F.min(v), 6).alias("min"),
        F.round(F.max(v), 6).alias("max"),
        F.round(F.avg(v), 6).alias("mean"),
        F.round(F.stddev_pop(v), 6).alias("std"),
    )
    return stats.join(median, keys, "left")


def cross_check(a: DataFrame, b: DataFrame, keys: list[str], tolerance: float = 1e-5) -> DataFrame:
    """Full outer cell join of two sources: both-valid count, max abs diff,
    mask mismatches, cells compared, pass flag."""
    j = a.select(*keys, F.col("value").alias("va")).join(b.select(*keys, F.col("value").alias("vb")), keys, "full")
    both = F.col("va").isNotNull() & F.col("vb").isNotNull()
    return j.agg(
        F.count(F.lit(1)).alias("cells"),
        F.sum(both.cast("long")).alias("both_valid"),
        F.round(F.coalesce(F.max(F.when(both, F.abs(F.col("va") - F.col("vb")))), F.lit(0.0)), 9).alias("max_abs_diff"),
        F.sum((F.col("va").isNull() != F.col("vb").isNull()).cast("long")).alias("mask_mismatches"),
        F.sum((F.col("va").isNull() & F.col("vb").isNull()).cast("long")).alias("both_missing"),
    ).withColumn(
        "within_tolerance", F.col("max_abs_diff") <= tolerance
    )


def trailing_accumulation(df: DataFrame, value: str, threshold: float, days: int = 84) -> DataFrame:
    """Per cell, running sum over the trailing ``days`` days of values >= threshold, / 7.
    The window is partitioned by cell, so each task holds one cell's series."""
    w = Window.partitionBy(*CELL).orderBy(F.unix_date(F.col("time"))).rangeBetween(-(days - 1), 0)
    contrib = F.when(F.col(value) >= threshold, F.col(value)).otherwise(F.lit(0.0))
    return df.withColumn("accumulation", F.round(F.sum(contrib).over(w) / 7.0, 6))
