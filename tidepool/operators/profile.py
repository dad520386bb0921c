"""Dataset profiling operators (group M)."""

from __future__ import annotations

import itertools
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Absolute correlation above which a pair is strong.
STRONG = 0.8
#: Distinct values of all columns whose ranks go to every task (16 bytes each).
RANK_ROWS = 2_000_000


def majority_by_group(df: DataFrame, group: str, label: str, classes: list[str]) -> DataFrame:
    """Majority class per group (ties -> earlier declared class): a
    groups-sized table from one grouped count."""
    order = F.create_map(*[x for i, c in enumerate(classes) for x in (F.lit(c), F.lit(i))])
    c = df.groupBy(group, label).agg(F.count(F.lit(1)).alias("n"))
    return c.groupBy(group).agg(
        F.max_by(F.col(label), F.struct(F.col("n"), -order[F.col(label)])).alias("majority")
    )


def _moments(cols: list[str], centres: list[float], ranks: dict | None):
    """Per task: for all pairs of columns the number of rows with both, and the sums of x, x squared and x y over them."""
    k = len(cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, k, k))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.column_stack([c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in batch.columns])
            if ranks is not None:
                for i, c in enumerate(cols):
                    if c not in ranks:  # ranked already
                        continue
                    values, own = ranks[c]
                    at = np.minimum(np.searchsorted(values, x[:, i]), len(values) - 1) if len(values) else np.zeros(len(x), np.int64)
                    x[:, i] = np.where(np.isnan(x[:, i]), np.nan, own[at] if len(values) else np.nan)
            there = ~np.isnan(x)
            x = np.where(there, x - centres, 0.0)
            m = there.astype(np.float64)
            total += np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
        yield pa.RecordBatch.from_pydict({"m": pa.array([total.tobytes()], pa.binary())})

    return run


def _add_moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for m in batch.column(0):
            own = np.frombuffer(m.as_py(), dtype=np.float64)
            total = own if total is None else total + own
    if total is not None:
        yield pa.RecordBatch.from_pydict({"m": pa.array([total.tobytes()], pa.binary())})


def _pairs_of(df: DataFrame, cols: list[str], value: str, centres: list[float], ranks: dict | None) -> DataFrame:
    spark, k = df.sparkSession, len(cols)
    # one record of 4 k^2 numbers a task, added up in two steps
    parts = df.select(*cols).mapInArrow(_moments(cols, centres, ranks), "m binary")
    parts = parts.repartition(16, F.spark_partition_id()).mapInArrow(_add_moments, "m binary")
    found = parts.repartition(1).mapInArrow(_add_moments, "m binary").collect()
    n, sx, sxx, sxy = (np.frombuffer(found[0][0]).reshape(4, k, k) if found else np.zeros((4, k, k)))
    rows = []
    for i, j in itertools.combinations(range(k), 2):
        r = None
        if n[i, j]:
            vx, vy = sxx[i, j] - sx[i, j] ** 2 / n[i, j], sxx[j, i] - sx[j, i] ** 2 / n[i, j]
            cxy = sxy[i, j] - sx[i, j] * sx[j, i] / n[i, j]
            r = float(cxy / np.sqrt(vx * vy)) if vx > 0 and vy > 0 else None
        rows.append((cols[i], cols[j], None if r is None else round(r, 6) + 0.0, None if r is None else abs(r) > STRONG))
    return spark.createDataFrame(rows, f"col_a string, col_b string, {value} double, strong boolean")


def correlation_pairs(df: DataFrame, cols: list[str], value: str) -> DataFrame:
    """(col_a, col_b, value, strong) of every pair of cols over the rows that have both; null for a constant column.

    Two passes: the means, then sums of products of deviations from them. NaN counts as missing.
    """
    means = df.agg(*[F.avg(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))).alias(c) for c in cols]).first()
    return _pairs_of(df, cols, value, [means[c] or 0.0 for c in cols], None)


def rank_correlation_pairs(df: DataFrame, cols: list[str], value: str) -> DataFrame:
    """correlation_pairs of average ranks, ties at their mean rank.

    Ranks come from the counts of distinct values. A table of up to RANK_ROWS
    values goes to every task, which looks ranks up where the rows are: that of
    the columns with the fewest values. Only the other columns' values are
    joined to their ranks, by (column, value), and brought back to their rows.
    """
    from tidepool.operators import ordered as O
    from tidepool.sources.io import cut, row_partitions

    long = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in cols]).unpivot([], cols, "column", "value").where("value is not null")
    ranks = cut(O.average_ranks(long, "column", "value"), "ranks")
    # the mean rank of n rows is (n + 1) / 2
    counts = df.agg(*[F.count(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))).alias(c) for c in cols]).first()
    centres = [(counts[c] + 1) / 2 for c in cols]
    sizes = {r["column"]: r["count"] for r in ranks.groupBy("column").count().collect()}  # one row a column
    small, room = [], RANK_ROWS
    for c in sorted(cols, key=lambda c: sizes.get(c, 0)):
        if sizes.get(c, 0) <= room:
            small.append(c)
            room -= sizes.get(c, 0)
    large = [c for c in cols if c not in small]
    t = ranks.where(F.col("column").isin(small)).orderBy("column", "value").toArrow()
    column, values, own = (t.column(c).to_numpy() for c in ("column", "value", "avg_rank"))
    looked_up = {c: (values[column == c], own[column == c]) for c in small}
    if not large:
        return _pairs_of(df, cols, value, centres, looked_up)
    keyed = cut(df.select(*[F.col(c).cast("double").alias(c) for c in cols]).withColumn("__row", F.monotonically_increasing_id()), "rank-rows")
    # partitions follow the number of rows: the sorts by row stay in memory
    n = row_partitions(df.sparkSession, keyed.count())
    ranked = keyed.unpivot(["__row"], large, "column", "value").where("value is not null").join(ranks.where(F.col("column").isin(large)), ["column", "value"])
    back = ranked.select("__row", *[F.when(F.col("column") == c, F.col("avg_rank")).alias(c) for c in large]).repartition(n, "__row")
    back = back.groupBy("__row").agg(*[F.max(c).alias(c) for c in large])
    wide = keyed.select("__row", *small).repartition(n, "__row").join(back, "__row", "left")
    return _pairs_of(wide, cols, value, centres, looked_up)
