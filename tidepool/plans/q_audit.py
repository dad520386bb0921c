"""Audit tables: constant columns, values at fixed limits, gaps in hours, baselines and formula labels with full scores, monthly series."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool import schema as S
from tidepool.functions import columns as C
from tidepool.operators import metrics as M
from tidepool.operators import ordered as O
from tidepool.operators import profile as PR
from tidepool.plans import sqlviews as V
from tidepool.plans.q_ml import _metrics_select, _per_class_sql, both_tasks_sql
from tidepool.plans.registry import register
from tidepool.sources import fixtures as X

NEAR_CONSTANT = 0.95
_PROFILED = ["region", *S.TARGET_COLUMNS, "latitude", "longitude", *S.SENSOR_COLUMNS]


def _as_text(c: str) -> str:
    return c if c in ("region", *S.TARGET_COLUMNS) else f"CAST(round({c} * 1000000) AS BIGINT)::VARCHAR"


@register(
    "constant_columns",
    "WITH l AS (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {_as_text(c)} AS value, count(*) AS n FROM observations_dirty GROUP BY ALL" for c in _PROFILED)
    + f""") SELECT "column", count(value) AS distinct_values, CAST(coalesce(sum(n) FILTER (value IS NULL), 0) AS BIGINT) AS nulls, round(max(n) / sum(n), 6) AS top_share,
        count(*) = 1 AS constant, max(n) > {NEAR_CONSTANT} * sum(n) AS near_constant FROM l GROUP BY 1""",
)
def constant_columns(spark, sf_dir):
    """Distinct values and the share of the most frequent one (null counts as one) of every column, from one exploded count."""
    obs = X.observations_dirty(spark, sf_dir)
    text = {c: F.col(c) if c in ("region", *S.TARGET_COLUMNS) else F.round(F.col(c) * 1000000).cast("long").cast("string") for c in _PROFILED}
    counts = obs.select(*[v.alias(c) for c, v in text.items()]).unpivot([], _PROFILED, "column", "value").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("column").agg(
        F.count("value").alias("distinct_values"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).cast("long").alias("nulls"),
        F.round(F.max("n") / F.sum("n"), 6).alias("top_share"),
        (F.count(F.lit(1)) == 1).alias("constant"),
        (F.max("n") > NEAR_CONSTANT * F.sum("n")).alias("near_constant"),
    )


#: The limits that readings are clipped to: the declared bounds and the limits of shifted columns.
CLIP_VALUES = {c: tuple(dict.fromkeys([*S.COLUMN_BOUNDS[c], *S.SHIFT_CLIP.get(c, ())])) for c in S.SENSOR_COLUMNS}


@register(
    "fixed_clip_values",
    "WITH w AS (SELECT * FROM prod_window) "
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {v}::DOUBLE AS clip_value, CAST(coalesce(sum(CASE WHEN {c} = {v} THEN 1 ELSE 0 END), 0) AS BIGINT) AS rows, count(*) AS of_rows FROM w" for c, vs in CLIP_VALUES.items() for v in vs),
)
def fixed_clip_values(spark, sf_dir):
    """Rows of the shifted window exactly at a fixed limit, a row per column and limit, from one pass."""
    from tidepool.plans.q_drift import windows

    pairs = [(c, v) for c, vs in CLIP_VALUES.items() for v in vs]
    one = windows(spark, sf_dir)[1].agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum((F.col(c) == v).cast("long")), F.lit(0)).alias(f"p{i}") for i, (c, v) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(float(v)).alias("clip_value"), F.col(f"p{i}").alias("rows")) for i, (c, v) in enumerate(pairs)])
    return one.select("n", F.explode(rows).alias("r")).select("r.*", F.col("n").alias("of_rows"))


@register(
    "time_gaps_hours",
    """WITH t AS (SELECT region, epoch(timestamp) + (_ep % 24) * 3600 AS s FROM obs_labelled GROUP BY 1, 2),
    g AS (SELECT region, s, lead(s) OVER (PARTITION BY region ORDER BY s) - s AS gap FROM t)
    SELECT region, count(*) AS distinct_times, round((max(s) - min(s)) / 3600, 4) AS span_hours, round(quantile_cont(gap, 0.5) / 3600, 4) AS median_gap_hours,
      round(max(gap) / 3600, 4) AS max_gap_hours, count(*) FILTER (gap > 86400) AS gaps_over_24h FROM g GROUP BY 1""",
)
def time_gaps_hours(spark, sf_dir):
    """M07 in hours: gaps between the different times of a region's observations (the hour comes from the row's key). Times are dealt by ranges; no task holds a region's."""
    rows = X.labelled_base(spark, sf_dir).select("region", (F.unix_seconds(F.col("timestamp").cast("timestamp")) + F.col("_ep") % 24 * 3600).cast("double").alias("s"))
    counts = rows.groupBy("region", "s").agg(F.count(F.lit(1)).alias("n"))
    gaps = O.value_prefix(counts, "region", "s", ["n"]).select("region", "s", (F.col("next_value") - F.col("s")).alias("gap"))
    median = O.exact_quantiles(gaps, ["region"], ["gap"], {"median_gap": 0.5}).drop("column")
    out = gaps.groupBy("region").agg(F.count(F.lit(1)).alias("distinct_times"), (F.max("s") - F.min("s")).alias("span"), F.max("gap").alias("most"), F.sum((F.coalesce("gap", F.lit(0.0)) > 86400).cast("long")).alias("gaps_over_24h"))
    hours = {"span_hours": "span", "median_gap_hours": "median_gap", "max_gap_hours": "most"}
    return out.join(F.broadcast(median), "region").select("region", "distinct_times", *[F.round(F.col(c) / 3600, 4).alias(n) for n, c in hours.items()], "gaps_over_24h")  # a row a region


def _baseline_sql(task: str) -> str:
    label, order = S.TASK_TARGET[task], " ".join(f"WHEN {V.q(c)} THEN {i}" for i, c in enumerate(S.TASK_CLASSES[task]))
    return f"""WITH c AS (SELECT region, {label} AS y, count(*) AS n FROM observations GROUP BY 1, 2),
    mj AS (SELECT region, arg_max(y, n * 1000000 - CASE y {order} END) AS y_pred FROM c GROUP BY 1),
    b AS (SELECT o.{label} AS y_true, y_pred FROM observations o JOIN mj USING (region)), {_per_class_sql("b")} {_metrics_select()}"""


@register("region_majority_baseline", both_tasks_sql(_baseline_sql))
def region_majority_baseline(spark, sf_dir):
    """The metrics of predicting each region's majority class. Rows are counted once by region and class; the rest is arithmetic on the counts."""
    each = F.explode(F.array(*[F.struct(F.lit(t).alias("task"), F.col(c).alias("y_true")) for t, c in S.TASK_TARGET.items()])).alias("t")
    rows = X.observations(spark, sf_dir).select("region", each).select("t.*", "region").withColumn("place", F.struct("task", "region"))
    majority = PR.majority_by_group(rows, "place", "y_true", S.HEALTH_CLASSES + S.RESTORATION_CLASSES)
    counts = rows.groupBy("place", "task", "y_true").agg(F.count(F.lit(1)).alias("n"))
    cells = counts.join(F.broadcast(majority), "place").groupBy("task", "y_true", F.col("majority").alias("y_pred")).agg(F.sum("n").alias("n"))  # a row a region and task
    return M.metrics_of_counts(cells, ["task"])


def _score_sql(task: str) -> str:
    score = V.health_score() if task == "health" else V.restoration_score()
    order = " ".join(f"WHEN {V.q(c)} THEN {i}" for i, c in enumerate(S.TASK_CLASSES[task]))
    src = f"scored_{task}"
    return f"""WITH {_per_class_sql(src)}, f AS ({_metrics_select()}),
    s AS (SELECT round({score}, 9) AS score, CASE y_true {order} END AS place FROM obs_base JOIN {src} USING (obs_id)),
    r AS (SELECT rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS a, rank() OVER (ORDER BY place) + (count(*) OVER (PARTITION BY place) - 1) / 2.0 AS b FROM s)
    SELECT accuracy, balanced_accuracy, macro_f1, n, round((SELECT corr(a, b) FROM r), 6) AS spearman FROM f"""


@register("closed_form_scores", both_tasks_sql(_score_sql))
def closed_form_scores(spark, sf_dir):
    """Metrics of the formula's labels against the stored ones, and the rank correlation of the formula's score with the stored class.

    Ranks are those of counted distinct values, so the correlation is a sum over
    (score, class) counts: no rank is joined to a row.
    """
    base = X.observations_base(spark, sf_dir)
    out = None
    for task, score, to_class in (("health", C.with_health_score, C.health_class), ("restoration", C.with_restoration_score, C.restoration_class)):
        s = F.col("_s")
        rows = score(base, "_s", None, False).select(F.round(s, 9).alias("score"), to_class(F.round(s + X.truth_offset(), 9)).alias("y_true"), to_class(F.round(s, 9)).alias("y_pred"))
        metrics = M.classification_metrics(rows, "y_true", "y_pred").select("accuracy", "balanced_accuracy", "macro_f1", "n")
        place = C.ordinal_map(S.TASK_CLASSES[task])[F.col("y_true")].cast("double")
        counts = rows.groupBy("score", place.alias("place")).agg(F.count(F.lit(1)).alias("n"))

        def ranks(column):
            own = counts.groupBy(F.lit("all").alias("g"), F.col(column).alias("v")).agg(F.sum("n").alias("n"))
            return O.value_prefix(own, "g", "v", ["n"]).select(F.col("v").alias(column), (F.col("cum_n") - F.col("n") + (F.col("n") + 1) / 2.0).alias(f"r_{column}"))

        j = counts.join(ranks("score"), "score").join(F.broadcast(ranks("place")), "place")  # a row a class
        n, a, b = F.col("n").cast("double"), F.col("r_score"), F.col("r_place")
        centre = counts.agg(((F.sum("n") + 1) / 2.0).alias("c"))
        j = j.crossJoin(F.broadcast(centre)).withColumns({"a": a - F.col("c"), "b": b - F.col("c")})
        rho = j.agg(F.round(F.sum(n * F.col("a") * F.col("b")) / F.sqrt(F.sum(n * F.col("a") * F.col("a")) * F.sum(n * F.col("b") * F.col("b"))), 6).alias("spearman"))
        own = metrics.crossJoin(rho).select(F.lit(task).alias("task"), "*")  # one row each
        out = own if out is None else out.unionByName(own)
    return out


@register(
    "monthly_series",
    """WITH d AS (SELECT region, time, avg(sst) AS sst FROM grid_history GROUP BY 1, 2)
    SELECT region, CAST(year(time) AS INTEGER) AS year, CAST(month(time) AS INTEGER) AS month, count(*) AS days, round(avg(sst), 6) AS sst FROM d GROUP BY 1, 2, 3""",
)
def monthly_series(spark, sf_dir):
    """The region-month series of spatial daily means that the climatology is taken of."""
    d = X.grid_history(spark, sf_dir).groupBy("region", "time").agg(F.avg("sst").alias("sst"))
    return d.groupBy("region", F.year("time").alias("year"), F.month("time").alias("month")).agg(F.count(F.lit(1)).alias("days"), F.round(F.avg("sst"), 6).alias("sst"))


@register(
    "hotspot_days",
    """WITH c AS (SELECT region, month(time) AS m, avg(sst) AS mean FROM grid_history GROUP BY 1, 2),
    x AS (SELECT region, max(mean) AS warmest FROM c GROUP BY 1),
    d AS (SELECT g.region, g.time, max(g.sst) - any_value(warmest) AS hotspot FROM grid_history g JOIN x USING (region) GROUP BY 1, 2)
    SELECT region, count(*) AS days, count(*) FILTER (hotspot > 0) AS days_above, count(*) FILTER (hotspot >= 1) AS days_hotspot_ge_1, round(max(hotspot), 6) AS max_hotspot FROM d GROUP BY 1""",
)
def hotspot_days(spark, sf_dir):
    """Days whose warmest cell is at least 1 degree above the region's warmest monthly mean."""
    g = X.grid_history(spark, sf_dir)
    warmest = g.groupBy("region", F.month("time").alias("m")).agg(F.avg("sst").alias("mean")).groupBy("region").agg(F.max("mean").alias("warmest"))
    d = g.groupBy("region", "time").agg(F.max("sst").alias("top")).join(F.broadcast(warmest), "region").withColumn("hotspot", F.col("top") - F.col("warmest"))  # a row a region
    return d.groupBy("region").agg(
        F.count(F.lit(1)).alias("days"), F.sum((F.col("hotspot") > 0).cast("long")).alias("days_above"), F.sum((F.col("hotspot") >= 1).cast("long")).alias("days_hotspot_ge_1"), F.round(F.max("hotspot"), 6).alias("max_hotspot")
    )
