"""Group M queries: dataset profile analyses (published result tables)."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from tidepool import schema as S
from tidepool.operators import ordered as O
from tidepool.operators import profile as PR
from tidepool.plans import sqlviews as V
from tidepool.plans.q_ml import _for_task, both_tasks_sql
from tidepool.plans.registry import also, register
from tidepool.sources import fixtures as X
from tidepool.sources.io import cut



def grid_history_cells(spark, sf_dir):
    return X.grid_history(spark, sf_dir).groupBy("time", "lat_idx", "lon_idx").agg(F.max("dhw").alias("value"))


def _obs(spark, sf_dir):
    return X.observations(spark, sf_dir)


# --- fixed values: implausibility rules --------------------------------------
RULES = {
    "cover0_bleaching_pos": ("coral_cover_percentage = 0 AND bleaching_percentage > 0",
                             lambda: (F.col("coral_cover_percentage") == 0) & (F.col("bleaching_percentage") > 0)),
    "temp_gt_34": ("water_temperature_c > 34", lambda: F.col("water_temperature_c") > 34),
    "ph_lt_7_8": ("ph < 7.8", lambda: F.col("ph") < 7.8),
    "salinity_gt_40": ("salinity_ppt > 40", lambda: F.col("salinity_ppt") > 40),
    "do_lt_3": ("dissolved_oxygen_mg_l < 3", lambda: F.col("dissolved_oxygen_mg_l") < 3),
}


# the rest of the audit's list; its exact-value rows are clip_pileups
ALL_RULES = RULES | {
    "cover0_disease_pos": ("coral_cover_percentage = 0 AND disease_percentage > 0",
                           lambda: (F.col("coral_cover_percentage") == 0) & (F.col("disease_percentage") > 0)),
    "bleaching_cover_gt_100": ("bleaching_percentage + coral_cover_percentage > 100",
                               lambda: F.col("bleaching_percentage") + F.col("coral_cover_percentage") > 100),
}


def count_rules(df):
    return df.agg(*[F.sum(f().cast("long")).alias(n) for n, (_, f) in ALL_RULES.items()])


@register(
    "implausible_rows_all",
    "SELECT " + ", ".join(f"CAST(sum(CASE WHEN {s} THEN 1 ELSE 0 END) AS BIGINT) AS {n}" for n, (s, _) in ALL_RULES.items())
    + " FROM observations",
)
def implausible_rows_all(spark, sf_dir):
    """M02 with every rule of the audit's list."""
    return count_rules(_obs(spark, sf_dir))


_PILE_COLS = S.SENSOR_COLUMNS


@register(
    "clip_pileups",
    "WITH m AS (SELECT " + ", ".join(f"min({c}) AS {c}__lo, max({c}) AS {c}__hi" for c in _PILE_COLS) + " FROM observations) "
    + "SELECT " + ", ".join(
        f"CAST(sum(CASE WHEN {c} = {c}__lo THEN 1 ELSE 0 END) AS BIGINT) AS {c}_at_min, "
        f"CAST(sum(CASE WHEN {c} = {c}__hi THEN 1 ELSE 0 END) AS BIGINT) AS {c}_at_max" for c in _PILE_COLS
    ) + " FROM observations, m",
)
def clip_pileups(spark, sf_dir):
    obs = _obs(spark, sf_dir)
    m = F.broadcast(obs.agg(*[x for c in _PILE_COLS for x in (F.min(c).alias(f"{c}__lo"), F.max(c).alias(f"{c}__hi"))]))
    j = obs.crossJoin(m)  # m is one row
    aggs = []
    for c in _PILE_COLS:
        aggs += [
            F.sum((F.col(c) == F.col(f"{c}__lo")).cast("long")).alias(f"{c}_at_min"),
            F.sum((F.col(c) == F.col(f"{c}__hi")).cast("long")).alias(f"{c}_at_max"),
        ]
    return j.agg(*aggs)


@register(
    "region_inventory",
    """SELECT region, count(*) AS rows, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct,
       min(latitude) AS lat_min, max(latitude) AS lat_max, min(longitude) AS lon_min, max(longitude) AS lon_max,
       count(DISTINCT (latitude, longitude)) AS unique_coordinates
    FROM observations GROUP BY region""",
)
def region_inventory(spark, sf_dir):
    obs = _obs(spark, sf_dir)
    g = obs.groupBy("region").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("latitude").alias("lat_min"), F.max("latitude").alias("lat_max"),
        F.min("longitude").alias("lon_min"), F.max("longitude").alias("lon_max"),
        F.countDistinct("latitude", "longitude").alias("unique_coordinates"),
    )
    total = F.broadcast(obs.agg(F.count(F.lit(1)).alias("_t")))
    return g.crossJoin(total).withColumn("pct", F.round(100.0 * F.col("rows") / F.col("_t"), 6)).drop("_t")


@register(
    "rows_by_period",
    """SELECT 'year' AS period, CAST(year(timestamp) AS VARCHAR) AS key, NULL AS region, count(*) AS rows FROM observations GROUP BY 2
    UNION ALL SELECT 'month', CAST(month(timestamp) AS VARCHAR), NULL, count(*) FROM observations GROUP BY 2
    UNION ALL SELECT 'region_year', CAST(year(timestamp) AS VARCHAR), region, count(*) FROM observations GROUP BY 2, 3""",
)
def rows_by_period(spark, sf_dir):
    obs = _obs(spark, sf_dir)
    y = obs.groupBy(F.year("timestamp").cast("string").alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    m = obs.groupBy(F.month("timestamp").cast("string").alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    ry = obs.groupBy(F.year("timestamp").cast("string").alias("key"), "region").agg(F.count(F.lit(1)).alias("rows"))
    none = F.lit(None).cast("string")
    return (
        y.select(F.lit("year").alias("period"), "key", none.alias("region"), "rows")
        .unionByName(m.select(F.lit("month").alias("period"), "key", none.alias("region"), "rows"))
        .unionByName(ry.select(F.lit("region_year").alias("period"), "key", "region", "rows"))
    )


@register(
    "time_correlation",
    "SELECT " + ", ".join(f"round(corr({c}, epoch(timestamp)), 6) AS {c}" for c in S.SENSOR_COLUMNS) + " FROM observations",
)
def time_correlation(spark, sf_dir):
    obs = _obs(spark, sf_dir).withColumn("_t", F.unix_timestamp(F.col("timestamp").cast("timestamp")).cast("double"))
    return obs.agg(*[F.round(F.corr(c, "_t"), 6).alias(c) for c in S.SENSOR_COLUMNS])


_GROUPINGS = {"month": ("month(timestamp)", lambda: F.month("timestamp")), "year": ("year(timestamp)", lambda: F.year("timestamp")), "region": ("region", lambda: F.col("region"))}


@register(
    "eta_squared",
    """WITH l AS (SELECT timestamp, region, "column", value FROM observations UNPIVOT (value FOR "column" IN ("""
    + ", ".join(S.SENSOR_COLUMNS)
    + """))),
    k AS ("""
    + " UNION ALL ".join(f"""SELECT '{name}' AS grouping, CAST({sql} AS VARCHAR) AS grp, "column", value FROM l""" for name, (sql, _) in _GROUPINGS.items())
    + """),
    g AS (SELECT grouping, "column", grp, count(*) AS n, avg(value) AS m FROM k GROUP BY ALL),
    t AS (SELECT "column", avg(value) AS gm, var_pop(value) * count(*) AS sst FROM l GROUP BY 1)
    SELECT grouping, g."column", round(sum(n * (m - gm) * (m - gm)) / max(sst), 6) AS eta_squared FROM g JOIN t ON g."column" = t."column" GROUP BY ALL""",
)
def eta_squared(spark, sf_dir):
    """Share of each sensor's variance between months, years and regions; 0 for a constant column."""
    keys = [f().cast("string").alias(name) for name, (_, f) in _GROUPINGS.items()]
    long = _obs(spark, sf_dir).select(*keys, *S.SENSOR_COLUMNS).unpivot(list(_GROUPINGS), S.SENSOR_COLUMNS, "column", "value")
    grouping = F.explode(F.array(*[F.struct(F.lit(k).alias("grouping"), F.col(k).alias("grp")) for k in _GROUPINGS]))
    g = long.select("column", "value", grouping.alias("k")).groupBy("k.grouping", "column", "k.grp").agg(F.count("value").alias("n"), F.avg("value").alias("m"))
    t = long.groupBy("column").agg(F.avg("value").alias("gm"), (F.var_pop("value") * F.count("value")).alias("sst"))
    between = F.sum(F.col("n") * (F.col("m") - F.col("gm")) * (F.col("m") - F.col("gm")))
    return g.join(t, "column").groupBy("grouping", "column").agg(F.round(F.coalesce(F.try_divide(between, F.max("sst")), F.lit(0.0)), 6).alias("eta_squared"))


_LABELS_SQL = "l AS (SELECT year(timestamp) AS year, label, class FROM observations UNPIVOT (class FOR label IN (reef_health, restoration_suitability)))"


def _labels(spark, sf_dir):
    """(year, label, class): both labels of every row."""
    return _obs(spark, sf_dir).select(F.year("timestamp").alias("year"), *S.TARGET_COLUMNS).unpivot(["year"], S.TARGET_COLUMNS, "label", "class")


@register(
    "class_balance_by_year",
    f"""WITH {_LABELS_SQL}
    SELECT year, label, class, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY year, label), 6) AS share FROM l GROUP BY 1, 2, 3""",
)
def class_balance_by_year(spark, sf_dir):
    c = _labels(spark, sf_dir).groupBy("year", "label", "class").agg(F.count(F.lit(1)).alias("n"))
    tot = c.groupBy("year", "label").agg(F.sum("n").alias("_t"))
    return c.join(tot, ["year", "label"]).select("year", "label", "class", "n", F.round(F.col("n") / F.col("_t"), 6).alias("share"))


@register(
    "imbalance_entropy",
    f"""WITH {_LABELS_SQL}, c AS (SELECT label, class, count(*) AS n FROM l GROUP BY 1, 2), t AS (SELECT label, sum(n) AS total, count(*) AS k FROM c GROUP BY 1)
    SELECT label, round(max(n) / min(n), 6) AS max_min_ratio, round(-sum(n / total * log2(n / total)), 6) AS entropy_bits,
           round(-sum(n / total * log2(n / total)) / log2(max(k)), 6) AS normalised_entropy,
           round(max(n) / max(total), 6) AS majority_baseline FROM c JOIN t USING (label) GROUP BY label""",
)
def imbalance_entropy(spark, sf_dir):
    c = _labels(spark, sf_dir).groupBy("label", "class").agg(F.count(F.lit(1)).alias("n"))
    t = c.groupBy("label").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("k"))
    p = F.col("n") / F.col("total")
    return c.join(t, "label").groupBy("label").agg(
        F.round(F.max("n") / F.min("n"), 6).alias("max_min_ratio"),
        F.round(-F.sum(p * F.log2(p)), 6).alias("entropy_bits"),
        F.round(F.coalesce(F.try_divide(-F.sum(p * F.log2(p)), F.log2(F.max("k"))), F.lit(0.0)), 6).alias("normalised_entropy"),
        F.round(F.max("n") / F.max("total"), 6).alias("majority_baseline"),
    )


@register(
    "target_crosstab",
    "SELECT reef_health, " + ", ".join(
        f"CAST(count(*) FILTER (WHERE restoration_suitability = {V.q(c)}) AS BIGINT) AS {c}" for c in S.RESTORATION_CLASSES
    ) + " FROM observations GROUP BY 1",
)
def target_crosstab(spark, sf_dir):
    return _obs(spark, sf_dir).groupBy("reef_health").pivot("restoration_suitability", S.RESTORATION_CLASSES).agg(
        F.count(F.lit(1))
    ).na.fill(0, S.RESTORATION_CLASSES)


_PROFILE_COLS = S.SENSOR_COLUMNS


@register(
    "feature_profile",
    """WITH l AS (SELECT "column", value FROM observations UNPIVOT (value FOR "column" IN ("""
    + ", ".join(_PROFILE_COLS)
    + """))),
    q AS (SELECT "column", min(value) AS min, quantile_cont(value, 0.01) AS p01, quantile_cont(value, 0.25) AS p25,
                 quantile_cont(value, 0.5) AS median, avg(value) AS mean, quantile_cont(value, 0.75) AS p75,
                 quantile_cont(value, 0.95) AS p95, quantile_cont(value, 0.99) AS p99, max(value) AS max,
                 stddev_pop(value) AS std, skewness(value) AS skew FROM l GROUP BY 1)
    SELECT q."column", min, round(p01, 6) AS p01, round(p25, 6) AS p25, round(median, 6) AS median, round(mean, 6) AS mean,
           round(p75, 6) AS p75, round(p95, 6) AS p95, round(p99, 6) AS p99, max, round(std, 6) AS std,
           round(p75 - p25, 6) AS iqr, round(skew, 4) AS skew,
           (SELECT count(*) FROM l WHERE l."column" = q."column" AND (l.value < q.p25 - 3 * (q.p75 - q.p25) OR l.value > q.p75 + 3 * (q.p75 - q.p25))) AS outliers_3iqr
    FROM q""",
)
def feature_profile(spark, sf_dir):
    """Per column moments, exact quantiles from counts of distinct values, then a
    second pass counting > 3 IQR outliers against the (one row per column) fences."""
    obs = _obs(spark, sf_dir)
    long = obs.select(*_PROFILE_COLS).unpivot([], _PROFILE_COLS, "column", "value")
    qs = {"p01": 0.01, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}
    moments = long.groupBy("column").agg(
        F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean"),
        F.stddev_pop("value").alias("std"), F.skewness("value").alias("g1"), F.count("value").alias("n"),
    )
    # the sample skewness, adjusted for the number of rows
    moments = moments.withColumn("skew", F.try_divide(F.col("g1") * F.sqrt(F.col("n") * (F.col("n") - 1)), F.col("n") - 2)).drop("g1", "n")
    q = moments.join(cut(O.exact_quantiles(obs, [], _PROFILE_COLS, qs), "quantiles"), "column")
    iqr = F.col("p75") - F.col("p25")
    fences = q.select("column", (F.col("p25") - 3 * iqr).alias("lo"), (F.col("p75") + 3 * iqr).alias("hi"))
    out = long.join(F.broadcast(fences), "column").groupBy("column").agg(
        F.sum(((F.col("value") < F.col("lo")) | (F.col("value") > F.col("hi"))).cast("long")).alias("outliers_3iqr")
    )
    return q.join(out, "column").select(
        "column", "min", *[F.round(n, 6).alias(n) for n in ["p01", "p25", "median", "mean", "p75", "p95", "p99"]], "max",
        F.round("std", 6).alias("std"), F.round(iqr, 6).alias("iqr"), F.round("skew", 4).alias("skew"), "outliers_3iqr",
    )


# the whole 21 x 21 triangle: sensor columns and the derived features
_ALL_PAIRS = list(itertools.combinations(S.NUMERIC_FEATURES, 2))
_FEATURES_SQL = f"f AS (SELECT obs_id, {', '.join(S.SENSOR_COLUMNS)}, {V.derived_select()} FROM observations)"


def _pair_rows_sql(source: str, value: str) -> str:
    """One row per pair from one aggregate row of `source`."""
    corrs = ", ".join(f"corr({a}, {b}) AS p{i}" for i, (a, b) in enumerate(_ALL_PAIRS))
    each = " UNION ALL ".join(f"SELECT {V.q(a)} AS col_a, {V.q(b)} AS col_b, p{i} AS r FROM m" for i, (a, b) in enumerate(_ALL_PAIRS))
    return f"m AS (SELECT {corrs} FROM {source}) SELECT col_a, col_b, round(r, 6) AS {value}, abs(r) > 0.8 AS strong FROM ({each})"


def _features(spark, sf_dir):
    from tidepool.operators.scalar import add_derived_features

    return add_derived_features(_obs(spark, sf_dir)).select("obs_id", *S.NUMERIC_FEATURES)


@register("pearson_matrix_features", f"WITH {_FEATURES_SQL}, {_pair_rows_sql('f', 'r')}")
def pearson_matrix_features(spark, sf_dir):
    """M15 over all 21 numeric features: 210 pairs from one pass, strong if abs r > 0.8."""
    return PR.correlation_pairs(_features(spark, sf_dir), S.NUMERIC_FEATURES, "r")


@register(
    "spearman_matrix_features",
    f"WITH {_FEATURES_SQL}, r AS (SELECT "
    + ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in S.NUMERIC_FEATURES)
    + f" FROM f), {_pair_rows_sql('r', 'rho')}",
)
def spearman_matrix_features(spark, sf_dir):
    """M16 over all 21 numeric features: average ranks from split value counts, then Pearson on ranks."""
    return PR.rank_correlation_pairs(_features(spark, sf_dir), S.NUMERIC_FEATURES, "rho")


_CLOSED_FORM_SQL = (
    """SELECT round(avg(CASE WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END), 6) AS exact_match,
       round(avg(CASE WHEN abs(t - p) <= 1 THEN 1.0 ELSE 0.0 END), 6) AS within_one_class
    FROM (SELECT y_true, y_pred, """
    + "CASE y_true " + " ".join(f"WHEN {V.q(c)} THEN {i}" for i, c in enumerate(S.HEALTH_CLASSES)) + " END AS t, "
    + "CASE y_pred " + " ".join(f"WHEN {V.q(c)} THEN {i}" for i, c in enumerate(S.HEALTH_CLASSES)) + " END AS p "
    + "FROM scored_health)"
)


@register(
    "single_column_baseline",
    """WITH c AS (SELECT region, reef_health, count(*) AS n, """
    + "CASE reef_health " + " ".join(f"WHEN {V.q(c)} THEN {i}" for i, c in enumerate(S.HEALTH_CLASSES)) + " END AS o"
    + """ FROM observations GROUP BY 1, 2),
    m AS (SELECT region, arg_max(reef_health, n * 1000000 - o) AS majority FROM c GROUP BY 1)
    SELECT region, majority FROM m""",
)
def single_column_baseline(spark, sf_dir):
    """Majority class per region (the region-only predictor)."""
    return PR.majority_by_group(_obs(spark, sf_dir), "region", "reef_health", S.HEALTH_CLASSES)



_ALL_OBS = ", ".join(S.OBSERVATION_COLUMNS[1:])


@register(
    "quality_checks",
    f"""WITH base AS (SELECT * FROM observations),
    n AS (SELECT count(*) AS rows FROM base),
    dup AS (SELECT coalesce(sum(c - 1), 0) AS duplicate_rows FROM (SELECT count(*) AS c FROM base GROUP BY {_ALL_OBS})),
    coord AS (SELECT coalesce(sum(c - 1), 0) AS duplicate_coordinates FROM (SELECT count(*) AS c FROM base GROUP BY latitude, longitude)),
    ts AS (SELECT coalesce(sum(c - 1), 0) AS duplicate_timestamps FROM (SELECT count(*) AS c FROM base GROUP BY timestamp)),
    nulls AS (SELECT {" + ".join(f"sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)" for c in S.OBSERVATION_COLUMNS)} AS null_cells FROM base),
    box AS (SELECT count(*) AS outside_bbox FROM base o JOIN region_bounds b ON o.region = b.region
            WHERE NOT (latitude BETWEEN lat_min AND lat_max AND longitude BETWEEN lon_min AND lon_max))
    SELECT rows, CAST(null_cells AS BIGINT) AS null_cells, CAST(duplicate_rows AS BIGINT) AS duplicate_rows,
           CAST(duplicate_coordinates AS BIGINT) AS duplicate_coordinates, CAST(duplicate_timestamps AS BIGINT) AS duplicate_timestamps,
           outside_bbox FROM n, nulls, dup, coord, ts, box""",
)
def quality_checks(spark, sf_dir):
    """Nulls, duplicate rows / coordinate pairs / timestamps, rows outside
    their region box: one aggregate pass plus three grouped duplicate counts."""
    from tidepool.operators import validate as VL

    obs = _obs(spark, sf_dir)

    def dups(*cols):
        return obs.groupBy(*cols).agg(F.count(F.lit(1)).alias("c")).agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).cast("long"))

    base = obs.agg(
        F.count(F.lit(1)).alias("rows"),
        sum((F.sum(F.col(c).isNull().cast("long")) for c in S.OBSERVATION_COLUMNS), F.lit(0)).cast("long").alias("null_cells"),
    )
    j = VL.join_region_bounds(spark, obs)
    inside = F.col("latitude").between(F.col("lat_min"), F.col("lat_max")) & F.col("longitude").between(F.col("lon_min"), F.col("lon_max"))
    box = j.filter(F.col("lat_min").isNotNull() & ~inside).agg(F.count(F.lit(1)).alias("outside_bbox"))
    return (
        base.crossJoin(dups(*S.OBSERVATION_COLUMNS[1:]).toDF("duplicate_rows"))
        .crossJoin(dups("latitude", "longitude").toDF("duplicate_coordinates"))
        .crossJoin(dups("timestamp").toDF("duplicate_timestamps"))
        .crossJoin(box)
    )


@register(
    "time_gap_profile",
    """WITH d AS (SELECT DISTINCT CAST(timestamp AS DATE) AS day FROM observations),
    g AS (SELECT day, datediff('day', lag(day) OVER (ORDER BY day), day) AS gap FROM d)
    SELECT min(day) AS first_day, max(day) AS last_day, datediff('day', min(day), max(day)) AS span_days,
           quantile_cont(gap, 0.5) AS median_gap_days, max(gap) AS max_gap_days,
           CAST(sum(CASE WHEN gap > 1 THEN 1 ELSE 0 END) AS BIGINT) AS gaps_over_24h FROM g""",
)
def time_gap_profile(spark, sf_dir):
    """Span, median / max gap and gaps over 24 h between observation days.
    Rows collapse to distinct days first; the ordered window then runs over
    the day axis (one row per calendar day, thousands per century)."""
    from pyspark.sql import Window

    d = _obs(spark, sf_dir).select(F.to_date("timestamp").alias("day")).distinct()
    g = d.withColumn("gap", F.datediff(F.col("day"), F.lag("day").over(Window.orderBy("day"))))
    return g.agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"),
        F.datediff(F.max("day"), F.min("day")).alias("span_days"),
        F.percentile("gap", 0.5).alias("median_gap_days"), F.max("gap").alias("max_gap_days"),
        F.sum((F.col("gap") > 1).cast("long")).alias("gaps_over_24h"),
    )


_MI_COLS = S.SENSOR_COLUMNS


_MI_SQL = (
    """WITH l AS (SELECT reef_health AS y, "column", value FROM observations UNPIVOT (value FOR "column" IN ("""
    + ", ".join(_MI_COLS)
    + """))),
    r AS (SELECT "column", min(value) AS lo, max(value) AS hi FROM l GROUP BY 1),
    b AS (SELECT l."column", y, CAST(least(9, greatest(0, floor((value - lo) / ((CASE WHEN hi <= lo THEN lo + 1.0 ELSE hi END - lo) / 10)))) AS INTEGER) AS bin
          FROM l JOIN r ON l."column" = r."column"),
    j AS (SELECT "column", bin, y, count(*) AS n FROM b GROUP BY 1, 2, 3),
    t AS (SELECT "column", sum(n) AS total FROM j GROUP BY 1),
    px AS (SELECT "column", bin, sum(n) AS nx FROM j GROUP BY 1, 2),
    py AS (SELECT "column", y, sum(n) AS ny FROM j GROUP BY 1, 2),
    h AS (SELECT "column", -sum(ny / total * log2(ny / total)) AS hy FROM py JOIN t USING ("column") GROUP BY 1),
    mi AS (SELECT j."column", sum(n / total * log2((n * total) / (nx * ny))) AS mi
           FROM j JOIN t USING ("column") JOIN px USING ("column", bin) JOIN py USING ("column", y) GROUP BY 1)
    SELECT mi."column", round(mi, 6) AS mutual_information_bits, round(100 * mi / hy, 4) AS pct_of_label_entropy
    FROM mi JOIN h USING ("column")"""
)


def _binned_counts(rows, labels):
    """(task, column, bin, y, n): counts of ten equal bins of every sensor by each task's label.

    Two passes over the rows as they are: the columns' bounds, then counts by
    column, bin and all labels together, which are few and serve every task.
    """
    r = rows.agg(*[f(c).alias(f"{k}_{c}") for c in _MI_COLS for k, f in (("lo", F.min), ("hi", F.max))]).first()
    codes = []
    for i, c in enumerate(_MI_COLS):
        lo, hi = F.lit(r[f"lo_{c}"]).cast("double"), F.lit(r[f"hi_{c}"]).cast("double")
        hi = F.when(hi <= lo, lo + 1.0).otherwise(hi)
        bin_ = F.least(F.lit(9), F.greatest(F.lit(0), F.floor((F.col(c).cast("double") - lo) / ((hi - lo) / 10)))).cast("int")
        codes.append(F.lit(10 * i) + bin_)
    n = rows.select(*labels.values(), F.explode(F.array(*codes)).alias("code")).groupBy(*labels.values(), "code").agg(F.count(F.lit(1)).alias("n"))
    names = F.array(*map(F.lit, _MI_COLS))
    each = F.explode(F.array(*[F.struct(F.lit(t).alias("task"), F.col(c).alias("y")) for t, c in labels.items()])).alias("l")
    few = n.select(each, F.element_at(names, F.floor(F.col("code") / 10).cast("int") + 1).alias("column"), (F.col("code") % 10).alias("bin"), "n")
    return few.groupBy("l.task", "column", "bin", "l.y").agg(F.sum("n").alias("n"))


def _mutual_information(j, keys):
    t = j.groupBy(*keys).agg(F.sum("n").alias("total"))
    px = j.groupBy(*keys, "bin").agg(F.sum("n").alias("nx"))
    py = j.groupBy(*keys, "y").agg(F.sum("n").alias("ny"))
    hy = py.join(t, keys).groupBy(*keys).agg(
        (-F.sum(F.col("ny") / F.col("total") * F.log2(F.col("ny") / F.col("total")))).alias("hy")
    )
    mi = (
        j.join(t, keys).join(px, [*keys, "bin"]).join(py, [*keys, "y"])
        .groupBy(*keys)
        .agg(F.sum(F.col("n") / F.col("total") * F.log2((F.col("n") * F.col("total")) / (F.col("nx") * F.col("ny")))).alias("mi"))
    )
    return mi.join(hy, keys).select(
        *keys, F.round("mi", 6).alias("mutual_information_bits"), F.round(100 * F.col("mi") / F.col("hy"), 4).alias("pct_of_label_entropy")
    )


# both labels
@register("closed_form_benchmark_by_task", both_tasks_sql(lambda t: _for_task(_CLOSED_FORM_SQL, t)))
def closed_form_benchmark_by_task(spark, sf_dir):
    from tidepool.functions.columns import ordinal_map

    om = {t: ordinal_map(c) for t, c in S.TASK_CLASSES.items()}
    far = F.coalesce(*[F.when(F.col("task") == t, F.abs(m[F.col("y_true")] - m[F.col("y_pred")])) for t, m in om.items()])
    return X.scored_tasks(spark, sf_dir).groupBy("task").agg(
        F.round(F.avg((F.col("y_true") == F.col("y_pred")).cast("double")), 6).alias("exact_match"),
        F.round(F.avg((far <= 1).cast("double")), 6).alias("within_one_class"),
    )


@register("mutual_information_by_task", both_tasks_sql(lambda t: _MI_SQL.replace("reef_health", S.TASK_TARGET[t])))
def mutual_information_by_task(spark, sf_dir):
    """mutual_information of each feature with both labels, from one count of rows by bin and labels."""
    return _mutual_information(_binned_counts(_obs(spark, sf_dir), S.TASK_TARGET), ["task", "column"])


@register(
    "ks_uniform",
    """WITH c AS (SELECT region, 'latitude' AS axis, latitude AS v, count(*) AS n FROM observations GROUP BY ALL
               UNION ALL SELECT region, 'longitude', longitude, count(*) FROM observations GROUP BY ALL),
    e AS (SELECT c.region, axis, v, n, sum(n) OVER (PARTITION BY c.region, axis ORDER BY v ROWS UNBOUNDED PRECEDING) AS cum,
                 sum(n) OVER (PARTITION BY c.region, axis) AS total,
                 CASE axis WHEN 'latitude' THEN (v - b.lat_min) / (b.lat_max - b.lat_min) ELSE (v - b.lon_min) / (b.lon_max - b.lon_min) END AS u
          FROM c JOIN region_bounds b ON c.region = b.region)
    SELECT region, axis, round(max(greatest(cum / total - u, u - (cum - n) / total)), 6) AS ks_statistic,
           CAST(max(total) AS BIGINT) AS n
    FROM e GROUP BY region, axis""",
)
def ks_uniform(spark, sf_dir):
    """One-sample KS of latitude and longitude against the uniform distribution
    on the region's box: distinct values, prefix counts, then
    D = max(F_n(v) - U(v), U(v) - F_n(v-))."""
    from tidepool.operators.validate import join_region_bounds

    long = _obs(spark, sf_dir).select("region", "latitude", "longitude").unpivot(["region"], ["latitude", "longitude"], "axis", "v")
    c = long.groupBy("region", "axis", "v").agg(F.count(F.lit(1)).alias("n"))
    pre = O.value_prefix(c, ["region", "axis"], "v", ["n"])
    tot = pre.groupBy("region", "axis").agg(F.max("cum_n").alias("total"))
    e = join_region_bounds(spark, pre.join(tot, ["region", "axis"]))
    low, high = (F.when(F.col("axis") == "latitude", F.col(f"lat_{x}")).otherwise(F.col(f"lon_{x}")) for x in ("min", "max"))
    u = (F.col("v") - low) / (high - low)
    d = F.greatest(F.col("cum_n") / F.col("total") - u, u - (F.col("cum_n") - F.col("n")) / F.col("total"))
    return e.groupBy("region", "axis").agg(F.round(F.max(d), 6).alias("ks_statistic"), F.max("total").cast("long").alias("n"))


also("implausible_rows", "implausible_rows_all")
for _name in ("pearson_matrix", "spearman_matrix"):
    also(_name, f"{_name}_features")
for _name in ("closed_form_benchmark", "mutual_information"):
    also(_name, f"{_name}_by_task")
