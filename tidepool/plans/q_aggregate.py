"""Group E queries: aggregations over ``observations`` and its variants."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool import schema as S
from tidepool.operators import aggregate as A
from tidepool.plans import sqlviews as V
from tidepool.plans.registry import register
from tidepool.sources import fixtures as X


def _obs(spark, sf_dir):
    return X.observations(spark, sf_dir)


def _dim_sql(classes, name="class") -> str:
    rows = ", ".join(f"({i}, {V.q(c)})" for i, c in enumerate(classes))
    return f"(SELECT * FROM (VALUES {rows}) t(class_order, {name}))"


def _pct1_sql(n: str, total: str) -> str:
    return f"(floor((2000 * {n} + {total}) / (2 * {total})) / 10.0)"


def _counts_sql(label: str, classes) -> str:
    return f"""SELECT {V.q(label)} AS label, d.class_order, d.class, CAST(coalesce(c.n, 0) AS BIGINT) AS n
    FROM {_dim_sql(classes)} d LEFT JOIN (SELECT {label} AS class, count(*) AS n FROM observations GROUP BY 1) c
    ON d.class = c.class"""


@register(
    "class_counts",
    _counts_sql("reef_health", S.HEALTH_CLASSES) + " UNION ALL " + _counts_sql("restoration_suitability", S.RESTORATION_CLASSES),
)
def class_counts(spark, sf_dir):
    df = _obs(spark, sf_dir)
    parts = []
    for label, classes in (("reef_health", S.HEALTH_CLASSES), ("restoration_suitability", S.RESTORATION_CLASSES)):
        c = A.class_counts(spark, df, label, classes).withColumnRenamed(label, "class")
        parts.append(c.select(F.lit(label).alias("label"), "class_order", "class", F.col("n").cast("long")))
    return parts[0].unionByName(parts[1])


def _shares_sql(label, classes):
    return f"""SELECT {V.q(label)} AS label, class_order, class, n, {_pct1_sql('n', 'total')} AS pct FROM
      ({_counts_sql(label, classes)}) x CROSS JOIN (SELECT count(*) AS total FROM observations) t"""


@register(
    "class_shares",
    _shares_sql("reef_health", S.HEALTH_CLASSES)
    + " UNION ALL "
    + _shares_sql("restoration_suitability", S.RESTORATION_CLASSES),
)
def class_shares(spark, sf_dir):
    df = _obs(spark, sf_dir)
    parts = []
    for label, classes in (("reef_health", S.HEALTH_CLASSES), ("restoration_suitability", S.RESTORATION_CLASSES)):
        c = A.class_shares(spark, df, label, classes).withColumnRenamed(label, "class")
        parts.append(c.select(F.lit(label).alias("label"), "class_order", "class", F.col("n").cast("long"), "pct"))
    return parts[0].unionByName(parts[1])


@register(
    "dataset_cardinalities",
    """SELECT count(*) AS rows, count(DISTINCT region) AS regions, count(DISTINCT reef_health) AS health_classes,
       count(DISTINCT restoration_suitability) AS restoration_classes,
       CAST(count(*) - ceil(count(*) * 0.2) AS BIGINT) AS train_rows, CAST(ceil(count(*) * 0.2) AS BIGINT) AS test_rows
    FROM observations""",
)
def dataset_cardinalities(spark, sf_dir):
    df = _obs(spark, sf_dir)
    n = F.count(F.lit(1))
    test = F.ceil(n * 0.2).cast("long")
    return df.agg(
        n.alias("rows"),
        F.countDistinct("region").alias("regions"),
        F.countDistinct("reef_health").alias("health_classes"),
        F.countDistinct("restoration_suitability").alias("restoration_classes"),
        (n - test).cast("long").alias("train_rows"),
        test.alias("test_rows"),
    )


def _pivot_sql(col, values):
    sums = ", ".join(f"CAST(count(*) FILTER (WHERE {col} = {V.q(v)}) AS BIGINT) AS {v}" for v in values)
    return f"SELECT region, {sums} FROM observations GROUP BY region"


@register("region_health_contingency", _pivot_sql("reef_health", S.HEALTH_CLASSES))
def region_health_contingency(spark, sf_dir):
    return A.contingency(_obs(spark, sf_dir), "region", "reef_health", S.HEALTH_CLASSES)


@register("region_restoration_contingency", _pivot_sql("restoration_suitability", S.RESTORATION_CLASSES))
def region_restoration_contingency(spark, sf_dir):
    return A.contingency(_obs(spark, sf_dir), "region", "restoration_suitability", S.RESTORATION_CLASSES)


@register(
    "region_summary",
    f"""SELECT region, count(reef_health) AS observations,
       {_pct1_sql("sum(CASE WHEN reef_health = 'healthy' THEN 1 ELSE 0 END)", "count(reef_health)")} AS healthy_pct,
       {_pct1_sql("sum(CASE WHEN restoration_suitability = 'suitable' THEN 1 ELSE 0 END)", "count(restoration_suitability)")} AS suitable_pct
    FROM observations GROUP BY region""",
)
def region_summary(spark, sf_dir):
    return A.region_summary(_obs(spark, sf_dir))


_MEAN_COLS = [
    "water_temperature_c",
    "ph",
    "dissolved_oxygen_mg_l",
    "coral_cover_percentage",
    "bleaching_percentage",
    "sonar_backscatter",
    "rugosity_index",
]


@register(
    "health_feature_means",
    "SELECT reef_health, " + ", ".join(f"round(avg({c}), 3) AS {c}" for c in _MEAN_COLS) + " FROM observations GROUP BY reef_health",
)
def health_feature_means(spark, sf_dir):
    return A.group_means(_obs(spark, sf_dir), "reef_health", _MEAN_COLS, 3)


def _surface_sql(xcol, xbins, ycol, ybins, value_sql, out):
    def idx(c, lo, hi, n):
        return f"least({n - 1}, CAST(greatest(0, ceil(({c} - {lo}) / (({hi} - {lo}) / {n})) - 1) AS INTEGER))"

    def mid(i, lo, hi, n):
        w = f"(({hi} - {lo}) / {n})"
        left = f"(CASE WHEN {i} = 0 THEN {lo} - ({hi} - {lo}) * 0.001 ELSE {lo} + {i} * {w} END)"
        return f"round(({left} + {lo} + ({i} + 1) * {w}) / 2, 1)"

    return f"""WITH r AS (SELECT min({xcol}) AS xlo, max({xcol}) AS xhi, min({ycol}) AS ylo, max({ycol}) AS yhi FROM observations),
    c AS (SELECT {idx(xcol, 'xlo', 'xhi', xbins)} AS x_bin, {idx(ycol, 'ylo', 'yhi', ybins)} AS y_bin,
                 count({value_sql}) AS n, avg({value_sql}) AS m
          FROM observations, r GROUP BY 1, 2),
    g AS (SELECT CAST(a.i AS INTEGER) AS x_bin, CAST(b.i AS INTEGER) AS y_bin, r.*
          FROM range({xbins}) a(i), range({ybins}) b(i), r)
    SELECT g.x_bin, g.y_bin, {mid('g.x_bin', 'xlo', 'xhi', xbins)} AS x_mid, {mid('g.y_bin', 'ylo', 'yhi', ybins)} AS y_mid,
           CAST(coalesce(c.n, 0) AS BIGINT) AS n, CASE WHEN coalesce(c.n, 0) >= 5 THEN round(c.m, 6) END AS {out}
    FROM g LEFT JOIN c ON g.x_bin = c.x_bin AND g.y_bin = c.y_bin"""


@register(
    "bleaching_surface",
    _surface_sql("depth_m", 10, "water_temperature_c", 12, "bleaching_percentage", "mean_bleaching"),
)
def bleaching_surface(spark, sf_dir):
    return A.binned_surface(
        spark, _obs(spark, sf_dir), "depth_m", 10, "water_temperature_c", 12, F.col("bleaching_percentage"), "mean_bleaching"
    )


@register(
    "suitability_surface",
    _surface_sql(
        "depth_m",
        10,
        "hard_substrate_percentage",
        12,
        "CASE WHEN restoration_suitability = 'suitable' THEN 1.0 ELSE 0.0 END",
        "share_suitable",
    ),
)
def suitability_surface(spark, sf_dir):
    v = F.when(F.col("restoration_suitability") == "suitable", 1.0).otherwise(0.0)
    return A.binned_surface(spark, _obs(spark, sf_dir), "depth_m", 10, "hard_substrate_percentage", 12, v, "share_suitable")


@register(
    "equal_width_cut",
    """WITH r AS (SELECT min(water_temperature_c) AS lo, max(water_temperature_c) AS hi FROM observations),
    b AS (SELECT obs_id, least(9, CAST(greatest(0, ceil((water_temperature_c - lo) / ((hi - lo) / 10)) - 1) AS INTEGER)) AS temp_bin, lo, hi
          FROM observations, r)
    SELECT obs_id, temp_bin,
      round(((CASE WHEN temp_bin = 0 THEN lo - (hi - lo) * 0.001 ELSE lo + temp_bin * ((hi - lo) / 10) END)
              + lo + (temp_bin + 1) * ((hi - lo) / 10)) / 2, 1) AS temp_mid
    FROM b""",
)
def equal_width_cut(spark, sf_dir):
    df = _obs(spark, sf_dir)
    r = F.broadcast(df.agg(F.min("water_temperature_c").alias("lo"), F.max("water_temperature_c").alias("hi")))
    idx, _ = A.cut_right_closed(F.col("water_temperature_c"), F.col("lo"), F.col("hi"), 10)
    b = df.crossJoin(r).select("obs_id", idx.alias("temp_bin"), "lo", "hi")
    w = (F.col("hi") - F.col("lo")) / 10
    left = F.when(F.col("temp_bin") == 0, F.col("lo") - (F.col("hi") - F.col("lo")) * 0.001).otherwise(
        F.col("lo") + F.col("temp_bin") * w
    )
    return b.select("obs_id", "temp_bin", F.round((left + F.col("lo") + (F.col("temp_bin") + 1) * w) / 2, 1).alias("temp_mid"))


def _hist_sql(src: str, col: str, bins: int) -> str:
    return f"""WITH d AS (SELECT {col} AS x FROM {src} WHERE {col} IS NOT NULL AND isfinite({col})),
    s AS (SELECT lo, CASE WHEN hi0 <= lo THEN lo + 1.0 ELSE hi0 END AS hi FROM (SELECT CAST(min(x) AS DOUBLE) AS lo, CAST(max(x) AS DOUBLE) AS hi0 FROM d)),
    w AS (SELECT lo, hi, (hi - lo) / {bins} AS width FROM s),
    c AS (SELECT CAST(least({bins - 1}, greatest(0, floor((x - lo) / width))) AS INTEGER) AS bin, count(*) AS n FROM d, w GROUP BY 1)
    SELECT CAST(a.i AS INTEGER) AS bin, round(lo + width * (a.i + 0.5), 6) AS centre, CAST(coalesce(c.n, 0) AS BIGINT) AS count,
           round(width, 6) AS width
    FROM range({bins}) a(i) CROSS JOIN w LEFT JOIN c ON c.bin = a.i"""


@register("histogram", _hist_sql("observations", "water_temperature_c", 26))
def histogram(spark, sf_dir):
    return A.histogram(spark, _obs(spark, sf_dir), "water_temperature_c", 26)


@register(
    "grouped_histogram",
    f"""WITH d AS (SELECT reef_health AS grp, coral_cover_percentage AS x FROM observations
                  WHERE coral_cover_percentage IS NOT NULL AND isfinite(coral_cover_percentage)),
    s AS (SELECT lo, CASE WHEN hi0 <= lo THEN lo + 1.0 ELSE hi0 END AS hi FROM (SELECT min(x) AS lo, max(x) AS hi0 FROM d)),
    w AS (SELECT lo, hi, (hi - lo) / 30 AS width FROM s),
    c AS (SELECT grp, CAST(least(29, greatest(0, floor((x - lo) / width))) AS INTEGER) AS bin, count(*) AS n FROM d, w GROUP BY 1, 2),
    g AS (SELECT DISTINCT grp FROM d),
    full_ AS (SELECT g.grp, CAST(a.i AS INTEGER) AS bin, round(lo + width * (a.i + 0.5), 6) AS centre,
                     CAST(coalesce(c.n, 0) AS BIGINT) AS count
              FROM g CROSS JOIN range(30) a(i) CROSS JOIN w LEFT JOIN c ON c.grp = g.grp AND c.bin = a.i)
    SELECT grp AS reef_health, bin, centre, count,
           max(count) OVER (PARTITION BY grp) AS group_peak, CAST(sum(count) OVER (PARTITION BY grp) AS BIGINT) AS group_total,
           max(count) OVER () AS global_peak
    FROM full_""",
)
def grouped_histogram(spark, sf_dir):
    return A.grouped_histogram(spark, _obs(spark, sf_dir), "reef_health", "coral_cover_percentage", 30)


@register(
    "median_by_class",
    """SELECT reef_health, count(coral_cover_percentage) AS n,
       round(quantile_cont(coral_cover_percentage, 0.5), 6) AS median_cover,
       round(quantile_cont(coral_cover_percentage, 0.25), 6) AS q25_cover,
       round(quantile_cont(bleaching_percentage, 0.5), 6) AS median_bleaching
    FROM observations WHERE isfinite(coral_cover_percentage) GROUP BY reef_health""",
)
def median_by_class(spark, sf_dir):
    return A.quantiles_by_group(
        _obs(spark, sf_dir),
        "reef_health",
        {"median_cover": ("coral_cover_percentage", 0.5), "q25_cover": ("coral_cover_percentage", 0.25),
         "median_bleaching": ("bleaching_percentage", 0.5)},
        count_col="coral_cover_percentage",
    )


@register(
    "nonfinite_cells",
    "SELECT "
    + ", ".join(f"CAST(sum(CASE WHEN {c} IS NULL OR NOT isfinite({c}) THEN 1 ELSE 0 END) AS BIGINT) AS {c}" for c in S.SENSOR_COLUMNS)
    + ", CAST("
    + " + ".join(f"sum(CASE WHEN {c} IS NULL OR NOT isfinite({c}) THEN 1 ELSE 0 END)" for c in S.SENSOR_COLUMNS)
    + " AS BIGINT) AS total_nonfinite FROM observations_dirty",
)
def nonfinite_cells(spark, sf_dir):
    return A.nonfinite_cells(X.observations_dirty(spark, sf_dir), S.SENSOR_COLUMNS)


_DIRTY_COLS = S.OBSERVATION_COLUMNS + ["depth_text"]


@register(
    "duplicate_rows",
    f"""SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows,
       sum(n - 1) > sum(n) * 0.5 AS duplicate_share_gt_half
    FROM (SELECT count(*) AS n FROM observations_dirty GROUP BY {', '.join(_DIRTY_COLS)})""",
)
def duplicate_rows(spark, sf_dir):
    return A.duplicate_rows(X.observations_dirty(spark, sf_dir).select(*_DIRTY_COLS))


@register(
    "value_range_stats",
    "WITH s AS ("
    + _surface_sql("depth_m", 10, "water_temperature_c", 12, "bleaching_percentage", "mean_bleaching")
    + """) SELECT coalesce(min(mean_bleaching), 0.0) AS zmin,
       CASE WHEN coalesce(max(mean_bleaching), 1.0) <= coalesce(min(mean_bleaching), 0.0)
            THEN coalesce(min(mean_bleaching), 0.0) + 1.0 ELSE coalesce(max(mean_bleaching), 1.0) END AS zmax,
       count(mean_bleaching) AS finite_cells
    FROM s""",
)
def value_range_stats(spark, sf_dir):
    s = bleaching_surface(spark, sf_dir)
    return A.value_range(s, "mean_bleaching")


@register(
    "prediction_distribution",
    f"""WITH c AS (SELECT predicted_class AS class, count(*) AS n FROM predictions_health GROUP BY 1),
    t AS (SELECT count(*) AS total FROM predictions_health)
    SELECT d.class_order, d.class, CAST(coalesce(c.n, 0) AS BIGINT) AS n,
           floor((20000 * coalesce(c.n, 0) + total) / (2 * total)) / 10000.0 AS share
    FROM {_dim_sql(S.HEALTH_CLASSES)} d LEFT JOIN c ON d.class = c.class CROSS JOIN t""",
)
def prediction_distribution(spark, sf_dir):
    p = X.predictions(spark, sf_dir, "health")
    return A.label_distribution(spark, p, "predicted_class", S.HEALTH_CLASSES)
