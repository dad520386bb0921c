"""Grid queries: daily product cells (events), history series (orders), rasters (part)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidepool.operators import grid as G
from tidepool.operators import ordered as O
from tidepool.plans.registry import register
from tidepool.sources import fixtures as X
from tidepool.sources import io as IO

KEYS = ["product", "region"]
CELL_T = ["product", "time", "lat_idx", "lon_idx"]


def _g(spark, sf_dir, source="a"):
    return X.grid_daily(spark, sf_dir, source)


@register(
    "scan_grid_daily",
    "SELECT product, region, time, lat_idx, lon_idx, lat, lon, "
    "CASE WHEN value IS NULL OR isnan(value) OR value = -327.68 THEN NULL ELSE value END AS value FROM grid_daily_b",
)
def scan_grid_daily(spark, sf_dir):
    return G.normalise_values(_g(spark, sf_dir, "b"))


@register("scan_grid_elevation", "SELECT * FROM grid_elevation")
def scan_grid_elevation(spark, sf_dir):
    return X.grid_elevation(spark, sf_dir)


@register(
    "depth_from_elevation",
    "SELECT region, lat_idx, lon_idx, elevation, CASE WHEN elevation < 0 THEN -elevation END AS depth_m FROM grid_elevation",
)
def depth_from_elevation(spark, sf_dir):
    e = X.grid_elevation(spark, sf_dir)
    return e.select("region", "lat_idx", "lon_idx", "elevation", F.when(F.col("elevation") < 0, -F.col("elevation")).alias("depth_m"))


# --- fixed values: plausible range per product (min, max) --------------------
PLAUSIBLE = {"click": (0.0, 400.0), "error": (0.0, 400.0), "purchase": (0.0, 400.0), "signup": (0.0, 400.0), "view": (0.0, 400.0)}


@register(
    "grid_range_check",
    """WITH s AS (SELECT product, region, min(value) AS vmin, max(value) AS vmax FROM grid_daily GROUP BY 1, 2)
    SELECT product, region, round(vmin, 6) AS vmin, round(vmax, 6) AS vmax, vmin >= 0.0 AND vmax <= 400.0 AS ok,
           concat_ws(',', CASE WHEN vmin < 0.0 THEN 'below_min' END, CASE WHEN vmax > 400.0 THEN 'above_max' END) AS problems
    FROM s""",
)
def grid_range_check(spark, sf_dir):
    s = _g(spark, sf_dir).groupBy(*KEYS).agg(F.min("value").alias("vmin"), F.max("value").alias("vmax"))
    bounds = spark.createDataFrame([(k, *v) for k, v in PLAUSIBLE.items()], "product string, lo double, hi double")
    j = s.join(F.broadcast(bounds), "product", "left")
    return j.select(
        *KEYS,
        F.round("vmin", 6).alias("vmin"),
        F.round("vmax", 6).alias("vmax"),
        ((F.col("vmin") >= F.col("lo")) & (F.col("vmax") <= F.col("hi"))).alias("ok"),
        F.concat_ws(",", F.when(F.col("vmin") < F.col("lo"), "below_min"), F.when(F.col("vmax") > F.col("hi"), "above_max")).alias(
            "problems"
        ),
    )


@register(
    "grid_cross_check",
    """WITH j AS (SELECT a.value AS va, b.value AS vb FROM grid_daily a FULL OUTER JOIN grid_daily_b b
          ON a.product = b.product AND a.time = b.time AND a.lat_idx = b.lat_idx AND a.lon_idx = b.lon_idx)
    SELECT count(*) AS cells, CAST(sum(CASE WHEN va IS NOT NULL AND vb IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS both_valid,
           round(coalesce(max(CASE WHEN va IS NOT NULL AND vb IS NOT NULL THEN abs(va - vb) END), 0.0), 9) AS max_abs_diff,
           CAST(sum(CASE WHEN (va IS NULL) <> (vb IS NULL) THEN 1 ELSE 0 END) AS BIGINT) AS mask_mismatches,
           CAST(sum(CASE WHEN va IS NULL AND vb IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS both_missing,
           round(coalesce(max(CASE WHEN va IS NOT NULL AND vb IS NOT NULL THEN abs(va - vb) END), 0.0), 9) <= 1e-5 AS within_tolerance
    FROM j""",
)
def grid_cross_check(spark, sf_dir):
    return G.cross_check(_g(spark, sf_dir, "a"), _g(spark, sf_dir, "b"), CELL_T)


@register(
    "join_grid_masks",
    """SELECT product, count(*) AS both_valid_cells FROM grid_daily a
    WHERE value IS NOT NULL AND EXISTS (SELECT 1 FROM grid_daily_b b WHERE b.value IS NOT NULL AND a.product = b.product
          AND a.time = b.time AND a.lat_idx = b.lat_idx AND a.lon_idx = b.lon_idx) GROUP BY product""",
)
def join_grid_masks(spark, sf_dir):
    a = _g(spark, sf_dir, "a").filter(F.col("value").isNotNull())
    b = _g(spark, sf_dir, "b").filter(F.col("value").isNotNull()).select(*CELL_T)
    return a.join(b, CELL_T, "left_semi").groupBy("product").agg(F.count(F.lit(1)).alias("both_valid_cells"))


@register(
    "grid_stats",
    """SELECT product, region, count(*) AS total, count(value) AS valid,
       round(100.0 * (count(*) - count(value)) / count(*), 6) AS nan_pct, round(min(value), 6) AS min, round(max(value), 6) AS max,
       round(avg(value), 6) AS mean, round(median(value), 6) AS median, round(stddev_pop(value), 6) AS std
    FROM grid_daily_b GROUP BY 1, 2""",
)
def grid_stats(spark, sf_dir):
    return G.grid_stats(IO.cut(_g(spark, sf_dir, "b"), "grid"), KEYS)


@register(
    "grid_bbox",
    """SELECT product, region, round(min(lat), 6) AS lat_min, round(max(lat), 6) AS lat_max, round(min(lon), 6) AS lon_min,
       round(max(lon), 6) AS lon_max, count(DISTINCT lat_idx) AS n_lat, count(DISTINCT lon_idx) AS n_lon, count(DISTINCT time) AS n_time
    FROM grid_daily GROUP BY 1, 2""",
)
def grid_bbox(spark, sf_dir):
    return _g(spark, sf_dir).groupBy(*KEYS).agg(
        F.round(F.min("lat"), 6).alias("lat_min"), F.round(F.max("lat"), 6).alias("lat_max"),
        F.round(F.min("lon"), 6).alias("lon_min"), F.round(F.max("lon"), 6).alias("lon_max"),
        F.countDistinct("lat_idx").alias("n_lat"), F.countDistinct("lon_idx").alias("n_lon"),
        F.countDistinct("time").alias("n_time"),
    )


@register(
    "marine_land_counts",
    """SELECT region, CAST(sum(CASE WHEN elevation < 0 THEN 1 ELSE 0 END) AS BIGINT) AS marine,
       CAST(sum(CASE WHEN elevation >= 0 THEN 1 ELSE 0 END) AS BIGINT) AS land,
       CAST(sum(CASE WHEN elevation IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nodata,
       round(100.0 * sum(CASE WHEN elevation < 0 THEN 1 ELSE 0 END) / count(*), 6) AS marine_pct,
       min(elevation) AS min_elevation, median(elevation) AS median_elevation, max(elevation) AS max_elevation
    FROM grid_elevation GROUP BY region""",
)
def marine_land_counts(spark, sf_dir):
    e = F.col("elevation")
    grid = X.grid_elevation(spark, sf_dir)
    median = O.exact_quantiles(grid, ["region"], ["elevation"], {"median_elevation": 0.5}).drop("column")
    return grid.groupBy("region").agg(
        F.sum((e < 0).cast("long")).alias("marine"),
        F.sum((e >= 0).cast("long")).alias("land"),
        F.sum(e.isNull().cast("long")).alias("nodata"),
        F.round(100.0 * F.sum((e < 0).cast("long")) / F.count(F.lit(1)), 6).alias("marine_pct"),
        F.min(e).alias("min_elevation"),
        F.max(e).alias("max_elevation"),
    ).join(median, "region", "left")


_BANDS = [("0_10", 0, 10), ("10_30", 10, 30), ("30_100", 30, 100), ("100_plus", 100, None)]


@register(
    "depth_bands",
    "SELECT region, "
    + ", ".join(
        f"round(coalesce(100.0 * sum(CASE WHEN -elevation >= {lo}" + (f" AND -elevation < {hi}" if hi else "")
        + f" THEN 1 ELSE 0 END) / nullif(count(*), 0), 0.0), 6) AS pct_{n}"
        for n, lo, hi in _BANDS
    )
    + " FROM grid_elevation WHERE elevation < 0 GROUP BY region",
)
def depth_bands(spark, sf_dir):
    e = X.grid_elevation(spark, sf_dir).filter(F.col("elevation") < 0).withColumn("d", -F.col("elevation"))
    aggs = []
    for n, lo, hi in _BANDS:
        cond = F.col("d") >= lo if hi is None else (F.col("d") >= lo) & (F.col("d") < hi)
        aggs.append(F.round(F.coalesce(100.0 * F.sum(cond.cast("long")) / F.count(F.lit(1)), F.lit(0.0)), 6).alias(f"pct_{n}"))
    return e.groupBy("region").agg(*aggs)


@register(
    "grid_missing_dates",
    """SELECT product, region, CAST(datediff('day', min(time), max(time)) + 1 AS INTEGER) AS expected_days,
       count(DISTINCT time) AS steps, datediff('day', min(time), max(time)) + 1 - count(DISTINCT time) AS missing_days
    FROM grid_daily GROUP BY 1, 2""",
)
def grid_missing_dates(spark, sf_dir):
    g = _g(spark, sf_dir)
    return g.groupBy(*KEYS).agg(
        (F.datediff(F.max("time"), F.min("time")) + 1).alias("expected_days"),
        F.countDistinct("time").alias("steps"),
    ).withColumn("missing_days", F.col("expected_days") - F.col("steps"))


@register(
    "time_step_gaps",
    """WITH d AS (SELECT DISTINCT region, time FROM grid_history),
    g AS (SELECT region, datediff('day', lag(time) OVER (PARTITION BY region ORDER BY time), time) AS gap FROM d)
    SELECT region, count(*) AS steps, quantile_cont(gap, 0.5) AS median_gap_days, max(gap) AS max_gap_days
    FROM g GROUP BY region""",
)
def time_step_gaps(spark, sf_dir):
    d = X.grid_history(spark, sf_dir).select("region", "time").distinct()
    w = Window.partitionBy("region").orderBy("time")
    g = d.withColumn("gap", F.datediff(F.col("time"), F.lag("time").over(w)))
    return g.groupBy("region").agg(
        F.count(F.lit(1)).alias("steps"), F.percentile("gap", 0.5).alias("median_gap_days"), F.max("gap").alias("max_gap_days")
    )


@register(
    "axis_step",
    """WITH a AS (SELECT DISTINCT 'lat' AS axis, lat_idx AS i, lat AS v FROM grid_elevation UNION SELECT DISTINCT 'lon', lon_idx, lon FROM grid_elevation),
    s AS (SELECT axis, v - lag(v) OVER (PARTITION BY axis ORDER BY i) AS step FROM a)
    SELECT axis, round(quantile_cont(abs(step), 0.5), 9) AS median_step, count(*) AS n, min(step) > 0 AS ascending FROM s GROUP BY axis""",
)
def axis_step(spark, sf_dir):
    """Median step of each axis and whether its values rise with its index. An
    axis has one value per grid line, so the window spans grid lines, not cells."""
    e = X.grid_elevation(spark, sf_dir)
    lines = None
    for axis in ("lat", "lon"):
        d = e.select(F.lit(axis).alias("axis"), F.col(f"{axis}_idx").alias("i"), F.col(axis).alias("v")).distinct()
        lines = d if lines is None else lines.unionByName(d)
    step = F.col("v") - F.lag("v").over(Window.partitionBy("axis").orderBy("i"))
    return lines.withColumn("step", step).groupBy("axis").agg(
        F.round(F.percentile(F.abs("step"), 0.5), 9).alias("median_step"),
        F.count(F.lit(1)).alias("n"),
        (F.min("step") > 0).alias("ascending"),
    )


@register(
    "monthly_climatology",
    """WITH d AS (SELECT region, time, avg(sst) AS sst FROM grid_history GROUP BY 1, 2),
    m AS (SELECT region, month(time) AS month, avg(sst) AS sst FROM d GROUP BY 1, 2)
    SELECT region, round(max(sst) - min(sst), 6) AS amplitude, arg_max(month, sst) AS warmest_month,
           round(max(sst), 6) AS warmest_sst FROM m GROUP BY region""",
)
def monthly_climatology(spark, sf_dir):
    d = X.grid_history(spark, sf_dir).groupBy("region", "time").agg(F.avg("sst").alias("sst"))
    m = d.groupBy("region", F.month("time").alias("month")).agg(F.avg("sst").alias("sst"))
    return m.groupBy("region").agg(
        F.round(F.max("sst") - F.min("sst"), 6).alias("amplitude"),
        F.max_by("month", "sst").alias("warmest_month"),
        F.round(F.max("sst"), 6).alias("warmest_sst"),
    )


@register(
    "annual_max",
    """WITH y AS (SELECT region, year(time) AS year, max(dhw) AS max_dhw FROM grid_history GROUP BY 1, 2)
    SELECT region, year, max_dhw, max_dhw = max(max_dhw) OVER (PARTITION BY region) AS peak_year FROM y""",
)
def annual_max(spark, sf_dir):
    y = X.grid_history(spark, sf_dir).groupBy("region", F.year("time").alias("year")).agg(F.max("dhw").alias("max_dhw"))
    return y.withColumn("peak_year", F.col("max_dhw") == F.max("max_dhw").over(Window.partitionBy("region")))


@register(
    "threshold_days",
    """WITH d AS (SELECT region, time, max(dhw) AS dhw, max(sst) AS sst FROM grid_history GROUP BY 1, 2)
    SELECT region, CAST(sum(CASE WHEN dhw >= 4 THEN 1 ELSE 0 END) AS BIGINT) AS days_dhw_ge_4,
           CAST(sum(CASE WHEN dhw >= 8 THEN 1 ELSE 0 END) AS BIGINT) AS days_dhw_ge_8,
           round(max(sst) - min(sst), 6) AS sst_range FROM d GROUP BY region""",
)
def threshold_days(spark, sf_dir):
    """Two-level: daily spatial max per region, then counts of days over thresholds."""
    d = X.grid_history(spark, sf_dir).groupBy("region", "time").agg(F.max("dhw").alias("dhw"), F.max("sst").alias("sst"))
    return d.groupBy("region").agg(
        F.sum((F.col("dhw") >= 4).cast("long")).alias("days_dhw_ge_4"),
        F.sum((F.col("dhw") >= 8).cast("long")).alias("days_dhw_ge_8"),
        F.round(F.max("sst") - F.min("sst"), 6).alias("sst_range"),
    )


@register(
    "series_similarity",
    """WITH d AS (SELECT region, time, avg(sst) AS v FROM grid_history GROUP BY 1, 2)
    SELECT a.region AS region_a, b.region AS region_b, round(corr(a.v, b.v), 6) AS r, count(*) AS days,
           bool_and(a.v = b.v) AS identical
    FROM d a JOIN d b ON a.time = b.time AND a.region < b.region GROUP BY 1, 2""",
)
def series_similarity(spark, sf_dir):
    """Pairwise correlation of regional daily means: a self-join on the day of
    the (regions x days) mean table -- per day at most regions^2 pairs."""
    d = X.grid_history(spark, sf_dir).groupBy("region", "time").agg(F.avg("sst").alias("v"))
    a = d.select(F.col("region").alias("region_a"), "time", F.col("v").alias("va"))
    b = d.select(F.col("region").alias("region_b"), "time", F.col("v").alias("vb"))
    j = a.join(b, "time").filter(F.col("region_a") < F.col("region_b"))
    return j.groupBy("region_a", "region_b").agg(
        F.round(F.corr("va", "vb"), 6).alias("r"), F.count(F.lit(1)).alias("days"),
        F.bool_and(F.col("va") == F.col("vb")).alias("identical"),
    )


@register(
    "real_vs_table_ranges",
    """WITH g AS (SELECT region, min(sst) AS gmin, round(avg(sst), 6) AS gmean, max(sst) AS gmax, round(var_pop(sst), 6) AS gvar
                  FROM grid_history GROUP BY 1),
         o AS (SELECT region, min(water_temperature_c) AS omin, round(avg(water_temperature_c), 6) AS omean,
                      max(water_temperature_c) AS omax, round(var_pop(water_temperature_c), 6) AS ovar FROM observations GROUP BY 1),
         above AS (SELECT o.region, count(*) AS rows_above FROM observations o JOIN g ON o.region = g.region
                   WHERE o.water_temperature_c > g.gmax GROUP BY 1)
    SELECT g.region, gmin, gmean, gmax, gvar, omin, omean, omax, ovar, CAST(coalesce(rows_above, 0) AS BIGINT) AS rows_above
    FROM g JOIN o ON g.region = o.region LEFT JOIN above a ON a.region = g.region""",
)
def real_vs_table_ranges(spark, sf_dir):
    g = X.grid_history(spark, sf_dir).groupBy("region").agg(
        F.min("sst").alias("gmin"), F.round(F.avg("sst"), 6).alias("gmean"), F.max("sst").alias("gmax"),
        F.round(F.var_pop("sst"), 6).alias("gvar"),
    )
    obs = X.observations(spark, sf_dir)
    o = obs.groupBy("region").agg(
        F.min("water_temperature_c").alias("omin"), F.round(F.avg("water_temperature_c"), 6).alias("omean"),
        F.max("water_temperature_c").alias("omax"), F.round(F.var_pop("water_temperature_c"), 6).alias("ovar"),
    )
    # g has one row per region: the broadcast is bounded by the region count
    above = obs.join(F.broadcast(g.select("region", "gmax")), "region").filter(F.col("water_temperature_c") > F.col("gmax"))
    above = above.groupBy("region").agg(F.count(F.lit(1)).alias("rows_above"))
    return g.join(o, "region").join(above, "region", "left").na.fill(0, ["rows_above"]).withColumn(
        "rows_above", F.col("rows_above").cast("long")
    )


def _obs_cells_sql():
    return """(SELECT obs_id, CAST(timestamp AS DATE) AS day, CAST(round(latitude * 4) AS INTEGER) AS lat_idx,
                CAST(round(longitude * 4) AS INTEGER) AS lon_idx FROM observations)"""


@register(
    "space_time_join",
    f"""WITH o AS {_obs_cells_sql()},
    g AS (SELECT time, lat_idx, lon_idx, value FROM survey_grid),
    c AS (SELECT o.obs_id, g.time, g.lat_idx AS g_lat, g.lon_idx AS g_lon, g.value,
                 abs(g.lat_idx - o.lat_idx) + abs(g.lon_idx - o.lon_idx) AS cell_dist, abs(datediff('day', o.day, g.time)) AS day_dist
          FROM o JOIN g ON g.lat_idx BETWEEN o.lat_idx - 1 AND o.lat_idx + 1 AND g.lon_idx BETWEEN o.lon_idx - 1 AND o.lon_idx + 1
                 AND g.time BETWEEN o.day - INTERVAL 1 DAY AND o.day + INTERVAL 1 DAY)
    SELECT obs_id, time, g_lat, g_lon, value, cell_dist, day_dist FROM (
      SELECT *, row_number() OVER (PARTITION BY obs_id ORDER BY cell_dist, day_dist, time, g_lat, g_lon) AS rn FROM c) WHERE rn = 1""",
)
def space_time_join(spark, sf_dir):
    """Survey -> grid: nearest cell within one cell and +-1 day. The tolerance
    join is an equi-join on exploded neighbour keys (3 x 3 cells x 3 days per
    observed cell and day, not per observation); observations meet the nearest
    cell of theirs, and an id that repeats keeps its nearest one."""
    obs = X.observations(spark, sf_dir).select(
        "obs_id",
        F.to_date("timestamp").alias("day"),
        F.round(F.col("latitude") * 4).cast("int").alias("lat_idx"),
        F.round(F.col("longitude") * 4).cast("int").alias("lon_idx"),
    )
    g = X.survey_grid(spark, sf_dir).select("time", F.col("lat_idx").alias("g_lat"), F.col("lon_idx").alias("g_lon"), "value")
    near = nearest_cells(obs.select("day", "lat_idx", "lon_idx").distinct(), g)
    found = obs.join(near, ["day", "lat_idx", "lon_idx"]).select("obs_id", "best.*")
    # partitions follow the number of rows: the window's sort stays in memory
    w = Window.partitionBy("obs_id").orderBy("cell_dist", "day_dist", "time", "g_lat", "g_lon")
    dealt = found.repartition(IO.row_partitions(spark, obs.count()), "obs_id")
    return dealt.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") == 1).select(
        "obs_id", "time", "g_lat", "g_lon", "value", "cell_dist", "day_dist"
    )


def nearest_cells(places, g):
    """(day, lat_idx, lon_idx, best) of distinct places that a cell of g lies near: its distance, place and value."""
    offs = F.array(F.lit(-1), F.lit(0), F.lit(1))
    keys = (
        places.withColumn("dlat", F.explode(offs))
        .withColumn("dlon", F.explode(offs))
        .withColumn("dday", F.explode(offs))
        .select(
            "day", "lat_idx", "lon_idx",
            (F.col("lat_idx") + F.col("dlat")).alias("g_lat"),
            (F.col("lon_idx") + F.col("dlon")).alias("g_lon"),
            F.date_add("day", F.col("dday")).alias("time"),
            (F.abs("dlat") + F.abs("dlon")).alias("cell_dist"),
            F.abs("dday").alias("day_dist"),
        )
    )
    best = F.min(F.struct("cell_dist", "day_dist", "time", "g_lat", "g_lon", "value")).alias("best")
    return keys.join(g, ["time", "g_lat", "g_lon"]).groupBy("day", "lat_idx", "lon_idx").agg(best)


@register(
    "static_grid_join",
    """SELECT o.obs_id, e.elevation, CASE WHEN e.elevation < 0 THEN -e.elevation END AS raster_depth
    FROM (SELECT obs_id, CAST(round(latitude * 20) AS INTEGER) AS lat_idx, CAST(round(longitude * 20) AS INTEGER) AS lon_idx FROM observations) o
    LEFT JOIN survey_raster e ON o.lat_idx = e.lat_idx AND o.lon_idx = e.lon_idx""",
)
def static_grid_join(spark, sf_dir):
    """Survey -> raster by rounded cell index; outside the raster -> null."""
    o = X.observations(spark, sf_dir).select(
        "obs_id",
        F.round(F.col("latitude") * 20).cast("int").alias("lat_idx"),
        F.round(F.col("longitude") * 20).cast("int").alias("lon_idx"),
    )
    e = X.survey_raster(spark, sf_dir)
    j = o.join(e, ["lat_idx", "lon_idx"], "left")
    return j.select("obs_id", "elevation", F.when(F.col("elevation") < 0, -F.col("elevation")).alias("raster_depth"))


@register(
    "trailing_accumulation",
    """WITH c AS (SELECT time, lat_idx, lon_idx, value FROM grid_history_cells)
    SELECT time, lat_idx, lon_idx, round(sum(CASE WHEN value >= 1 THEN value ELSE 0.0 END) OVER (
             PARTITION BY lat_idx, lon_idx ORDER BY time RANGE BETWEEN INTERVAL 83 DAY PRECEDING AND CURRENT ROW) / 7.0, 6) AS accumulation
    FROM c""",
)
def trailing_accumulation(spark, sf_dir):
    """12-week running accumulation of HotSpot >= 1 per cell (window per cell)."""
    from tidepool.plans.q_profile import grid_history_cells

    c = grid_history_cells(spark, sf_dir)
    return G.trailing_accumulation(c, "value", 1.0, 84).select("time", "lat_idx", "lon_idx", "accumulation")

