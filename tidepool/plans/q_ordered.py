"""Groups F, G: ordered operators, splits, folds, top-k and seeded sampling."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidepool import schema as S
from tidepool.operators import ordered as O
from tidepool.plans import sqlviews as V
from tidepool.plans.registry import register
from tidepool.sources import fixtures as X


def _obs(spark, sf_dir):
    return X.observations(spark, sf_dir)


def _md5(seed, *parts):
    return "md5(" + " || '|' || ".join([f"'{seed}'"] + list(parts)) + ")"


def _split_sql(task: str, label: str) -> str:
    h = _md5(42, f"'{task}'", "obs_id")
    return f"""SELECT obs_id, '{task}' AS task, {label} AS class,
      CASE WHEN row_number() OVER (PARTITION BY {label} ORDER BY {h}, obs_id)
                <= floor(count(*) OVER (PARTITION BY {label}) * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS split
    FROM observations"""


def split_sql() -> str:
    return " UNION ALL ".join(_split_sql(t, label) for t, label in S.TASK_TARGET.items())


@register("stratified_split", split_sql())
def stratified_split(spark, sf_dir):
    names = {t: f"__{t}" for t in S.TASK_TARGET}
    done = O.stratified_splits(_obs(spark, sf_dir).select("obs_id", *S.TARGET_COLUMNS), S.TASK_TARGET, names)
    tasks = [F.struct(F.lit(t).alias("task"), F.col(label).alias("class"), F.col(names[t]).alias("split")) for t, label in S.TASK_TARGET.items()]
    return done.select("obs_id", F.explode(F.array(*tasks)).alias("t")).select("obs_id", "t.*")


@register(
    "stratified_kfold",
    f"""SELECT obs_id, reef_health AS class,
       CAST((row_number() OVER (PARTITION BY reef_health ORDER BY {_md5(42, "'cv'", 'obs_id')}, obs_id) - 1) % 5 AS INTEGER) AS fold
    FROM observations""",
)
def stratified_kfold(spark, sf_dir):
    f = O.stratified_kfold(_obs(spark, sf_dir).select("obs_id", "reef_health"), "reef_health", 5, 42, salt="cv")
    return f.select("obs_id", F.col("reef_health").alias("class"), "fold")


@register(
    "class_proportion_drift",
    "WITH s AS ("
    + _split_sql("health", "reef_health")
    + """), c AS (SELECT split, class, count(*) AS n FROM s GROUP BY 1, 2)
    SELECT split, class, n, round(n / sum(n) OVER (PARTITION BY split), 6) AS share FROM c""",
)
def class_proportion_drift(spark, sf_dir):
    s = stratified_split(spark, sf_dir).filter(F.col("task") == "health")
    c = s.groupBy("split", "class").agg(F.count(F.lit(1)).alias("n"))
    tot = c.groupBy("split").agg(F.sum("n").alias("_t"))
    return c.join(tot, "split").select("split", "class", "n", F.round(F.col("n") / F.col("_t"), 6).alias("share"))


@register(
    "stacked_bands",
    f"""WITH c AS (SELECT region, reef_health, count(*) AS n FROM observations GROUP BY 1, 2),
    d AS (SELECT * FROM (VALUES {", ".join(f"({i}, {V.q(c)})" for i, c in enumerate(S.HEALTH_CLASSES))}) t(band, reef_health)),
    g AS (SELECT r.region, d.band, d.reef_health, coalesce(c.n, 0) AS n
          FROM (SELECT DISTINCT region FROM c) r CROSS JOIN d LEFT JOIN c ON c.region = r.region AND c.reef_health = d.reef_health)
    SELECT region, band, reef_health, CAST(n AS BIGINT) AS n,
           CAST(sum(n) OVER (PARTITION BY region ORDER BY band ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upper_edge,
           sum(n) OVER (PARTITION BY region ORDER BY band ROWS UNBOUNDED PRECEDING) - sum(n) OVER (PARTITION BY region) / 2.0 AS centred_upper
    FROM g""",
)
def stacked_bands(spark, sf_dir):
    """Running upper edge of class bands per region (counts >= 0), plus the
    streamgraph form centred at -total/2. The window runs over the small
    region x class count table, never over rows."""
    c = _obs(spark, sf_dir).groupBy("region", "reef_health").agg(F.count(F.lit(1)).alias("n"))
    d = spark.createDataFrame(list(enumerate(S.HEALTH_CLASSES)), "band int, reef_health string")
    g = c.select("region").distinct().crossJoin(F.broadcast(d)).join(c, ["region", "reef_health"], "left").na.fill(0, ["n"])
    w = Window.partitionBy("region").orderBy("band")
    up = F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return g.select(
        "region", "band", "reef_health", F.col("n").cast("long"), up.cast("long").alias("upper_edge"),
        (up - F.sum("n").over(Window.partitionBy("region")) / 2.0).alias("centred_upper"),
    )


_TOP_COLS = [
    "obs_id", "region", "latitude", "longitude", "depth_m", "coral_cover_percentage",
    "hard_substrate_percentage", "water_temperature_c", "restoration_suitability",
]


@register(
    "top_suitable_sites",
    f"""SELECT CAST(row_number() OVER (ORDER BY coral_cover_percentage DESC, obs_id) AS INTEGER) AS rank, {", ".join(_TOP_COLS)}
    FROM (SELECT * FROM observations WHERE restoration_suitability = 'suitable'
          ORDER BY coral_cover_percentage DESC, obs_id LIMIT 10)""",
)
def top_suitable_sites(spark, sf_dir):
    """Top 10 suitable sites by coral cover (TakeOrdered: per-task top 10, then merge)."""
    top = (
        _obs(spark, sf_dir)
        .filter(F.col("restoration_suitability") == "suitable")
        .orderBy(F.desc("coral_cover_percentage"), "obs_id")
        .limit(10)
        .select(*_TOP_COLS)
    )
    w = Window.orderBy(F.desc("coral_cover_percentage"), "obs_id")  # over 10 rows only
    return top.withColumn("rank", F.row_number().over(w).cast("int"))


@register(
    "sample_bounded",
    f"SELECT * FROM observations ORDER BY {_md5(42, 'obs_id')}, obs_id LIMIT 2000",
)
def sample_bounded(spark, sf_dir):
    return O.sample_bounded(_obs(spark, sf_dir), 2000, 42)


@register(
    "sample_window",
    f"SELECT * EXCLUDE (reef_health, restoration_suitability) FROM observations ORDER BY {_md5(7, 'obs_id')}, obs_id LIMIT 1500",
)
def sample_window(spark, sf_dir):
    return O.seeded_sample(_obs(spark, sf_dir), 1500, 7).drop(*S.TARGET_COLUMNS)


@register(
    "shuffle",
    f"SELECT obs_id, CAST(row_number() OVER (ORDER BY {_md5(42, 'obs_id')}, obs_id) AS BIGINT) AS position FROM observations",
)
def shuffle(spark, sf_dir):
    return O.shuffle(_obs(spark, sf_dir).select("obs_id"), 42)


@register(
    "present_classes",
    f"""SELECT d.class_order, d.class FROM (VALUES {", ".join(f"({i}, {V.q(c)})" for i, c in enumerate(S.HEALTH_CLASSES))}) d(class_order, class)
    WHERE d.class IN (SELECT reef_health FROM observations)""",
)
def present_classes(spark, sf_dir):
    """Declared class order restricted to the classes present."""
    d = spark.createDataFrame(list(enumerate(S.HEALTH_CLASSES)), "class_order int, class string")
    present = _obs(spark, sf_dir).select(F.col("reef_health").alias("class")).distinct()
    return d.join(present, "class", "left_semi").select("class_order", "class")


@register("distinct_regions_sorted", "SELECT DISTINCT region FROM observations ORDER BY region")
def distinct_regions_sorted(spark, sf_dir):
    return _obs(spark, sf_dir).select("region").distinct().orderBy("region")
