"""Views over the driver tables (the only module that knows them).

``observations`` is a deterministic projection of lineitem x orders x
customer x nation into the 21-column observation table; integer arithmetic
keeps it bit-equal with the SQL definition used by the oracle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool import schema as S
from tidepool.functions import columns as C
from tidepool.sources.io import row_partitions


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _case(key: Column, mapping: dict, default) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(key == k, v) if expr is None else expr.when(key == k, v)
    return expr.otherwise(default)


def observations_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observation rows plus the helper columns ``_ok`` and ``_ep`` (from the table at rest)."""
    return labelled_base(spark, sf_dir).drop(*S.TARGET_COLUMNS)


def _observations_base_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observation rows plus ``_ok``/``_ep``, computed from the driver tables."""
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("ok"),
        F.col("l_linenumber").alias("ln"),
        F.col("l_partkey").alias("pk"),
        F.col("l_suppkey").alias("sk"),
        F.col("l_shipdate").alias("ts"),
        F.col("l_quantity").cast("bigint").alias("q"),
        F.floor(F.col("l_extendedprice") * 100).cast("bigint").alias("ep"),
        F.floor(F.col("l_discount") * 100 + 0.5).cast("bigint").alias("disc"),
        F.floor(F.col("l_tax") * 100 + 0.5).cast("bigint").alias("tax"),
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ok"),
        F.col("o_custkey"),
        F.floor(F.col("o_totalprice") * 100).cast("bigint").alias("tp"),
    )
    cust = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey")
    )
    # nation is a fixed 25-row dimension: a proven size bound for broadcast
    nation = F.broadcast(
        table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("rk")
        )
    )
    order_region = orders.join(cust, "o_custkey").join(nation, "c_nationkey").select("ok", "tp", "rk")
    # partitions follow the number of rows (read from the file footers), so that no task's sort spills
    n = row_partitions(spark, li.count())
    b = li.repartition(n, "ok").join(order_region.repartition(n, "ok"), "ok")

    ok, ln, pk, sk, ep, tp, q = (F.col(c) for c in ["ok", "ln", "pk", "sk", "ep", "tp", "q"])
    disc, tax, rk = F.col("disc"), F.col("tax"), F.col("rk")

    def dbl(x: Column) -> Column:
        return x.cast("double")

    return b.select(
        F.concat_ws("-", *[x.cast("string") for x in (ok, ln, pk, sk, ep)]).alias("obs_id"),
        F.col("ts").alias("timestamp"),
        _case(rk, {0: "Lakshadweep", 1: "Gulf of Mannar", 2: "Gulf of Kutch"}, "Andaman and Nicobar Islands").alias(
            "region"
        ),
        (_case(rk, {0: 10.0, 1: 8.5, 2: 22.0}, 6.5) + dbl(pk % 200) / 100).alias("latitude"),
        (_case(rk, {0: 72.0, 1: 78.0, 2: 68.0}, 92.0) + dbl(ok % 200) / 100).alias("longitude"),
        (dbl(q * 75) / 100).alias("depth_m"),
        (dbl(2400 + ep % 1200) / 100).alias("water_temperature_c"),
        (dbl(7600 + tp % 800) / 1000).alias("ph"),
        (dbl(3100 + ep % 1300) / 100).alias("salinity_ppt"),
        (dbl(200 + tp % 900) / 100).alias("dissolved_oxygen_mg_l"),
        (dbl((ep % 57) * (ep % 57)) / 100).alias("turbidity_ntu"),
        (dbl(50 + tp % 20000) / 10).alias("light_intensity"),
        (dbl(5 + ep % 900) / 1000).alias("current_speed_m_s"),
        (dbl(-3600 + pk % 3400) / 100).alias("sonar_backscatter"),
        (dbl(1000 + (pk * 7) % 3800) / 1000).alias("rugosity_index"),
        (dbl((pk * 13 + q) % 1001) / 10).alias("hard_substrate_percentage"),
        (dbl(500 + (ok * 3 + q) % 9500) / 10000).alias("acoustic_complexity_index"),
        (dbl((ok * 17 + ln) % 901) / 10).alias("coral_cover_percentage"),
        (dbl((tp % 701) * (disc + 1) % 1001) / 10).alias("bleaching_percentage"),
        (dbl((ep % 401) + tax * 20) / 10).alias("disease_percentage"),
        ok.alias("_ok"),
        ep.alias("_ep"),
    )


def with_labels(df: DataFrame) -> DataFrame:
    """Attach both class labels from the noise-free score formulas (9 dp)."""
    df = C.with_scores(df, {"__hs": C.HEALTH_TERMS, "__rs": C.RESTORATION_TERMS}, 9, False)
    return df.withColumns(
        {
            "reef_health": C.health_class("__hs"),
            "restoration_suitability": C.restoration_class("__rs"),
        }
    ).drop("__hs", "__rs")


_MATERIALISED: dict[tuple, str] = {}


def labelled_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled observation table at rest.

    Built once per application from the driver tables and written as
    Parquet into the shared checkpoint folder (this also cuts the join
    lineage); every query then scans it with column pruning and filter
    pushdown instead of re-running the four-way join and both score chains.
    """
    from tidepool.sources.io import shared_dir

    key = (spark.sparkContext.applicationId, sf_dir)
    path = _MATERIALISED.get(key)
    if path is None:
        path = shared_dir(spark, "observations")
        # the label projection is long; fused into one generated method it
        # exceeds the JIT's huge-method limit and runs slower than the
        # interpreted operators, so this single write runs without fusion
        prev = spark.conf.get("spark.sql.codegen.wholeStage")
        spark.conf.set("spark.sql.codegen.wholeStage", "false")
        try:
            with_labels(_observations_base_raw(spark, sf_dir)).write.mode("overwrite").option("compression", "zstd").parquet(path)
        finally:
            spark.conf.set("spark.sql.codegen.wholeStage", prev)
        _MATERIALISED[key] = path
    return spark.read.parquet(path)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled_base(spark, sf_dir).select(*S.OBSERVATION_COLUMNS)


def truth_offset() -> Column:
    """Deterministic per-row offset used to make a 'truth' differ from a prediction."""
    return ((F.col("_ep") * 31 + F.col("_ok")) % 151 - 75).cast("double") / 1000


def scored_pairs(spark: SparkSession, sf_dir: str, task: str = "health", with_scorer: bool = False) -> DataFrame:
    """(obs_id, region, y_true, y_pred): truth from score+offset, prediction from score;
    with_scorer adds the fixture scorer's ``predicted_class`` from the same pass."""
    b = observations_base(spark, sf_dir)
    if task == "health":
        b, to_class = C.with_health_score(b, "__s", None, False), C.health_class
    else:
        b, to_class = C.with_restoration_score(b, "__s", None, False), C.restoration_class
    pairs = {"y_true": to_class(F.round(F.col("__s") + truth_offset(), 9)), "y_pred": to_class(F.round(F.col("__s"), 9))}
    if with_scorer:
        return fixture_scorer(b.withColumns(pairs), task).select("obs_id", "region", *pairs, "predicted_class")
    return b.select("obs_id", "region", *[v.alias(k) for k, v in pairs.items()])


def scored_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(obs_id, region, task, y_true, y_pred, predicted_class): scored_pairs of both tasks with the scorer, from one pass."""
    b = observations_base(spark, sf_dir)
    own = b.columns
    for task, score, to_class in (("health", C.with_health_score, C.health_class), ("restoration", C.with_restoration_score, C.restoration_class)):
        scored = fixture_scorer(score(b, "__s", None, False), task)
        s = F.col("__s")
        row = F.struct(F.lit(task).alias("task"), to_class(F.round(s + truth_offset(), 9)).alias("y_true"), to_class(F.round(s, 9)).alias("y_pred"), "predicted_class")
        own = [*own, f"__{task}"]
        b = scored.withColumn(f"__{task}", row).select(*own)
    return b.select("obs_id", "region", F.explode(F.array("__health", "__restoration")).alias("t")).select("obs_id", "region", "t.*")


def observations_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule-based damage by ``_ep % 97`` (see FIXTURES.md §3); keeps ``_ep``."""
    b = labelled_base(spark, sf_dir)
    r = F.col("_ep") % 97
    damaged = b.withColumns(
        {
            "ph": F.when(r == 0, F.lit(6.5)).otherwise(F.col("ph")),
            "water_temperature_c": F.when(r == 1, F.lit(None).cast("double")).otherwise(
                F.col("water_temperature_c")
            ),
            "region": F.when(r == 2, F.lit("Unknown Reef")).otherwise(F.col("region")),
            "latitude": F.when(r == 3, F.col("latitude") + 30).otherwise(F.col("latitude")),
            "bleaching_percentage": F.when(r == 4, F.lit(120.0)).otherwise(F.col("bleaching_percentage")),
            "depth_text": F.when(r == 5, F.lit("abc")).otherwise(F.col("depth_m").cast("string")),
        }
    ).select(*S.OBSERVATION_COLUMNS, "depth_text", "_ep")
    return damaged.unionByName(damaged.filter(r == 6))


def region_bounds(spark: SparkSession) -> DataFrame:
    rows = [(k, *v) for k, v in S.REGION_BOUNDS.items()]
    return spark.createDataFrame(rows, "region string, lat_min double, lat_max double, lon_min double, lon_max double")


RUN_METRICS = [
    ("run-health-lr", "health", "logistic_regression", 0.761172, 0.777646, 0.7871, 0.8012, 0.8193),
    ("run-health-rf", "health", "random_forest", 0.7604, None, None, None, None),
    ("run-health-xgb", "health", "xgboost", 0.7580, None, None, None, None),
    ("run-rest-xgb", "restoration", "xgboost", 0.791291, 0.801557, 0.8029, 0.8121, 0.8277),
    ("run-rest-rf", "restoration", "random_forest", 0.7839, None, None, None, None),
    ("run-rest-lr", "restoration", "logistic_regression", 0.7808, None, None, None, None),
]
RUN_METRICS_SCHEMA = (
    "run_id string, task string, algorithm string, cv_macro_f1 double, cv_balanced_accuracy double, "
    "test_macro_f1 double, test_balanced_accuracy double, test_accuracy double"
)


def run_metrics(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RUN_METRICS, RUN_METRICS_SCHEMA)


def alias_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append-only model alias events: (model_name, version, run_id, ts)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.when(F.col("user_id") % 2 == 0, "reef_health_model").otherwise("restoration_model").alias("model_name"),
        F.col("event_id").alias("version"),
        F.concat(F.lit("run-"), F.col("event_id").cast("string")).alias("run_id"),
        F.col("ts"),
    )


def _cents_mean(v: str) -> Column:
    return F.sum(F.round(F.col(v) * 100).cast("bigint")).cast("double") / F.count(v) / 100


def grid_daily(spark: SparkSession, sf_dir: str, source: str = "a") -> DataFrame:
    """Long daily grid (product, region, time, lat_idx, lon_idx, lat, lon, value).

    product = event type, cell from user id, value = exact mean of the
    cell-day (integer cents). Source ``b`` nulls cells where an event with
    ``event_id % 53 = 0`` contributed.
    """
    ev = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("product"),
        F.to_date("ts").alias("time"),
        (F.col("user_id") % 20).cast("int").alias("lat_idx"),
        F.floor(F.col("user_id") / 20).cast("int").alias("lon_idx"),
        "value",
        "event_id",
    )
    g = ev.groupBy("product", "time", "lat_idx", "lon_idx").agg(
        _cents_mean("value").alias("value"),
        F.max((F.col("event_id") % 53 == 0).cast("int")).alias("_hole"),
    )
    if source == "b":
        g = g.withColumn("value", F.when(F.col("_hole") == 1, F.lit(None).cast("double")).otherwise(F.col("value")))
    region = reduce(
        lambda acc, i: acc.when(F.col("lat_idx") % 4 == i, S.REGIONS[i]), range(1, 4), F.when(F.col("lat_idx") % 4 == 0, S.REGIONS[0])
    )
    return g.select(
        "product",
        region.alias("region"),
        "time",
        "lat_idx",
        "lon_idx",
        (F.lit(8.0) + F.col("lat_idx") * 0.05).alias("lat"),
        (F.lit(72.0) + F.col("lon_idx") * 0.05).alias("lon"),
        "value",
    )


def grid_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-year daily series (region, time, lat_idx, lon_idx, dhw, sst) over orders dates.

    The events grid spans 30 days, so month/year analyses use this one.
    """
    o = table(spark, sf_dir, "orders")
    region = F.element_at(F.array(*[F.lit(r) for r in S.REGIONS]), (F.col("o_custkey") % 4 + 1).cast("int"))
    return o.select(
        region.alias("region"),
        F.to_date("o_orderdate").alias("time"),
        (F.col("o_custkey") % 7).cast("int").alias("lat_idx"),
        (F.col("o_orderkey") % 5).cast("int").alias("lon_idx"),
        (F.floor(F.col("o_totalprice")) % 1600 / 100).cast("double").alias("dhw"),
        (F.lit(2400.0) + F.floor(F.col("o_totalprice")) % 900).cast("double").alias("sst_cents"),
    ).withColumn("sst", F.col("sst_cents") / 100).drop("sst_cents")


def grid_elevation(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    region = F.element_at(F.array(*[F.lit(r) for r in S.REGIONS]), (F.col("p_partkey") % 4 + 1).cast("int"))
    return p.select(
        region.alias("region"),
        (F.col("p_partkey") % 50).cast("int").alias("lat_idx"),
        F.floor(F.col("p_partkey") / 50).cast("int").alias("lon_idx"),
        (F.lit(8.0) + (F.col("p_partkey") % 50).cast("double") / 240).alias("lat"),
        (F.lit(72.0) + F.floor(F.col("p_partkey") / 50).cast("double") / 240).alias("lon"),
        ((F.col("p_partkey") * 37) % 400 - 250).cast("int").alias("elevation"),
    )


#: South-west corner of each region's grids, by the number that picks the region (order of S.REGIONS).
GRID_CORNERS = [(10.0, 72.0), (8.5, 78.0), (22.0, 68.0), (6.5, 92.0)]


def _corner(number: Column, axis: int) -> Column:
    return F.element_at(F.array(*[F.lit(c[axis]) for c in GRID_CORNERS]), (number + 1).cast("int"))


def survey_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(time, lat_idx, lon_idx, value): daily cells of a quarter degree over the observed regions; the indices are of whole quarters, so about half the observations have a cell near in space and time."""
    o = table(spark, sf_dir, "orders")
    number = F.col("o_custkey") % 4
    cells = o.select(
        F.to_date("o_orderdate").alias("time"),
        (F.round(_corner(number, 0) * 4) + F.floor(F.col("o_custkey") / 4) % 9).cast("int").alias("lat_idx"),
        (F.round(_corner(number, 1) * 4) + F.col("o_orderkey") % 9).cast("int").alias("lon_idx"),
        (F.floor(F.col("o_totalprice")) % 1600 / 100).cast("double").alias("value"),
    )
    return cells.groupBy("time", "lat_idx", "lon_idx").agg(F.max("value").alias("value"))


def survey_raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(lat_idx, lon_idx, elevation): static cells of a twentieth of a degree over part of each observed region."""
    p = table(spark, sf_dir, "part")
    number, k = F.col("p_partkey") % 4, F.floor(F.col("p_partkey") / 4)
    cells = p.select(
        (F.round(_corner(number, 0) * 20) + k % 41).cast("int").alias("lat_idx"),
        (F.round(_corner(number, 1) * 20) + F.floor(k / 41) % 41).cast("int").alias("lon_idx"),
        ((F.col("p_partkey") * 37) % 400 - 250).cast("int").alias("elevation"),
    )
    return cells.groupBy("lat_idx", "lon_idx").agg(F.min("elevation").alias("elevation"))


# --- fixed values: class centres of the deterministic fixture scorer --------
SCORER_CENTRES = {
    "health": {"healthy": 0.14, "stressed": 0.375, "bleached": 0.565, "severely_degraded": 0.83},
    "restoration": {"suitable": 0.815, "moderately_suitable": 0.515, "unsuitable": 0.2},
}


def fixture_scorer(df: DataFrame, task: str) -> DataFrame:
    """Deterministic stand-in scorer: probabilities from the distance of the
    noise-free score to each class centre (rational, bit-reproducible).

    Adds ``task, predicted_class, probabilities, confidence``.
    """
    scored = (C.with_health_score if task == "health" else C.with_restoration_score)(df, "__score", 9, False)
    centres = SCORER_CENTRES[task]
    names, cs = list(centres), list(centres.values())
    s = F.col("__score")
    # argmax of the weights == nearest centre; ties go to the earlier class
    order = sorted(range(len(cs)), key=lambda i: cs[i])
    pred = None
    for a, b in zip(order, order[1:]):
        mid = (cs[a] + cs[b]) / 2
        cond = s <= mid if a < b else s < mid
        pred = F.when(cond, names[a]) if pred is None else pred.when(cond, names[a])
    pred = pred.otherwise(names[order[-1]])
    dmin = F.least(*[F.abs(s - c) for c in cs])
    wn = [f"__w{i}" for i in range(len(cs))]
    scored = scored.withColumns({n: F.lit(1.0) / (F.lit(1.0) + 100.0 * (s - c) * (s - c)) for n, c in zip(wn, cs)})
    scored = scored.withColumn("__total", reduce(lambda a, b: a + b, [F.col(n) for n in wn]))
    wmax = F.lit(1.0) / (F.lit(1.0) + 100.0 * dmin * dmin)
    return scored.withColumns(
        {
            "task": F.lit(task),
            "predicted_class": pred,
            "probabilities": F.map_from_arrays(
                F.array(*[F.lit(c) for c in names]), F.array(*[F.round(F.col(w) / F.col("__total"), 6) for w in wn])
            ),
            "confidence": F.round(wmax / F.col("__total"), 6),
        }
    ).drop("__score", "__total", *wn)


def predictions(spark: SparkSession, sf_dir: str, task: str = "health") -> DataFrame:
    b = observations_base(spark, sf_dir)
    return fixture_scorer(b, task).select("obs_id", "region", "task", "predicted_class", "probabilities", "confidence")
