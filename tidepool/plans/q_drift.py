"""Group J queries: drift between a reference and a shifted production window."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidepool import schema as S
from tidepool.functions import columns as C
from tidepool.operators import drift as D
from tidepool.operators import validate as VL
from tidepool.plans import sqlviews as V
from tidepool.plans.registry import register
from tidepool.sources import fixtures as X


TASKS = {t: (f"{t}_class", S.TASK_CLASSES[t]) for t in ("health", "restoration")}


def windows(spark, sf_dir):
    """All rows before the cut date, and all from it on, shifted."""
    return D.split_windows(X.observations(spark, sf_dir))


def sided(spark, sf_dir):
    return D.sided(X.observations(spark, sf_dir))


def scored(spark, sf_dir):
    """Both windows with each task's predicted class and confidence, scored in one pass."""
    both = sided(spark, sf_dir)
    for task in TASKS:
        both = X.fixture_scorer(both, task).withColumnsRenamed({"predicted_class": f"{task}_class", "confidence": f"{task}_confidence"}).drop("task", "probabilities")
    return both.select("side", *[f"{t}_{c}" for t in TASKS for c in ("class", "confidence")])


def scored_windows(spark, sf_dir, task):
    ref, cur = windows(spark, sf_dir)
    return X.fixture_scorer(ref, task), X.fixture_scorer(cur, task)


def feature_distances(spark, sf_dir):
    return D.distances(spark, D.value_counts(sided(spark, sf_dir), S.SENSOR_COLUMNS), S.SENSOR_COLUMNS)


@register("reference_window", "SELECT * FROM ref_sample")
def reference_window(spark, sf_dir):
    return D.reference_window(X.observations(spark, sf_dir))


@register(
    "production_window",
    "SELECT * REPLACE (" + ", ".join(f"round({c}, 6) AS {c}" for c in S.SHIFTS) + ") FROM prod_sample",
)
def production_window(spark, sf_dir):
    return D.production_window(X.observations(spark, sf_dir)).withColumns({c: F.round(c, 6) for c in S.SHIFTS})


def _ks_p_sql(d: str, n1: str, n2: str) -> str:
    lam = f"((sqrt({n1} * {n2} / ({n1} + {n2})) + 0.12 + 0.11 / sqrt({n1} * {n2} / ({n1} + {n2}))) * {d})"
    series = (
        f"(SELECT sum(CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0 * k * k * {lam} * {lam})) "
        f"FROM range(1, 101) t(k))"
    )
    return f"(CASE WHEN {d} <= 0 THEN 1.0 ELSE least(1.0, greatest(0.0, {series})) END)"


def _distance_sql(long_sql: str) -> str:
    """Per column: ks_statistic, wasserstein, n_reference, n_current, std/mean."""
    return f"""lw AS ({long_sql}),
    cnt AS (SELECT "column", value, sum(CASE WHEN side = 'reference' THEN 1 ELSE 0 END) AS n_ref,
                   sum(CASE WHEN side = 'current' THEN 1 ELSE 0 END) AS n_cur FROM lw GROUP BY 1, 2),
    tot AS (SELECT "column", sum(n_ref) AS tot_ref, sum(n_cur) AS tot_cur FROM cnt GROUP BY 1),
    ecdf AS (SELECT c."column", c.value,
                    sum(n_ref) OVER (PARTITION BY c."column" ORDER BY value ROWS UNBOUNDED PRECEDING) / tot_ref AS F_ref,
                    sum(n_cur) OVER (PARTITION BY c."column" ORDER BY value ROWS UNBOUNDED PRECEDING) / tot_cur AS F_cur,
                    lead(value) OVER (PARTITION BY c."column" ORDER BY value) AS next_value, tot_ref, tot_cur
             FROM cnt c JOIN tot t ON c."column" = t."column"),
    dist AS (SELECT "column", max(abs(F_ref - F_cur)) AS ks_statistic,
                    sum(abs(F_ref - F_cur) * coalesce(next_value - value, 0.0)) AS wasserstein,
                    CAST(max(tot_ref) AS BIGINT) AS n_reference, CAST(max(tot_cur) AS BIGINT) AS n_current FROM ecdf GROUP BY 1),
    mom AS (SELECT "column", stddev_pop(CASE WHEN side = 'reference' THEN value END) AS std_reference,
                   avg(CASE WHEN side = 'reference' THEN value END) AS mean_reference,
                   avg(CASE WHEN side = 'current' THEN value END) AS mean_current FROM lw GROUP BY 1),
    dd AS (SELECT * FROM dist JOIN mom USING ("column"))"""


_SENSORS = ", ".join(S.SENSOR_COLUMNS)
_FEATURE_LONG = f"""SELECT side, "column", value FROM (
      SELECT 'reference' AS side, {_SENSORS} FROM ref_window UNION ALL SELECT 'current' AS side, {_SENSORS} FROM prod_window)
    UNPIVOT (value FOR "column" IN ({_SENSORS})) WHERE value IS NOT NULL AND isfinite(value)"""

_FEATURE_DRIFT_SQL = (
    "WITH "
    + _distance_sql(_FEATURE_LONG)
    + f""",
    fv AS (SELECT *, wasserstein / greatest(std_reference, 0.001) AS normed,
                  {_ks_p_sql('ks_statistic', 'n_reference', 'n_current')} AS ks_p FROM dd)"""
)
_FEATURE_DRIFT_SELECT = """SELECT "column", 'wasserstein_normed' AS method, round(normed, 6) AS value, 0.1 AS threshold,
       normed >= 0.1 AS drifted, normed < 0.1 AS legacy_flag, round(ks_statistic, 6) AS ks_statistic,
       round(normed, 6) AS wasserstein_normed FROM fv"""


@register("feature_drift", _FEATURE_DRIFT_SQL + "\n" + _FEATURE_DRIFT_SELECT)
def feature_drift(spark, sf_dir):
    return D.feature_drift(feature_distances(spark, sf_dir), "wasserstein_normed", 0.1)


@register(
    "ks_two_sample",
    _FEATURE_DRIFT_SQL
    + """ SELECT "column", n_reference, n_current, round(ks_statistic, 6) AS ks_statistic, round(ks_p, 6) AS p_value, ks_p < 0.1 AS drifted FROM fv""",
)
def ks_two_sample(spark, sf_dir):
    return feature_distances(spark, sf_dir).select(
        "column", "n_reference", "n_current", F.round("ks_statistic", 6).alias("ks_statistic"), F.round("ks_p", 6).alias("p_value"), (F.col("ks_p") < 0.1).alias("drifted")
    )


@register(
    "wasserstein_normed",
    _FEATURE_DRIFT_SQL
    + """ SELECT "column", round(wasserstein, 6) AS wasserstein, round(std_reference, 6) AS std_reference, round(normed, 6) AS normed, normed >= 0.1 AS drifted FROM fv""",
)
def wasserstein_normed(spark, sf_dir):
    return feature_distances(spark, sf_dir).select(
        "column", F.round("wasserstein", 6).alias("wasserstein"), F.round("std_reference", 6).alias("std_reference"), F.round("normed", 6).alias("normed"), (F.col("normed") >= 0.1).alias("drifted")
    )


@register(
    "drift_pvalues_sorted",
    _FEATURE_DRIFT_SQL
    + """ SELECT CAST(row_number() OVER (ORDER BY round(ks_p, 6), round(normed, 6) DESC, "column") AS INTEGER) AS rank, "column",
          round(ks_p, 6) AS p_value, round(normed, 6) AS wasserstein_normed FROM fv""",
)
def drift_pvalues_sorted(spark, sf_dir):
    """Columns by ascending p-value, the farther apart first among equals (one row per column)."""
    d = feature_distances(spark, sf_dir).select("column", F.round("ks_p", 6).alias("p_value"), F.round("normed", 6).alias("wasserstein_normed"))
    order = Window.partitionBy().orderBy("p_value", F.desc("wasserstein_normed"), "column")
    return d.withColumn("rank", F.row_number().over(order)).orderBy("rank")


@register(
    "drift_share",
    _FEATURE_DRIFT_SQL
    + f", fr AS ({_FEATURE_DRIFT_SELECT})"
    + """ SELECT CAST(sum(CAST(drifted AS INTEGER)) AS BIGINT) AS drifted_count, count(*) AS total_columns,
           round(sum(CAST(drifted AS INTEGER)) / count(*), 4) AS drifted_share FROM fr""",
)
def drift_share(spark, sf_dir):
    return D.drift_share(feature_drift(spark, sf_dir))


def _chi2_sql(task: str) -> str:
    classes = S.TASK_CLASSES[task]
    dim = ", ".join(f"({i}, {V.q(c)})" for i, c in enumerate(classes))
    return f"""c_{task} AS (
      SELECT d.class_order, d.class,
             (SELECT count(*) FROM ref_pred_{task} r WHERE r.predicted_class = d.class) AS o_ref,
             (SELECT count(*) FROM prod_pred_{task} p WHERE p.predicted_class = d.class) AS o_cur
      FROM (VALUES {dim}) d(class_order, class)),
    t_{task} AS (SELECT sum(o_ref) AS R, sum(o_cur) AS Q, sum(CASE WHEN o_ref + o_cur > 0 THEN 1 ELSE 0 END) AS k FROM c_{task}),
    s_{task} AS (SELECT R, Q, k, sum(CASE WHEN o_ref + o_cur > 0 THEN
          power(greatest(abs(o_ref - R * (o_ref + o_cur) / (R + Q)) - CASE WHEN k = 2 THEN 0.5 ELSE 0.0 END, 0.0), 2) / (R * (o_ref + o_cur) / (R + Q))
        + power(greatest(abs(o_cur - Q * (o_ref + o_cur) / (R + Q)) - CASE WHEN k = 2 THEN 0.5 ELSE 0.0 END, 0.0), 2) / (Q * (o_ref + o_cur) / (R + Q))
        ELSE 0.0 END) AS stat
      FROM c_{task}, t_{task} GROUP BY R, Q, k),
    v_{task} AS (SELECT {V.q(task)} AS task, CASE WHEN R > 0 AND Q > 0 AND k >= 2 THEN stat ELSE 0.0 END AS st,
                 CAST(CASE WHEN R > 0 AND Q > 0 AND k >= 2 THEN k - 1 ELSE 0 END AS INTEGER) AS dof,
                 CAST(R AS BIGINT) AS n_reference, CAST(Q AS BIGINT) AS n_current FROM s_{task}),
    p_{task} AS (SELECT *, CASE WHEN dof = 0 OR st <= 0 THEN 1.0 WHEN st / 2 > 3000 THEN 0.0 ELSE greatest(0.0, 1.0 - (
          SELECT sum(exp((dof / 2.0 + n) * ln(st / 2) - st / 2 - lgamma(dof / 2.0 + n + 1))) FROM range(0, 6000) t(n))) END AS p
      FROM v_{task})"""


_PRED_DRIFT_SQL = (
    "WITH "
    + _chi2_sql("health")
    + ",\n"
    + _chi2_sql("restoration")
    + """
    SELECT task, round(st, 4) AS statistic, dof, round(p, 6) AS p_value, round(p, 6) < 0.1 AS drifted, n_reference, n_current
    FROM p_health UNION ALL
    SELECT task, round(st, 4), dof, round(p, 6), round(p, 6) < 0.1, n_reference, n_current FROM p_restoration"""
)


@register("prediction_drift", _PRED_DRIFT_SQL)
def prediction_drift(spark, sf_dir):
    return D.prediction_drift(scored(spark, sf_dir), TASKS, 0.1).drop("reference_distribution", "current_distribution")


def _class_shares_sql(task: str) -> str:
    return f"""SELECT {V.q(task)} AS task, class, round(coalesce(o_ref / nullif(R, 0), 0), 4) AS reference_share,
        round(coalesce(o_cur / nullif(Q, 0), 0), 4) AS current_share FROM c_{task}, t_{task}"""


@register(
    "prediction_drift_shares",
    "WITH " + _chi2_sql("health") + ", " + _chi2_sql("restoration") + _class_shares_sql("health") + " UNION ALL " + _class_shares_sql("restoration"),
)
def prediction_drift_shares(spark, sf_dir):
    """The share maps of J05, a row per task and class."""
    d = D.prediction_drift(scored(spark, sf_dir), TASKS, 0.1)
    long = d.select("task", "current_distribution", F.explode("reference_distribution").alias("class", "reference_share"))
    return long.select("task", "class", "reference_share", F.element_at("current_distribution", F.col("class")).alias("current_share"))


def _conf_long(task):
    return (
        f"SELECT 'reference' AS side, 'confidence' AS \"column\", confidence AS value FROM ref_pred_{task} "
        f"UNION ALL SELECT 'current', 'confidence', confidence FROM prod_pred_{task}"
    )


def _conf_sql(task):
    return (
        "WITH "
        + _distance_sql(_conf_long(task))
        + f"""
    SELECT {V.q(task)} AS task, round(ks_statistic, 4) AS statistic,
           round({_ks_p_sql('ks_statistic', 'n_reference', 'n_current')}, 6) AS p_value_asymptotic,
           {_ks_p_sql('ks_statistic', 'n_reference', 'n_current')} < 0.1 AS drifted,
           round(mean_reference, 4) AS mean_reference, round(mean_current, 4) AS mean_current,
           round(mean_current - mean_reference, 4) AS delta, n_reference, n_current FROM dd"""
    )


@register(
    "confidence_drift",
    "SELECT * FROM (" + _conf_sql("health") + ") UNION ALL SELECT * FROM (" + _conf_sql("restoration") + ")",
)
def confidence_drift(spark, sf_dir):
    return D.confidence_drift(spark, scored(spark, sf_dir), {t: f"{t}_confidence" for t in TASKS}, 0.1)


def _recommendation_sql(f: str, p: str) -> str:
    return (
        f"CASE WHEN ({f}) AND ({p}) THEN {V.q(S.REC_RETRAIN)} WHEN ({f}) THEN {V.q(S.REC_INVESTIGATE_FEATURE)} "
        f"WHEN ({p}) THEN {V.q(S.REC_INVESTIGATE_PREDICTION)} ELSE {V.q(S.REC_OK)} END"
    )


@register(
    "drift_recommendation",
    _FEATURE_DRIFT_SQL
    + f", fr AS ({_FEATURE_DRIFT_SELECT}),\n"
    + _chi2_sql("health")
    + ",\n"
    + _chi2_sql("restoration")
    + f""",
    flags AS (SELECT (SELECT sum(CAST(drifted AS INTEGER)) FROM fr) > 0 AS feature_drifted,
                     (SELECT round(p, 6) < 0.1 FROM p_health) OR (SELECT round(p, 6) < 0.1 FROM p_restoration) AS prediction_drifted)
    SELECT feature_drifted, prediction_drifted, {_recommendation_sql('feature_drifted', 'prediction_drifted')} AS recommendation
    FROM flags""",
)
def drift_recommendation(spark, sf_dir):
    fd = drift_share(spark, sf_dir).select((F.col("drifted_count") > 0).alias("feature_drifted"))
    pdrift = prediction_drift(spark, sf_dir).agg(F.max(F.col("drifted").cast("int")).cast("boolean").alias("prediction_drifted"))
    both = fd.crossJoin(pdrift)
    return both.select(
        "feature_drifted", "prediction_drifted", C.recommendation("feature_drifted", "prediction_drifted").alias("recommendation")
    )


@register(
    "recommendation",
    f"""WITH f AS (SELECT region, avg(bleaching_percentage) > 25 AS feature_flag,
                         avg(CASE WHEN reef_health = 'healthy' THEN 1.0 ELSE 0.0 END) < 0.15 AS prediction_flag
                  FROM observations GROUP BY region)
    SELECT region, feature_flag, prediction_flag, {_recommendation_sql('feature_flag', 'prediction_flag')} AS recommendation FROM f""",
)
def recommendation(spark, sf_dir):
    """B27 applied per region to two data-derived flags (mean bleaching above
    25 %, healthy share below 15 %)."""
    f = X.observations(spark, sf_dir).groupBy("region").agg(
        (F.avg("bleaching_percentage") > 25).alias("feature_flag"),
        (F.avg(F.when(F.col("reef_health") == "healthy", 1.0).otherwise(0.0)) < 0.15).alias("prediction_flag"),
    )
    return f.withColumn("recommendation", C.recommendation("feature_flag", "prediction_flag"))


SUMMARY_SQL = (
    _FEATURE_DRIFT_SQL
    + f", fr AS ({_FEATURE_DRIFT_SELECT}),\n"
    + _chi2_sql("health")
    + ",\n"
    + _chi2_sql("restoration")
    + f""",
    flags AS (SELECT CAST(sum(CAST(drifted AS INTEGER)) AS BIGINT) AS drifted_count, count(*) AS total_columns,
                     (SELECT round(p, 6) < 0.1 FROM p_health) OR (SELECT round(p, 6) < 0.1 FROM p_restoration) AS prediction_drifted FROM fr)
    SELECT (SELECT count(*) FROM ref_window) AS reference_n, (SELECT count(*) FROM prod_window) AS production_n, drifted_count, total_columns,
           round(drifted_count / total_columns, 4) AS drifted_share, prediction_drifted,
           (SELECT round(st, 4) FROM p_health) AS health_statistic, (SELECT round(st, 4) FROM p_restoration) AS restoration_statistic,
           {_recommendation_sql('drifted_count > 0', 'prediction_drifted')} AS recommendation, 1.0 AS shift_scale, 0.1 AS drift_threshold
    FROM flags"""
)


@register("drift_summary", SUMMARY_SQL)
def drift_summary(spark, sf_dir):
    """One summary row (J08): sizes, feature and prediction drift, and the recommendation, each part computed once."""
    share = drift_share(spark, sf_dir)
    pred = prediction_drift(spark, sf_dir).agg(
        F.max("n_reference").alias("reference_n"),
        F.max("n_current").alias("production_n"),
        F.bool_or("drifted").alias("prediction_drifted"),
        *[F.max(F.when(F.col("task") == t, F.col("statistic"))).alias(f"{t}_statistic") for t in TASKS],
    )
    return share.crossJoin(pred).withColumns(
        {
            "recommendation": C.recommendation(F.col("drifted_count") > 0, "prediction_drifted"),
            "shift_scale": F.lit(1.0),
            "drift_threshold": F.lit(0.1),
        }
    )


@register(
    "retraining_permission",
    f"""WITH f AS (SELECT region, avg(bleaching_percentage) > 25 AS feature_flag,
                         avg(CASE WHEN reef_health = 'healthy' THEN 1.0 ELSE 0.0 END) < 0.15 AS prediction_flag, min(region) LIKE 'G%' AS asked
                  FROM observations GROUP BY region),
    r AS (SELECT region, {_recommendation_sql('feature_flag', 'prediction_flag')} AS recommendation, CASE WHEN asked THEN ' new sensors ' ELSE '  ' END AS reason FROM f)
    SELECT region, recommendation, reason, upper(recommendation) LIKE 'RETRAIN%' OR trim(reason) <> '' AS permitted,
           CASE WHEN upper(recommendation) LIKE 'RETRAIN%' THEN 'drift' WHEN trim(reason) <> '' THEN 'manual' ELSE 'none' END AS ground FROM r""",
)
def retraining_permission(spark, sf_dir):
    """C17 on each region's recommendation; the two gulfs come with a reason given by hand, the others with a blank one."""
    r = recommendation(spark, sf_dir).select("region", "recommendation", F.when(F.col("region").startswith("G"), " new sensors ").otherwise("  ").alias("reason"))
    drift = VL.retraining_permission(F.col("recommendation"), F.lit(None))
    return r.withColumns(
        {
            "permitted": VL.retraining_permission(F.col("recommendation"), F.col("reason")),
            "ground": F.when(drift, "drift").when(F.trim("reason") != "", "manual").otherwise("none"),
        }
    )


_SUMMARY_COLS = ", ".join(S.SENSOR_COLUMNS)


@register(
    "data_summary",
    f"""WITH lw AS (SELECT side, "column", value FROM (
          SELECT 'reference' AS side, {_SUMMARY_COLS} FROM ref_window UNION ALL SELECT 'current' AS side, {_SUMMARY_COLS} FROM prod_window)
        UNPIVOT INCLUDE NULLS (value FOR "column" IN ({_SUMMARY_COLS})))
    SELECT "column", side, count(value) AS count, CAST(sum(CASE WHEN value IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulls,
           round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, min(value) AS min,
           round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
           round(quantile_cont(value, 0.75), 6) AS p75, max(value) AS max
    FROM lw GROUP BY 1, 2""",
)
def data_summary(spark, sf_dir):
    return D.data_summary(sided(spark, sf_dir), S.SENSOR_COLUMNS)


@register(
    "share_change_flags",
    f"""WITH r AS (SELECT predicted_class AS class, count(*) / (SELECT count(*) FROM ref_pred_health) AS ref_share
                  FROM ref_pred_health GROUP BY 1),
         c AS (SELECT predicted_class AS class, count(*) / (SELECT count(*) FROM prod_pred_health) AS cur_share
                  FROM prod_pred_health GROUP BY 1)
    SELECT coalesce(r.class, c.class) AS class, round(coalesce(ref_share, 0.0), 6) AS reference_share,
           round(coalesce(cur_share, 0.0), 6) AS current_share,
           round(coalesce(cur_share, 0.0) - coalesce(ref_share, 0.0), 6) AS change,
           abs(coalesce(cur_share, 0.0) - coalesce(ref_share, 0.0)) >= 0.05 AS flagged
    FROM r FULL OUTER JOIN c ON r.class = c.class""",
)
def share_change_flags(spark, sf_dir):
    return D.share_change_flags(scored(spark, sf_dir), "health_class", 0.05)


@register(
    "feature_skew",
    f"""WITH t AS (SELECT obs_id, {V.derived_features()['water_quality_index']} AS wqi_train,
                          {V.derived_features(0.5, 32.0)['water_quality_index']} AS wqi_serve FROM observations)
    SELECT count(*) AS rows, CAST(sum(CASE WHEN abs(wqi_train - wqi_serve) > 1e-12 THEN 1 ELSE 0 END) AS BIGINT) AS rows_differing,
           round(max(abs(wqi_train - wqi_serve)), 6) AS max_abs_diff, round(avg(abs(wqi_train - wqi_serve)), 6) AS mean_abs_diff
    FROM t""",
)
def feature_skew(spark, sf_dir):
    obs = X.observations(spark, sf_dir)
    t = obs.select(
        "obs_id",
        C.water_quality_index(S.TRAINING_FEATURE_CONSTANTS).alias("wqi_train"),
        C.water_quality_index(S.SERVING_FEATURE_CONSTANTS).alias("wqi_serve"),
    )
    return D.feature_skew(t, "wqi_train", "wqi_serve")

