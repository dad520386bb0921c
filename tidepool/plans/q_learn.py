"""Queries that fit, compare and apply classifiers over the observation table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool import schema as S
from tidepool.functions import columns as C
from tidepool.operators import drift as D
from tidepool.operators import learning as L
from tidepool.operators import metrics as M
from tidepool.operators import ml as ML
from tidepool.plans import sqlviews as V
from tidepool.plans.registry import register
from tidepool.sources import fixtures as X
from tidepool.sources import io as IO

_ROWS: dict[tuple, tuple] = {}


def learning(spark, sf_dir, folds: int = L.FOLDS):
    """(learning rows, their digest), written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, folds)
    if key not in _ROWS:
        rows = L.learning_rows(X.observations(spark, sf_dir), folds)
        _ROWS[key] = rows, ML.fingerprint_rows(rows)
    return _ROWS[key]


def final_models(spark, sf_dir, algorithm, quick=False, folds: int = L.FOLDS):
    rows, digest = learning(spark, sf_dir, folds)
    return rows, ML.Store(spark).models(rows, digest, algorithm, ML.final_fits(folds), quick)


def _both(of):
    """The rows that `of` gives for each task, with the task."""
    out = None
    for task in S.TASK_CLASSES:
        own = of(task).withColumn("task", F.lit(task))
        out = own if out is None else out.unionByName(own)
    return out


@register("train_logistic")
def train_logistic(spark, sf_dir):
    """Multinomial LR (balanced weights) of each task fitted on its training split; metrics of the test split."""
    rows, models = final_models(spark, sf_dir, "logistic_regression")
    passes = F.create_map(*[x for t in S.TASK_CLASSES for x in (F.lit(t), F.lit(models[f"{t}/final"].passes))])
    return ML.test_metrics(rows, models, "logistic_regression").withColumn("iterations", passes[F.col("task")])


@register("train_forest")
def train_forest(spark, sf_dir):
    """200 trees of depth 12 with at least 4 rows a leaf (balanced weights) of each task; metrics of the test split."""
    rows, models = final_models(spark, sf_dir, "random_forest")
    return ML.test_metrics(rows, models, "random_forest")


@register("train_boosted")
def train_boosted(spark, sf_dir):
    """300 rounds of depth 6 for each class against the rest (balanced weights); metrics of the test split."""
    rows, models = final_models(spark, sf_dir, "boosted_trees")
    return ML.test_metrics(rows, models, "boosted_trees")


@register("score_batch")
def score_batch(spark, sf_dir):
    """Stored model of each task applied to its test split: class, probability map, confidence."""
    rows, models = final_models(spark, sf_dir, "logistic_regression")
    test = {t: rows.where(F.col(f"part_{t}") == 0).select("obs_id", "region", *S.SENSOR_COLUMNS) for t in S.TASK_CLASSES}
    return _both(lambda t: ML.score(models[f"{t}/final"], test[t]))


@register("feature_importance")
def feature_importance(spark, sf_dir):
    """Importance of each feature of each task's stored logistic regression and forest."""
    out = None
    for algorithm in ("logistic_regression", "random_forest"):
        _, models = final_models(spark, sf_dir, algorithm)
        own = _both(lambda t: ML.importance(spark, models[f"{t}/final"])).withColumn("algorithm", F.lit(algorithm))
        out = own if out is None else out.unionByName(own)
    return out


def _rounded(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


@register("cross_validate")
def cross_validate(spark, sf_dir):
    """I12 of the logistic regressions: five folds of each task's training rows, each with a preparation of its own; mean and population deviation."""
    rows, _ = learning(spark, sf_dir)
    summary = ML.cv_summary(ML.cross_validate(rows, ("logistic_regression",)))
    return _rounded(summary, *[f"cv_{c}_{s}" for c in ("macro_f1", "balanced_accuracy") for s in ("mean", "std")])


@register("cross_validate_folds")
def cross_validate_folds(spark, sf_dir):
    """The folds behind cross_validate."""
    rows, _ = learning(spark, sf_dir)
    return _rounded(ML.cross_validate(rows, ("logistic_regression",)), "macro_f1", "balanced_accuracy", "accuracy")


def _fold_sql(task: str, label: str, folds: int) -> str:
    h = f"md5('42|{task}|' || obs_id)"
    return f"""SELECT *, row_number() OVER w AS r, count(*) OVER (PARTITION BY {label}) AS n FROM observations_dirty_once
        WINDOW w AS (PARTITION BY {label} ORDER BY {h}, obs_id)"""


def _fold_preparation_sql(folds: int = L.FOLDS) -> str:
    once = "observations_dirty_once AS (SELECT DISTINCT * FROM observations_dirty)"
    parts, stats = [], []
    for task, label in S.TASK_TARGET.items():
        first = "floor(n * 0.2 + 0.5)"
        cuts = " + ".join(f"CASE WHEN r > {first} + floor((n - {first}) * {j} / {folds}) THEN 1 ELSE 0 END" for j in range(folds))
        parts.append(f"p_{task} AS (SELECT *, {cuts} AS part FROM ({_fold_sql(task, label, folds)}))")
        sensors = ", ".join(S.SENSOR_COLUMNS)
        stats.append(f"""l_{task} AS (SELECT part, "column", value FROM (SELECT part, {', '.join(f'coalesce({c}, double {chr(39)}nan{chr(39)}) AS {c}' for c in S.SENSOR_COLUMNS)} FROM p_{task} WHERE part > 0) UNPIVOT (value FOR "column" IN ({sensors}))),
        t_{task} AS (SELECT f.fold, "column", CASE WHEN isnan(value) THEN NULL ELSE value END AS value FROM l_{task} JOIN range(1, {folds + 1}) f(fold) ON f.fold <> part),
        m_{task} AS (SELECT fold, "column", quantile_cont(value, 0.5) AS median FROM t_{task} GROUP BY ALL),
        s_{task} AS (SELECT {V.q(task)} AS task, CAST(t.fold AS INTEGER) AS fold, t."column", round(any_value(median), 6) AS median, round(avg(coalesce(value, median)) + 1e-9, 6) AS mean,
            round(stddev_pop(coalesce(value, median)) + 1e-9, 6) AS std FROM t_{task} t JOIN m_{task} m ON m.fold = t.fold AND m."column" = t."column" GROUP BY ALL)""")
    return f"WITH {once}, {', '.join(parts)}, {', '.join(stats)} SELECT * FROM s_health UNION ALL SELECT * FROM s_restoration"


@register("fold_preparation", _fold_preparation_sql())
def fold_preparation(spark, sf_dir):
    """Fill value, mean and deviation of each sensor as each fold's model knows them: from damaged rows of the other folds only."""
    rows = L.learning_rows(X.observations_dirty(spark, sf_dir).distinct())
    fits = ML.fold_fits()
    design = L.prepare(rows, fits)
    out = []
    for f in fits:
        p = design.preparation(f)
        # off the middle between two rounded values
        out += [(f.task, f.judge[0], c, p.medians[c], p.means[c] + 1e-9, p.stds[c] + 1e-9) for c in S.SENSOR_COLUMNS]
    return _rounded(spark.createDataFrame(out, "task string, fold int, column string, median double, mean double, std double"), "median", "mean", "std")


@register("select_best_model")
def select_best_model(spark, sf_dir):
    """I17 with the light trees and three folds of the reference's quick mode: an evaluation row per task and algorithm, test metrics of the stored models, the best marked."""
    rows, digest = learning(spark, sf_dir, ML.QUICK_FOLDS)
    best = ML.compare_algorithms(rows, digest, ML.QUICK_FOLDS, quick=True)
    return _rounded(best, *[c for c in best.columns if c.startswith(("cv_", "test_"))])


def _held_out(spark, sf_dir, fits, name):
    rows, _ = learning(spark, sf_dir)
    design = L.prepare(rows, fits)
    m = M.metrics_of_counts(ML.judged(design, fits, ML.fit_models(design, fits, "logistic_regression")), ["fit", "task"])
    key = F.substring_index("fit", "/", -1).alias(name)
    return m.select("task", key, "macro_f1", "balanced_accuracy", "accuracy", "n")


@register("leave_one_region_out")
def leave_one_region_out(spark, sf_dir):
    """Logistic regression fitted on all other regions, judged on the region left out."""
    return _held_out(spark, sf_dir, ML.region_fits(S.REGIONS), "region")


@register("temporal_holdout")
def temporal_holdout(spark, sf_dir):
    """Logistic regression fitted on the years up to each, judged on all later years."""
    rows, _ = learning(spark, sf_dir)
    years = [r[0] for r in rows.select("year").distinct().collect() if r[0] is not None]  # calendar years
    return _held_out(spark, sf_dir, ML.year_fits(years), "last_training_year").withColumn("last_training_year", F.col("last_training_year").cast("int"))


# --- the columns that the label formulas read: fixed values ------------------------
LABEL_INPUTS = {
    "health": ("water_temperature_c", "ph", "dissolved_oxygen_mg_l", "turbidity_ntu", "bleaching_percentage", "disease_percentage", "coral_cover_percentage"),
    "restoration": ("water_temperature_c", "ph", "light_intensity", "hard_substrate_percentage", "current_speed_m_s", "turbidity_ntu", "depth_m", "coral_cover_percentage"),
}
BIOLOGICAL = ("coral_cover_percentage", "bleaching_percentage", "disease_percentage")


def feature_subsets(task: str) -> dict[str, tuple[str, ...]]:
    sensors = tuple(S.SENSOR_COLUMNS)
    return {
        "all": tuple(S.ALL_FEATURES),
        "numeric": tuple(S.NUMERIC_FEATURES),
        "sensors": sensors,
        "label_inputs": LABEL_INPUTS[task],
        "not_label_inputs": tuple(c for c in sensors if c not in LABEL_INPUTS[task]),
        "not_biological": tuple(c for c in sensors if c not in BIOLOGICAL),
        "derived": tuple(S.DERIVED_COLUMNS),
        "biological": BIOLOGICAL,
    }


@register("feature_ablation")
def feature_ablation(spark, sf_dir):
    """The test metrics of logistic regressions on subsets of the features, all fitted together over one design."""
    parts = tuple(range(1, L.FOLDS + 1))
    fits = [L.Fit(f"{t}/{name}", t, f"part_{t}", parts, (0,), cols) for t in S.TASK_CLASSES for name, cols in feature_subsets(t).items()]
    sizes = F.create_map(*[x for f in fits for x in (F.lit(f.name), F.lit(len(f.features)))])
    return _held_out(spark, sf_dir, fits, "subset").withColumn("features", sizes[F.concat_ws("/", "task", "subset")])


@register("drift_run")
def drift_run(spark, sf_dir):
    """Both windows scored once with the stored models, the score table written, every part of the summary from it.

    One row: sizes, feature drift, prediction and confidence drift of each task, the recommendation.
    """
    _, models = final_models(spark, sf_dir, "logistic_regression")
    named = {t: models[f"{t}/final"] for t in S.TASK_CLASSES}
    scores = scored_sides(D.sided(X.observations(spark, sf_dir)), named)
    table = IO.cut(scores, "drift-scores")
    return run_summary(spark, table)


def scored_sides(sided, models):
    """side, sensors and each task's class and confidence, from one pass over both windows."""
    out = ML.probabilities(models, sided, ["side", *S.SENSOR_COLUMNS])
    for t in models:
        out = out.withColumns({f"{t}_class": ML.top_class(t, f"_p_{t}"), f"{t}_confidence": F.round(F.array_max(f"_p_{t}"), 6)}).drop(f"_p_{t}")
    return out


def run_summary(spark, table):
    """The summary of a score table: J03 to J08 from two passes over it."""
    tasks = {t: (f"{t}_class", S.TASK_CLASSES[t]) for t in S.TASK_CLASSES}
    sensors, confidence = S.SENSOR_COLUMNS, {t: f"{t}_confidence" for t in S.TASK_CLASSES}
    d = IO.cut(D.distances(spark, D.value_counts(table, [*sensors, *confidence.values()]), [*sensors, *confidence.values()]), "drift-distances")
    share = D.drift_share(D.feature_drift(d.where(F.col("column").isin(sensors))))
    pred = D.prediction_drift(table, tasks)
    conf = D.confidence_of(d, confidence)
    one = share
    for frame, cols in ((pred, ("statistic", "p_value", "drifted")), (conf, ("statistic", "delta", "drifted"))):
        kind = "prediction" if frame is pred else "confidence"
        aggs = [F.max(F.when(F.col("task") == t, F.col(c))).alias(f"{t}_{kind}_{c}") for t in S.TASK_CLASSES for c in cols]
        if kind == "prediction":
            aggs += [F.max("n_reference").alias("reference_n"), F.max("n_current").alias("production_n"), F.bool_or("drifted").alias("prediction_drifted")]
        one = one.crossJoin(frame.agg(*aggs))  # one row each
    return one.withColumn("recommendation", C.recommendation(F.col("drifted_count") > 0, "prediction_drifted"))
