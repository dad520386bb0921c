"""Group I queries: preprocessing fits, metrics, model tables and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool import schema as S
from tidepool.operators import metrics as M
from tidepool.operators import preprocess as P
from tidepool.plans import sqlviews as V
from tidepool.plans.registry import also, register
from tidepool.sources import fixtures as X


def _dim(classes, a="class_order", b="class"):
    return "(SELECT * FROM (VALUES " + ", ".join(f"({i}, {V.q(c)})" for i, c in enumerate(classes)) + f") t({a}, {b}))"


_CONFUSION_SQL = (
    f"""WITH c AS (SELECT y_true, y_pred, count(*) AS n FROM scored_health GROUP BY 1, 2)
    SELECT t.true_order, t.y_true, p.pred_order, p.y_pred, CAST(coalesce(c.n, 0) AS BIGINT) AS n
    FROM {_dim(S.HEALTH_CLASSES, 'true_order', 'y_true')} t CROSS JOIN {_dim(S.HEALTH_CLASSES, 'pred_order', 'y_pred')} p
    LEFT JOIN c ON c.y_true = t.y_true AND c.y_pred = p.y_pred"""
)


def _per_class_sql(src: str, group: str = "") -> str:
    g = f"{group}, " if group else ""
    gj = f" AND s.{group} = p.{group}" if group else ""
    return f"""cc AS (SELECT {g}y_true, y_pred, count(*) AS n FROM {src} GROUP BY ALL),
    sup AS (SELECT {g}y_true AS class, sum(n) AS support, sum(CASE WHEN y_true = y_pred THEN n ELSE 0 END) AS tp FROM cc GROUP BY ALL),
    prd AS (SELECT {g}y_pred AS class, sum(n) AS predicted FROM cc GROUP BY ALL),
    x AS (SELECT {"coalesce(s." + group + ", p." + group + ") AS " + group + ", " if group else ""}coalesce(s.class, p.class) AS class,
                 coalesce(tp, 0) AS tp, coalesce(support, 0) AS support, coalesce(predicted, 0) AS predicted
          FROM sup s FULL OUTER JOIN prd p ON s.class = p.class{gj}),
    pc AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
                     CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM x),
    pcf AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM pc)"""


def _metrics_select(group: str = "", digits: int | None = 4) -> str:
    """Scalar metrics; no digits keep them whole, as gates compare them."""
    g = f"{group}, " if group else ""

    def shown(e: str) -> str:
        return e if digits is None else f"round({e}, {digits})"

    return f"""SELECT {g}{shown('sum(tp) / sum(support)')} AS accuracy,
       {shown('avg(CASE WHEN support > 0 THEN recall END)')} AS balanced_accuracy,
       {shown('avg(precision)')} AS macro_precision, {shown('avg(recall)')} AS macro_recall,
       {shown('avg(f1)')} AS macro_f1, {shown('sum(f1 * support) / sum(support)')} AS weighted_f1,
       CAST(sum(support) AS BIGINT) AS n
    FROM pcf {"GROUP BY " + group if group else ""}"""


@register(
    "class_weights",
    """WITH c AS (SELECT restoration_suitability, count(*) AS n_c FROM observations GROUP BY 1)
    SELECT restoration_suitability, round((SELECT sum(n_c) FROM c) / ((SELECT count(*) FROM c) * n_c), 6) AS class_weight FROM c""",
)
def class_weights(spark, sf_dir):
    w = M.class_weights(X.observations(spark, sf_dir), "restoration_suitability")
    return w.withColumn("class_weight", F.round("class_weight", 6))


# --- "algorithms": data-derived predictors evaluated on the same truth -------
_ALGO_SQL = """algo AS (
      SELECT 'threshold_rule' AS algorithm, s.y_true, s.y_pred FROM scored_health s
      UNION ALL SELECT 'centre_scorer', s.y_true, p.predicted_class FROM scored_health s JOIN predictions_health p USING (obs_id)
      UNION ALL SELECT 'region_majority', s.y_true, m.y_pred FROM scored_health s JOIN (
          SELECT region, arg_max(y_true, n * 1000000 - class_order) AS y_pred FROM (
            SELECT region, y_true, count(*) AS n,
                   CASE y_true """ + " ".join(f"WHEN {V.q(c)} THEN {i}" for i, c in enumerate(S.HEALTH_CLASSES)) + """ END AS class_order
            FROM scored_health GROUP BY 1, 2) GROUP BY region) m USING (region))"""


_MODEL_METRICS_SQL = "WITH " + _ALGO_SQL + ",\n" + _per_class_sql("algo", "algorithm") + "\n" + _metrics_select("algorithm")
_WHOLE_METRICS_SQL = "WITH " + _ALGO_SQL + ",\n" + _per_class_sql("algo", "algorithm") + "\n" + _metrics_select("algorithm", None)


# --- preprocessing fits (training split only in the pipeline; whole table here)
@register(
    "impute_median",
    "SELECT " + ", ".join(f"round(median({c}), 6) AS {c}" for c in S.SENSOR_COLUMNS) + " FROM observations_dirty",
)
def impute_median(spark, sf_dir):
    return P.fit_medians(X.observations_dirty(spark, sf_dir), S.SENSOR_COLUMNS)


@register("impute_mode", "SELECT mode(region ORDER BY region) AS region, count(DISTINCT region) AS categories FROM observations_dirty")
def impute_mode(spark, sf_dir):
    return P.fit_mode(X.observations_dirty(spark, sf_dir), "region")


@register(
    "standard_scale",
    "SELECT obs_id, "
    + ", ".join(
        f"round(({c} - (SELECT avg({c}) FROM observations)) / (SELECT stddev_pop({c}) FROM observations), 6) AS {c}"
        for c in S.SENSOR_COLUMNS
    )
    + " FROM observations",
)
def standard_scale(spark, sf_dir):
    cols = S.SENSOR_COLUMNS
    obs = X.observations(spark, sf_dir)
    return P.standard_scale(obs, P.fit_scaler(obs, cols), cols).select(
        "obs_id", *[F.round(c, 6).alias(c) for c in cols]
    )


@register(
    "one_hot",
    "SELECT obs_id, "
    + ", ".join(f"CASE WHEN region = {V.q(r)} THEN 1.0 ELSE 0.0 END AS {P.onehot_name('region', r)}" for r in sorted(S.REGIONS))
    + " FROM observations_dirty",
)
def one_hot(spark, sf_dir):
    """K indicator columns from the sorted training categories; unknown -> all zeros."""
    dirty = X.observations_dirty(spark, sf_dir)
    clean = X.observations(spark, sf_dir)
    cats = P.fit_categories(clean, "region")
    return P.one_hot(dirty, "region", cats).select("obs_id", *[P.onehot_name("region", c) for c in cats])


_MEANS = ", ".join(f"avg({c}) AS {c}" for c in S.SENSOR_COLUMNS)


@register(
    "scaler_integrity",
    f"""WITH w AS (SELECT 'training' AS data, {_MEANS} FROM ref_window UNION ALL SELECT 'production', {_MEANS} FROM prod_window),
    l AS (SELECT data, "column", value FROM w UNPIVOT (value FOR "column" IN ({", ".join(S.SENSOR_COLUMNS)})))
    SELECT l.data, l."column", abs(l.value - t.value) <= 1e-4 * greatest(abs(l.value), 1e-12) AS ok
    FROM l JOIN l t ON t."column" = l."column" AND t.data = 'training'""",
)
def scaler_integrity(spark, sf_dir):
    """Means fitted on the rows before the cut date hold for those rows and fail for columns that the production shift moves."""
    from tidepool.plans.q_drift import windows

    train, production = windows(spark, sf_dir)
    fitted = P.fit_scaler(train, S.SENSOR_COLUMNS)
    out = None
    for name, data in (("training", train), ("production", production)):
        flags = P.scaler_integrity(fitted, data, S.SENSOR_COLUMNS).withColumn("data", F.lit(name))
        out = flags if out is None else out.unionByName(flags)
    long = out.unpivot(["data"], [f"{c}_ok" for c in S.SENSOR_COLUMNS], "column", "ok")
    return long.select("data", F.regexp_replace("column", "_ok$", "").alias("column"), "ok")


# --- I21: champion vs challenger gates ---------------------------------------
_GATES = S.COMPARISON_GATES["health"]
_RECALL_SQL = """rec AS (SELECT algorithm, y_true AS class, avg(CASE WHEN y_pred = y_true THEN 1.0 ELSE 0.0 END) AS recall
                   FROM algo GROUP BY 1, 2)"""


_COMPARE_SQL = (
    "WITH " + _ALGO_SQL + ",\n" + _per_class_sql("algo", "algorithm") + ",\n" + _RECALL_SQL + f""",
    m AS ({_metrics_select("algorithm", None)}),
    ch AS (SELECT * FROM m WHERE algorithm = 'threshold_rule'), cl AS (SELECT * FROM m WHERE algorithm = 'centre_scorer'),
    rr AS (SELECT max(greatest(c.recall - h.recall, 0.0)) AS worst_recall_drop FROM rec c JOIN rec h ON c.class = h.class
           WHERE c.algorithm = 'threshold_rule' AND h.algorithm = 'centre_scorer'),
    g AS (SELECT * FROM (VALUES (1, 'min_abs_macro_f1'), (2, 'max_macro_f1_regression'), (3, 'min_balanced_accuracy'),
                                (4, 'max_per_class_recall_regression')) t(gate_order, gate)),
    gx AS (SELECT g.gate_order, g.gate,
            CASE g.gate WHEN 'min_abs_macro_f1' THEN cl.macro_f1 WHEN 'max_macro_f1_regression' THEN greatest(ch.macro_f1 - cl.macro_f1, 0.0)
                        WHEN 'min_balanced_accuracy' THEN cl.balanced_accuracy ELSE rr.worst_recall_drop END AS value,
            CASE g.gate WHEN 'min_abs_macro_f1' THEN {_GATES['min_abs_macro_f1']} WHEN 'max_macro_f1_regression' THEN {_GATES['max_macro_f1_regression']}
                        WHEN 'min_balanced_accuracy' THEN {_GATES['min_balanced_accuracy']} ELSE {_GATES['max_per_class_recall_regression']} END AS threshold,
            cl.macro_f1 - ch.macro_f1 AS f1_diff
          FROM g, ch, cl, rr)
    SELECT gate_order, gate, round(value, 6) AS value, threshold,
           CASE WHEN gate LIKE 'min%' THEN value >= threshold ELSE value <= threshold END AS passed,
           CASE WHEN bool_and(CASE WHEN gate LIKE 'min%' THEN value >= threshold ELSE value <= threshold END) OVER () = false THEN 'reject'
                WHEN f1_diff <= 0 THEN 'review_required' ELSE 'eligible' END AS outcome
    FROM gx"""
)
@register(
    "champion_as_of",
    """SELECT model_name, max(version) FILTER (WHERE rn = 1) AS champion_version,
              max(version) FILTER (WHERE rn = 2) AS previous_version, count(*) AS alias_events
    FROM (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY ts DESC, version DESC) AS rn FROM alias_events)
    GROUP BY model_name""",
)
def champion_as_of(spark, sf_dir):
    """Current and previous champion per model from the append-only alias-event table:
    the two latest events per model via max_by / a top-2 per group aggregate
    (no window over a whole model's history)."""
    ev = X.alias_events(spark, sf_dir)
    top = ev.groupBy("model_name").agg(
        F.max_by("version", F.struct("ts", "version")).alias("champion_version"),
        F.max_by(F.struct("ts", "version"), F.struct("ts", "version")).alias("_last"),
        F.count(F.lit(1)).alias("alias_events"),
    )
    prev = ev.join(top.select("model_name", "_last"), "model_name").filter(
        F.struct("ts", "version") < F.col("_last")
    ).groupBy("model_name").agg(F.max_by("version", F.struct("ts", "version")).alias("previous_version"))
    return top.drop("_last").join(prev, "model_name", "left").select("model_name", "champion_version", "previous_version", "alias_events")


@register(
    "duplicate_registration_all",
    """SELECT CASE WHEN user_id % 2 = 0 THEN 'reef_health_model' ELSE 'restoration_model' END AS model_name,
           EXISTS (SELECT 1 FROM alias_events a WHERE a.run_id = 'run-' || CAST(e.event_id AS VARCHAR) AND a.version % 7 <> 0) AS registered,
           count(*) AS runs
    FROM events e GROUP BY 1, 2""",
)
def duplicate_registration_all(spark, sf_dir):
    """I24 for every run: the runs of all events, each looked up in a registration table that holds six of seven."""
    runs = X.alias_events(spark, sf_dir)
    known = runs.filter(F.col("version") % 7 != 0).select("run_id").distinct().withColumn("_known", F.lit(True))
    found = runs.select("model_name", "run_id").join(known, "run_id", "left")
    return found.groupBy("model_name", F.col("_known").isNotNull().alias("registered")).agg(F.count(F.lit(1)).alias("runs"))


def _assemble_sql() -> str:
    sensors, features = S.SENSOR_COLUMNS, S.NUMERIC_FEATURES
    fills = ", ".join(f"quantile_cont({c}, 0.5) AS {c}__fill" for c in sensors)
    known = ", ".join(f"avg({c}) AS {c}__mean, stddev_pop({c}) AS {c}__std" for c in features)
    filled = ", ".join(f"coalesce({c}, {c}__fill) AS {c}" for c in sensors)
    # off the middle between two rounded values
    scaled = ", ".join(f"round(({c} - {c}__mean) / {c}__std + 1e-9, 6) AS {c}" for c in features)
    hot = ", ".join(f"CASE WHEN region = {V.q(r)} THEN 1.0 ELSE 0.0 END AS {P.onehot_name('region', r)}" for r in sorted(S.REGIONS))
    return f"""WITH f AS (SELECT {fills} FROM ref_window), t AS (SELECT {', '.join(sensors)}, {V.derived_select()} FROM ref_window), m AS (SELECT {known} FROM t),
    i AS (SELECT obs_id, region, {filled} FROM observations_dirty, f), d AS (SELECT *, {V.derived_select()} FROM i)
    SELECT obs_id, {scaled}, {hot} FROM d, m"""


@register("assemble_features", _assemble_sql())
def assemble_features(spark, sf_dir):
    """All imputed, scaled and one-hot features of damaged rows, everything fitted on the rows before the cut date."""
    from tidepool.plans.q_drift import windows

    fitted = P.fit_preparation(windows(spark, sf_dir)[0])
    out = fitted.apply(X.observations_dirty(spark, sf_dir))
    return out.select("obs_id", *[F.round(F.col(f"num__{c}") + 1e-9, 6).alias(c) for c in S.NUMERIC_FEATURES], *[P.onehot_name("region", r) for r in fitted.categories])


def _promotion_sql(approver: str, reason: str, force: bool, dry_run: bool) -> str:
    cmp_sql = _COMPARE_SQL
    return f"""WITH c AS (SELECT * FROM ({cmp_sql})),
    o AS (SELECT max(outcome) AS outcome, bool_and(passed) AS gates_ok FROM c)
    SELECT outcome, gates_ok,
      CASE WHEN trim({V.q(approver)}) = '' OR trim({V.q(reason)}) = '' THEN 'blocked_missing_approval'
           WHEN outcome = 'reject' THEN 'blocked_rejected'
           WHEN outcome = 'review_required' AND NOT {str(force).lower()} THEN 'blocked_review_required'
           WHEN NOT gates_ok THEN 'blocked_gates'
           WHEN {str(dry_run).lower()} THEN 'dry_run_ok'
           ELSE 'promote' END AS decision
    FROM o"""


_PROMOTION = {"approver": "reef-ops", "reason": "scheduled review", "force": False, "dry_run": True}


def _decision():
    a, r, force, dry = (_PROMOTION[k] for k in ("approver", "reason", "force", "dry_run"))
    return (
        F.when(F.lit(a.strip() == "" or r.strip() == ""), "blocked_missing_approval")
        .when(F.col("outcome") == "reject", "blocked_rejected")
        .when((F.col("outcome") == "review_required") & F.lit(not force), "blocked_review_required")
        .when(~F.col("gates_ok"), "blocked_gates")
        .when(F.lit(dry), "dry_run_ok")
        .otherwise("promote")
    )


# --- the queries above for both tasks, with each task's own classes and gates --
def _for_task(sql: str, task: str) -> str:
    """A body over the health views, over those of `task`."""
    def orders(t):
        return " ".join(f"WHEN {V.q(c)} THEN {i}" for i, c in enumerate(S.TASK_CLASSES[t]))

    for name in ("scored", "predictions"):
        sql = sql.replace(f"{name}_health", f"{name}_{task}")
    for a, b in (("true_order", "y_true"), ("pred_order", "y_pred")):
        sql = sql.replace(_dim(S.HEALTH_CLASSES, a, b), _dim(S.TASK_CLASSES[task], a, b))
    return sql.replace(orders("health"), orders(task)).replace(_thresholds_sql("health"), _thresholds_sql(task))


def _thresholds_sql(task: str) -> str:
    g = S.COMPARISON_GATES[task]
    return f"""CASE g.gate WHEN 'min_abs_macro_f1' THEN {g['min_abs_macro_f1']} WHEN 'max_macro_f1_regression' THEN {g['max_macro_f1_regression']}
                        WHEN 'min_balanced_accuracy' THEN {g['min_balanced_accuracy']} ELSE {g['max_per_class_recall_regression']} END AS threshold"""


assert _thresholds_sql("health") in _COMPARE_SQL


def both_tasks_sql(body) -> str:
    return " UNION ALL ".join(f"SELECT {V.q(t)} AS task, * FROM ({body(t)})" for t in S.TASK_CLASSES)


def task_predictions(spark, sf_dir):
    """(task, algorithm, y_true, y_pred) of every row and task from one scored pass; only the majority table is joined to it."""
    from tidepool.operators.profile import majority_by_group

    scored = X.scored_tasks(spark, sf_dir).withColumn("place", F.struct("task", "region"))
    maj = majority_by_group(scored, "place", "y_true", S.HEALTH_CLASSES + S.RESTORATION_CLASSES)
    one = scored.join(F.broadcast(maj), "place")
    names = {"threshold_rule": "y_pred", "centre_scorer": "predicted_class", "region_majority": "majority"}
    each = F.explode(F.array(*[F.struct(F.lit(a).alias("algorithm"), F.col(c).alias("y_pred")) for a, c in names.items()]))
    return one.select("task", "y_true", each.alias("a")).select("task", "a.algorithm", "y_true", "a.y_pred")


@register("confusion_matrix_by_task", both_tasks_sql(lambda t: _for_task(_CONFUSION_SQL, t)))
def confusion_matrix_by_task(spark, sf_dir):
    counts = M.confusion_counts(X.scored_tasks(spark, sf_dir), "y_true", "y_pred", ["task"])
    cells = [(t, i, a, j, b) for t, cs in S.TASK_CLASSES.items() for i, a in enumerate(cs) for j, b in enumerate(cs)]
    grid = F.broadcast(spark.createDataFrame(cells, "task string, true_order int, y_true string, pred_order int, y_pred string"))
    out = grid.join(counts, ["task", "y_true", "y_pred"], "left").na.fill(0, ["n"])
    return out.select("task", "true_order", "y_true", "pred_order", "y_pred", F.col("n").cast("long"))


@register("classification_metrics_by_task", both_tasks_sql(lambda t: f"WITH {_per_class_sql(f'scored_{t}')} {_metrics_select()}"))
def classification_metrics_by_task(spark, sf_dir):
    return M.classification_metrics(X.scored_tasks(spark, sf_dir), "y_true", "y_pred", ["task"])


@register(
    "per_class_metrics_by_task",
    both_tasks_sql(lambda t: f"""WITH {_per_class_sql(f'scored_{t}')} SELECT class, round(precision, 4) AS precision, round(recall, 4) AS recall,
        round(f1, 4) AS f1, CAST(support AS BIGINT) AS support FROM pcf"""),
)
def per_class_metrics_by_task(spark, sf_dir):
    pc = M.per_class(X.scored_tasks(spark, sf_dir), "y_true", "y_pred", ["task"])
    return pc.select("task", "class", *[F.round(c, 4).alias(c) for c in ("precision", "recall", "f1")], F.col("support").cast("long").alias("support"))


def whole_metrics(spark, sf_dir):
    """model_metrics before rounding: what ranks and gates compare."""
    return M.classification_metrics(task_predictions(spark, sf_dir), "y_true", "y_pred", ["task", "algorithm"], None)


@register("model_metrics_by_task", both_tasks_sql(lambda t: _for_task(_MODEL_METRICS_SQL, t)))
def model_metrics_by_task(spark, sf_dir):
    return M.classification_metrics(task_predictions(spark, sf_dir), "y_true", "y_pred", ["task", "algorithm"])


@register(
    "leaderboard_by_task",
    both_tasks_sql(lambda t: f"""SELECT CAST(row_number() OVER w AS INTEGER) AS position, algorithm, round(macro_f1, 4) AS macro_f1, round(balanced_accuracy, 4) AS balanced_accuracy, round(accuracy, 4) AS accuracy,
        row_number() OVER w = 1 AS champion FROM ({_for_task(_WHOLE_METRICS_SQL, t)}) m
        WINDOW w AS (ORDER BY m.macro_f1 DESC, m.balanced_accuracy DESC, algorithm)"""),
)
def leaderboard_by_task(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("task").orderBy(F.desc("macro_f1"), F.desc("balanced_accuracy"), "algorithm")
    m = whole_metrics(spark, sf_dir).withColumn("position", F.row_number().over(w).cast("int"))
    return m.select("task", "position", "algorithm", *[F.round(c, 4).alias(c) for c in ("macro_f1", "balanced_accuracy", "accuracy")], (F.col("position") == 1).alias("champion"))


@register(
    "argmax_model",
    both_tasks_sql(lambda t: f"""SELECT arg_max(algorithm, (macro_f1, balanced_accuracy, algorithm)) AS best_algorithm, round(max(macro_f1), 4) AS best_macro_f1
        FROM ({_for_task(_WHOLE_METRICS_SQL, t)})"""),
)
def argmax_model(spark, sf_dir):
    """The best algorithm of each task by whole macro-F1, then balanced accuracy."""
    best = F.max_by("algorithm", F.struct("macro_f1", "balanced_accuracy", "algorithm")).alias("best_algorithm")
    return whole_metrics(spark, sf_dir).groupBy("task").agg(best, F.round(F.max("macro_f1"), 4).alias("best_macro_f1"))


def _gate_sql(task: str) -> str:
    f1, balanced = S.QUALITY_GATES[task]
    return f"""SELECT algorithm, macro_f1 >= {f1} AS f1_ok, balanced_accuracy >= {balanced} AS balanced_accuracy_ok,
        macro_f1 >= {f1} AND balanced_accuracy >= {balanced} AS passed,
        concat_ws(',', CASE WHEN macro_f1 < {f1} THEN 'macro_f1' END, CASE WHEN balanced_accuracy < {balanced} THEN 'balanced_accuracy' END) AS failures
        FROM ({_for_task(_WHOLE_METRICS_SQL, task)})"""


@register("quality_gate_by_task", both_tasks_sql(_gate_sql))
def quality_gate_by_task(spark, sf_dir):
    least = F.create_map(*[x for t, gates in S.QUALITY_GATES.items() for x in (F.lit(t), F.array(*map(F.lit, gates)))])[F.col("task")]
    low = {c: F.col(c) < least[i] for i, c in enumerate(("macro_f1", "balanced_accuracy"))}
    return whole_metrics(spark, sf_dir).select(
        "task", "algorithm", (~low["macro_f1"]).alias("f1_ok"), (~low["balanced_accuracy"]).alias("balanced_accuracy_ok"),
        (~low["macro_f1"] & ~low["balanced_accuracy"]).alias("passed"),
        F.concat_ws(",", *[F.when(x, F.lit(c)) for c, x in low.items()]).alias("failures"),
    )


@register("compare_champion_by_task", both_tasks_sql(lambda t: _for_task(_COMPARE_SQL, t)))
def compare_champion_by_task(spark, sf_dir):
    """compare_champion with the gates of each task; one row per task and gate."""
    from pyspark.sql import Window

    preds = task_predictions(spark, sf_dir)
    counts = M.confusion_counts(preds, "y_true", "y_pred", ["task", "algorithm"])
    m = M.metrics_of_counts(counts, ["task", "algorithm"], None)
    old, new = (F.col("algorithm") == a for a in ("threshold_rule", "centre_scorer"))
    f1 = m.groupBy("task").agg(F.max(F.when(old, F.col("macro_f1"))).alias("ch_f1"), F.max(F.when(new, F.col("macro_f1"))).alias("cl_f1"), F.max(F.when(new, F.col("balanced_accuracy"))).alias("cl_bal"))
    # recall from the same counts
    right = F.when(F.col("y_pred") == F.col("y_true"), F.col("n")).otherwise(F.lit(0))
    recall = counts.groupBy("task", "y_true").agg(*[(F.sum(F.when(a, right)) / F.sum(F.when(a, F.col("n")))).alias(c) for c, a in (("ch", old), ("cl", new))])
    drop = recall.groupBy("task").agg(F.max(F.greatest(F.col("ch") - F.col("cl"), F.lit(0.0))).alias("drop"))
    values = {
        "min_abs_macro_f1": F.col("cl_f1"),
        "max_macro_f1_regression": F.greatest(F.col("ch_f1") - F.col("cl_f1"), F.lit(0.0)),
        "min_balanced_accuracy": F.col("cl_bal"),
        "max_per_class_recall_regression": F.col("drop"),
    }

    def limit(gate):
        return F.create_map(*[x for t, g in S.COMPARISON_GATES.items() for x in (F.lit(t), F.lit(g[gate]))])[F.col("task")]

    gates = F.array(*[
        F.struct(F.lit(i).alias("gate_order"), F.lit(g).alias("gate"), v.alias("value"), limit(g).alias("threshold"), (v >= limit(g) if g.startswith("min") else v <= limit(g)).alias("passed"))
        for i, (g, v) in enumerate(values.items(), 1)
    ])
    t = f1.join(drop, "task").select("task", (F.col("cl_f1") - F.col("ch_f1")).alias("f1_diff"), F.explode(gates).alias("g")).select("task", "f1_diff", "g.*")
    all_ok = F.bool_and("passed").over(Window.partitionBy("task"))  # over the 4 gate rows
    outcome = F.when(~all_ok, "reject").when(F.col("f1_diff") <= 0, "review_required").otherwise("eligible")
    return t.select("task", "gate_order", "gate", F.round("value", 6).alias("value"), "threshold", "passed", outcome.alias("outcome"))


@register("promotion_decision_by_task", both_tasks_sql(lambda t: _promotion_sql(**_PROMOTION).replace(_COMPARE_SQL, _for_task(_COMPARE_SQL, t))))
def promotion_decision_by_task(spark, sf_dir):
    o = compare_champion_by_task(spark, sf_dir).groupBy("task").agg(F.max("outcome").alias("outcome"), F.bool_and("passed").alias("gates_ok"))
    return o.select("task", "outcome", "gates_ok", _decision().alias("decision"))


# --- I21, I22 over every pair of algorithms and every kind of request -------------
#: request -> (approver, reason, force, dry run)
REQUESTS = {
    "dry_run": ("reef-ops", "scheduled review", False, True),
    "promote": ("reef-ops", "scheduled review", False, False),
    "forced": ("reef-ops", "reviewed by hand", True, False),
    "no_approver": ("  ", "scheduled review", True, False),
    "no_reason": ("reef-ops", "", False, False),
}


def _pairs_sql(task: str) -> str:
    g = S.COMPARISON_GATES[task]
    requests = ", ".join(f"({V.q(n)}, {V.q(a)}, {V.q(r)}, {str(f).lower()}, {str(d).lower()})" for n, (a, r, f, d) in REQUESTS.items())
    algo = _for_task("WITH " + _ALGO_SQL + ",\n" + _per_class_sql("algo", "algorithm"), task)
    return f"""{algo},
    m AS ({_metrics_select("algorithm", None)}), {_RECALL_SQL},
    p AS (SELECT a.algorithm AS champion, b.algorithm AS challenger, a.macro_f1 AS old_f1, b.macro_f1 AS new_f1, b.balanced_accuracy AS new_balanced,
            (SELECT max(greatest(x.recall - y.recall, 0.0)) FROM rec x JOIN rec y USING (class) WHERE x.algorithm = a.algorithm AND y.algorithm = b.algorithm) AS drop FROM m a, m b),
    o AS (SELECT *, new_f1 >= {g['min_abs_macro_f1']} AND greatest(old_f1 - new_f1, 0.0) <= {g['max_macro_f1_regression']} AND new_balanced >= {g['min_balanced_accuracy']}
            AND drop <= {g['max_per_class_recall_regression']} AS gates_ok FROM p),
    c AS (SELECT *, CASE WHEN NOT gates_ok THEN 'reject' WHEN new_f1 - old_f1 <= 0 THEN 'review_required' ELSE 'eligible' END AS outcome FROM o)
    SELECT champion, challenger, request, outcome, gates_ok, CASE WHEN trim(approver) = '' OR trim(reason) = '' THEN 'blocked_missing_approval' WHEN outcome = 'reject' THEN 'blocked_rejected'
      WHEN outcome = 'review_required' AND NOT force THEN 'blocked_review_required' WHEN dry THEN 'dry_run_ok' ELSE 'promote' END AS decision
    FROM c, (VALUES {requests}) r(request, approver, reason, force, dry)"""


@register("promotion_requests", both_tasks_sql(_pairs_sql))
def promotion_requests(spark, sf_dir):
    """The decision on every request for every pair of champion and challenger. The pairs come from one row an algorithm and class; the predictions are counted once."""
    counts = M.confusion_counts(task_predictions(spark, sf_dir), "y_true", "y_pred", ["task", "algorithm"])
    m = M.metrics_of_counts(counts, ["task", "algorithm"], None).select("task", "algorithm", "macro_f1", "balanced_accuracy")
    right = F.when(F.col("y_pred") == F.col("y_true"), F.col("n")).otherwise(F.lit(0))
    recall = counts.groupBy("task", "algorithm", F.col("y_true").alias("class")).agg((F.sum(right) / F.sum("n")).alias("recall"))

    def side(df, name):
        return df.select("task", *[F.col(c).alias(name if c == "algorithm" else c if c == "class" else f"{name}_{c}") for c in df.columns if c != "task"])

    drop = side(recall, "champion").join(side(recall, "challenger"), ["task", "class"]).groupBy("task", "champion", "challenger")
    drop = drop.agg(F.max(F.greatest(F.col("champion_recall") - F.col("challenger_recall"), F.lit(0.0))).alias("drop"))
    pairs = side(m, "champion").join(side(m, "challenger"), "task").join(drop, ["task", "champion", "challenger"])

    def limit(gate):
        return F.create_map(*[x for t, g in S.COMPARISON_GATES.items() for x in (F.lit(t), F.lit(g[gate]))])[F.col("task")]

    old, new = F.col("champion_macro_f1"), F.col("challenger_macro_f1")
    ok = (new >= limit("min_abs_macro_f1")) & (F.greatest(old - new, F.lit(0.0)) <= limit("max_macro_f1_regression"))
    ok = ok & (F.col("challenger_balanced_accuracy") >= limit("min_balanced_accuracy")) & (F.col("drop") <= limit("max_per_class_recall_regression"))
    pairs = pairs.withColumn("gates_ok", ok).withColumn("outcome", F.when(~F.col("gates_ok"), "reject").when(new - old <= 0, "review_required").otherwise("eligible"))
    requests = spark.createDataFrame([(n, *r) for n, r in REQUESTS.items()], "request string, approver string, reason string, force boolean, dry boolean")
    asked = pairs.crossJoin(F.broadcast(requests))  # a few rows each
    decision = (
        F.when((F.trim("approver") == "") | (F.trim("reason") == ""), "blocked_missing_approval")
        .when(F.col("outcome") == "reject", "blocked_rejected")
        .when((F.col("outcome") == "review_required") & ~F.col("force"), "blocked_review_required")
        .when(F.col("dry"), "dry_run_ok")
        .otherwise("promote")
    )
    return asked.select("task", "champion", "challenger", "request", "outcome", "gates_ok", decision.alias("decision"))


@register(
    "rollback_requests",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY ts DESC, version DESC) AS rn FROM alias_events),
    c AS (SELECT model_name, max(version) FILTER (WHERE rn = 1) AS champion, max(version) FILTER (WHERE rn = 2) AS previous, max(version) AS newest FROM r GROUP BY 1),
    q AS (SELECT model_name, 'current' AS request, champion AS target FROM c UNION ALL SELECT model_name, 'previous', previous FROM c
          UNION ALL SELECT model_name, 'unheard_of', newest + 1000000 FROM c UNION ALL SELECT model_name, 'unnamed', NULL FROM c
          UNION ALL SELECT a.model_name, 'other_model', b.champion FROM c a JOIN c b ON a.model_name <> b.model_name)
    SELECT q.model_name, request, target, champion,
      CASE WHEN target IS NULL THEN 'blocked_no_target' WHEN NOT EXISTS (SELECT 1 FROM alias_events e WHERE e.model_name = q.model_name AND e.version = target) THEN 'blocked_unknown_version'
           WHEN target = champion THEN 'nothing_to_do' ELSE 'roll_back' END AS decision
    FROM q JOIN c USING (model_name)""",
)
def rollback_requests(spark, sf_dir):
    """Rollbacks to a version need one that the model has had; the current one is nothing to do. Every kind of request for each model."""
    events = X.alias_events(spark, sf_dir)
    newest = events.groupBy("model_name").agg(F.max("version").alias("newest"))
    c = champion_as_of(spark, sf_dir).join(newest, "model_name").select("model_name", F.col("champion_version").alias("champion"), F.col("previous_version").alias("previous"), "newest")
    own = {"current": F.col("champion"), "previous": F.col("previous"), "unheard_of": F.col("newest") + 1000000, "unnamed": F.lit(None).cast("long")}
    asked = c.select("model_name", F.explode(F.array(*[F.struct(F.lit(n).alias("request"), v.alias("target")) for n, v in own.items()])).alias("q")).select("model_name", "q.*")
    other = c.select("model_name").join(c.select(F.col("model_name").alias("_other"), F.col("champion").alias("target")), F.col("model_name") != F.col("_other"))  # a row a model
    asked = asked.unionByName(other.select("model_name", F.lit("other_model").alias("request"), "target"))
    had = events.select("model_name", F.col("version").alias("target")).join(F.broadcast(asked.select("model_name", "target")), ["model_name", "target"], "left_semi").distinct().withColumn("_had", F.lit(True))
    out = asked.join(had, ["model_name", "target"], "left").join(c.select("model_name", "champion"), "model_name")
    decision = F.when(F.col("target").isNull(), "blocked_no_target").when(F.col("_had").isNull(), "blocked_unknown_version").when(F.col("target") == F.col("champion"), "nothing_to_do").otherwise("roll_back")
    return out.select("model_name", "request", "target", "champion", decision.alias("decision"))


#: SQL bodies that other queries' oracles read.
ORACLE_BODIES = {"model_metrics": both_tasks_sql(lambda t: _for_task(_MODEL_METRICS_SQL, t)), "quality_gate": both_tasks_sql(_gate_sql)}
for _name in ("confusion_matrix", "classification_metrics", "per_class_metrics", "model_metrics", "leaderboard", "quality_gate", "compare_champion", "promotion_decision"):
    also(_name, f"{_name}_by_task")
also("duplicate_registration", "duplicate_registration_all")
model_metrics, quality_gate = model_metrics_by_task, quality_gate_by_task
