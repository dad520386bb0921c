"""Group B queries: projections and scalar functions over ``observations``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool import schema as S
from tidepool.functions import columns as C
from tidepool.operators import scalar as O
from tidepool.plans import sqlviews as V
from tidepool.plans.registry import register
from tidepool.sources import fixtures as X


def _obs(spark, sf_dir):
    return X.observations(spark, sf_dir)


def _single(name: str, expr_spark, expr_sql: str):
    @register(name, f"SELECT obs_id, round({expr_sql}, 6) AS {name} FROM observations")
    def q(spark, sf_dir):
        return _obs(spark, sf_dir).select("obs_id", F.round(expr_spark(), 6).alias(name))

    return q


_DF = V.derived_features()
_single("thermal_stress_index", C.thermal_stress_index, _DF["thermal_stress_index"])
_single("oxygen_stress_index", C.oxygen_stress_index, _DF["oxygen_stress_index"])
_single("acidity_deviation", C.acidity_deviation, _DF["acidity_deviation"])
_single("water_quality_index", C.water_quality_index, _DF["water_quality_index"])
_single("substrate_stability_score", C.substrate_stability_score, _DF["substrate_stability_score"])
_single("structural_complexity_score", C.structural_complexity_score, _DF["structural_complexity_score"])


@register("health_score", f"SELECT obs_id, round({V.health_score()}, 6) AS health_score FROM observations")
def health_score(spark, sf_dir):
    return C.with_health_score(_obs(spark, sf_dir), "health_score", 6).select("obs_id", "health_score")


@register("restoration_score", f"SELECT obs_id, round({V.restoration_score()}, 6) AS restoration_score FROM observations")
def restoration_score(spark, sf_dir):
    return C.with_restoration_score(_obs(spark, sf_dir), "restoration_score", 6).select("obs_id", "restoration_score")

_ROUNDED_DERIVED = ", ".join(f"round({e}, 6) AS {n}" for n, e in _DF.items())


@register("derived_features", f"SELECT *, {_ROUNDED_DERIVED} FROM observations")
def derived_features(spark, sf_dir):
    out = O.add_derived_features(_obs(spark, sf_dir))
    return out.withColumns({c: F.round(c, 6) for c in S.DERIVED_COLUMNS})


_SERV = V.derived_features(0.5, 32.0)


@register(
    "derived_features_serving",
    "SELECT *, " + ", ".join(f"round({e}, 6) AS {n}" for n, e in _SERV.items()) + " FROM observations",
)
def derived_features_serving(spark, sf_dir):
    out = O.add_derived_features(_obs(spark, sf_dir), S.SERVING_FEATURE_CONSTANTS)
    return out.withColumns({c: F.round(c, 6) for c in S.DERIVED_COLUMNS})


@register(
    "health_class",
    f"SELECT obs_id, round({V.health_score()}, 9) AS health_score, "
    f"{V.health_class(f'round({V.health_score()}, 9)')} AS health_class FROM observations",
)
def health_class(spark, sf_dir):
    df = C.with_health_score(_obs(spark, sf_dir), "health_score", 9)
    return df.select("obs_id", "health_score", C.health_class("health_score").alias("health_class"))


@register(
    "restoration_class",
    f"SELECT obs_id, round({V.restoration_score()}, 9) AS restoration_score, "
    f"{V.restoration_class(f'round({V.restoration_score()}, 9)')} AS restoration_class FROM observations",
)
def restoration_class(spark, sf_dir):
    df = C.with_restoration_score(_obs(spark, sf_dir), "restoration_score", 9)
    return df.select("obs_id", "restoration_score", C.restoration_class("restoration_score").alias("restoration_class"))


def _shift_sql(scale: float) -> str:
    parts = []
    for c, mag in S.SHIFTS.items():
        lo, hi = S.SHIFT_CLIP[c]
        parts.append(f"round({V.clip(f'{c} + {scale} * {mag}', lo, hi)}, 6) AS {c}")
    return ", ".join(parts)


@register("apply_shift", f"SELECT obs_id, {_shift_sql(1.0)} FROM observations")
def apply_shift(spark, sf_dir):
    out = O.apply_shift(_obs(spark, sf_dir), 1.0)
    return out.select("obs_id", *[F.round(c, 6).alias(c) for c in S.SHIFTS])


@register(
    "drop_labels",
    "SELECT * EXCLUDE (reef_health, restoration_suitability) FROM observations",
)
def drop_labels(spark, sf_dir):
    return O.drop_labels(_obs(spark, sf_dir))


@register(
    "select_feature_columns",
    "SELECT obs_id, "
    + ", ".join(S.SENSOR_COLUMNS)
    + ", "
    + ", ".join(f"round({e}, 6) AS {n}" for n, e in _DF.items())
    + ", region FROM observations",
)
def select_feature_columns(spark, sf_dir):
    df = O.add_derived_features(_obs(spark, sf_dir))
    df = df.withColumns({c: F.round(c, 6) for c in S.DERIVED_COLUMNS})
    return O.select_feature_columns(df, "health", keep=["obs_id"])


_HORD = "CASE reef_health " + " ".join(f"WHEN {V.q(c)} THEN {i}" for i, c in enumerate(S.HEALTH_CLASSES)) + " END"
_RORD = (
    "CASE restoration_suitability "
    + " ".join(f"WHEN {V.q(c)} THEN {i}" for i, c in enumerate(S.RESTORATION_CLASSES))
    + " END"
)


@register(
    "ordinal_encode",
    f"""SELECT obs_id, reef_health, {_HORD} AS health_ordinal,
       CAST(dense_rank() OVER (ORDER BY reef_health) - 1 AS INTEGER) AS health_code,
       restoration_suitability, {_RORD} AS restoration_ordinal,
       CAST(dense_rank() OVER (ORDER BY restoration_suitability) - 1 AS INTEGER) AS restoration_code
    FROM observations""",
)
def ordinal_encode(spark, sf_dir):
    df = _obs(spark, sf_dir).select("obs_id", "reef_health", "restoration_suitability")
    df = O.ordinal_encode(df, "reef_health", S.HEALTH_CLASSES, "health_ordinal")
    df = O.ordinal_encode(df, "restoration_suitability", S.RESTORATION_CLASSES, "restoration_ordinal")
    df = O.label_encode(df, "reef_health", "health_code")
    df = O.label_encode(df, "restoration_suitability", "restoration_code")
    return df


@register(
    "inverse_label",
    f"""WITH enc AS (SELECT obs_id, reef_health,
           CAST(dense_rank() OVER (ORDER BY reef_health) - 1 AS INTEGER) AS health_code FROM observations)
    SELECT obs_id, health_code,
      list_sort(list_distinct((SELECT list(reef_health) FROM observations)))[health_code + 1] AS decoded_class,
      list_sort(list_distinct((SELECT list(reef_health) FROM observations)))[health_code + 1] = reef_health AS round_trip
    FROM enc""",
)
def inverse_label(spark, sf_dir):
    labels = _obs(spark, sf_dir).select("obs_id", "reef_health")
    df = O.label_encode(labels, "reef_health", "health_code")
    df = O.inverse_label(df, "health_code", "decoded_class", O.label_codes(labels, "reef_health"))
    return df.select(
        "obs_id", "health_code", "decoded_class", (F.col("decoded_class") == F.col("reef_health")).alias("round_trip")
    )


@register(
    "confidence",
    "SELECT obs_id, task, confidence, round(list_max(map_values(probabilities)), 6) AS max_probability "
    "FROM predictions_health",
)
def confidence(spark, sf_dir):
    p = X.predictions(spark, sf_dir, "health")
    return p.select("obs_id", "task", "confidence", O.confidence("probabilities").alias("max_probability"))


@register(
    "probability_map",
    "SELECT obs_id, task, predicted_class, probabilities FROM predictions_restoration",
)
def probability_map(spark, sf_dir):
    return X.predictions(spark, sf_dir, "restoration").select("obs_id", "task", "predicted_class", "probabilities")


@register(
    "probabilities_sorted",
    """SELECT obs_id, class, probability,
       CAST(row_number() OVER (PARTITION BY obs_id ORDER BY probability DESC, class) AS INTEGER) AS rank
    FROM (SELECT obs_id, unnest(map_keys(probabilities)) AS class, unnest(map_values(probabilities)) AS probability
          FROM predictions_health)""",
)
def probabilities_sorted(spark, sf_dir):
    return O.probabilities_long(X.predictions(spark, sf_dir, "health"), sort=True)


def _initcap_sql(e: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower({e}), ' '), "
        f"lambda w: upper(w[1]) || w[2:]), ' ')"
    )


@register(
    "pretty_label",
    f"""SELECT obs_id, coalesce({_initcap_sql("replace(reef_health, '_', ' ')")}, '—') AS health_label,
       coalesce({_initcap_sql("replace(restoration_suitability, '_', ' ')")}, '—') AS restoration_label,
       coalesce({_initcap_sql("replace(region, '_', ' ')")}, '—') AS region_label
    FROM observations""",
)
def pretty_label(spark, sf_dir):
    return _obs(spark, sf_dir).select(
        "obs_id",
        C.pretty_label("reef_health").alias("health_label"),
        C.pretty_label("restoration_suitability").alias("restoration_label"),
        C.pretty_label("region").alias("region_label"),
    )


@register(
    "format_number",
    """SELECT obs_id, CASE WHEN coral_cover_percentage IS NULL OR isnan(coral_cover_percentage) THEN '—'
                      ELSE printf('%.1f%%', coral_cover_percentage) END AS cover_text,
       CASE WHEN light_intensity IS NULL OR isnan(light_intensity) THEN '—'
            ELSE printf('%.1f lux', light_intensity) END AS light_text
    FROM observations""",
)
def format_number(spark, sf_dir):
    return _obs(spark, sf_dir).select(
        "obs_id",
        C.format_number("coral_cover_percentage", "%").alias("cover_text"),
        C.format_number("light_intensity", " lux").alias("light_text"),
    )


@register(
    "round_coordinates",
    """SELECT obs_id, round(longitude, 4) AS lon, round(latitude, 4) AS lat, region, reef_health,
       restoration_suitability, coral_cover_percentage FROM observations""",
)
def round_coordinates(spark, sf_dir):
    return O.round_coordinates(_obs(spark, sf_dir))


@register(
    "prediction_envelope",
    " UNION ALL ".join(
        f"""SELECT obs_id, predicted_class, confidence, {V.q(t)} AS task, {V.q(f'reef_{t}_model')} AS model_name, '1' AS model_version, 'champion' AS alias, 'run-fixture-scorer' AS run_id,
        true AS one_timestamp, true AS has_disclaimer FROM predictions_{t}"""
        for t in S.TASK_CLASSES
    ),
)
def prediction_envelope(spark, sf_dir):
    """Each prediction of both tasks with task, model identity, disclaimer and one run timestamp (told as a flag: it is the wall clock)."""
    out = None
    for t in S.TASK_CLASSES:
        p = X.predictions(spark, sf_dir, t).select("obs_id", "predicted_class", "confidence")
        own = O.prediction_envelope(p, t, f"reef_{t}_model", "1", "champion", "run-fixture-scorer")
        out = own if out is None else out.unionByName(own)
    flags = {"one_timestamp": F.col("prediction_ts") == F.current_timestamp(), "has_disclaimer": F.length("disclaimer") > 0}
    return out.withColumns(flags).drop("prediction_ts", "disclaimer")
