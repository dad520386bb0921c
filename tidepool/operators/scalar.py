"""Row-wise operators (group B): lazy ``DataFrame -> DataFrame`` projections."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool import schema as S
from tidepool.functions import columns as C


def add_derived_features(
    df: DataFrame, constants: Mapping[str, float] = S.TRAINING_FEATURE_CONSTANTS
) -> DataFrame:
    """Append the six derived features; original columns and row count unchanged.

    Staged projections: base indices first, then the water quality index over
    them, so each null-safe clip wraps a column reference and the generated
    code stays small.
    """
    rug = (F.col("rugosity_index") - 1.0) / 9.0
    out = df.withColumns(
        {
            "thermal_stress_index": C.thermal_stress_index(),
            "oxygen_stress_index": C.oxygen_stress_index(),
            "acidity_deviation": C.acidity_deviation(),
            "substrate_stability_score": C.clip(0.60 * (F.col("hard_substrate_percentage") / 100.0) + 0.40 * rug),
            "structural_complexity_score": C.clip(0.5 * F.col("acoustic_complexity_index") + 0.5 * rug),
            "__ph_raw": C.acidity_deviation() / constants["ph_normaliser"],
            "__turb_raw": F.col("turbidity_ntu") / constants["turbidity_normaliser"],
        }
    )
    out = out.withColumns({"__ph_stress": C.clip("__ph_raw"), "__turb_stress": C.clip("__turb_raw")})
    raw = (
        0.40 * F.col("thermal_stress_index")
        + 0.30 * F.col("oxygen_stress_index")
        + 0.20 * F.col("__ph_stress")
        + 0.10 * F.col("__turb_stress")
    )
    out = out.withColumn("__wqi_raw", F.lit(1.0) - raw).withColumn("water_quality_index", C.clip("__wqi_raw"))
    out = out.drop("__ph_raw", "__turb_raw", "__ph_stress", "__turb_stress", "__wqi_raw")
    ordered = [c for c in df.columns if c not in S.DERIVED_COLUMNS] + S.DERIVED_COLUMNS
    return out.select(*ordered)


def filter_values(df: DataFrame, col: str, chosen: list[str]) -> DataFrame:
    """Rows whose ``col`` is one of ``chosen``; no choice is no filter."""
    return df.where(F.col(col).isin(list(chosen))) if chosen else df


def filter_finite(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows in which every column is a finite number."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & C.is_finite(c)
    return df.where(cond)


def apply_shift(df: DataFrame, scale: float = 1.0, fraction: float = 1.0, seed: int = 42) -> DataFrame:
    """Add ``scale * magnitude`` to the shifted columns and clip to bounds.

    Negative scale raises; 0 is the identity; missing columns are skipped.
    ``fraction`` < 1 shifts a deterministic hash-selected share of rows.
    """
    if scale < 0:
        raise ValueError(f"shift scale must be >= 0, got {scale}")
    if scale == 0:
        return df
    selected = F.lit(True)
    if fraction < 1.0:
        key = "obs_id" if "obs_id" in df.columns else df.columns[0]
        selected = (F.abs(F.xxhash64(F.lit(seed), F.col(key))) % 1_000_000) < int(fraction * 1_000_000)
    updates = {}
    for c, mag in S.SHIFTS.items():
        if c not in df.columns:
            continue
        lo, hi = S.SHIFT_CLIP[c]
        updates[c] = F.when(selected, C.clip(F.col(c) + scale * mag, lo, hi)).otherwise(F.col(c))
    return df.withColumns(updates)


def drop_labels(df: DataFrame) -> DataFrame:
    return df.drop(*S.TARGET_COLUMNS)


def feature_columns(task: str) -> list[str]:
    if task not in S.TASK_TARGET:
        raise ValueError(f"task must be 'health' or 'restoration'; got {task!r}")
    return list(S.ALL_FEATURES)


def select_feature_columns(df: DataFrame, task: str, keep: list[str] | None = None) -> DataFrame:
    cols = feature_columns(task)
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing feature columns: {missing}")
    return df.select(*(keep or []), *cols)


def ordinal_encode(df: DataFrame, col: str, classes: list[str], out: str) -> DataFrame:
    """Declared-order ordinal code (0..k-1); unknown -> null."""
    return df.withColumn(out, C.ordinal_map(classes)[F.col(col)])


def label_codes(df: DataFrame, col: str, code: str = "code") -> DataFrame:
    """(col, code): the distinct non-null labels in alphabetical order from 0, one row each."""
    distinct = df.select(col).where(F.col(col).isNotNull()).distinct()
    # as many rows as labels
    return distinct.withColumn(code, (F.row_number().over(Window.partitionBy().orderBy(col)) - 1).cast("int"))


def label_encode(df: DataFrame, col: str, out: str) -> DataFrame:
    """Alphabetical code of each row's label; null for a null label."""
    return df.join(label_codes(df, col, out), col, "left").select(*df.columns, out)


def inverse_label(df: DataFrame, code_col: str, out: str, codes: DataFrame, code: str = "code") -> DataFrame:
    """The label of each row's code by a table of ``label_codes``; null for an unknown code."""
    label = next(c for c in codes.columns if c != code)
    return df.join(codes.select(F.col(label).alias(out), F.col(code).alias(code_col)), code_col, "left").select(*df.columns, out)


def confidence(prob_col: str = "probabilities"):
    return F.round(F.array_max(F.map_values(F.col(prob_col))), 6)


def probability_map(classes: list[str], prob_cols: list[str]):
    return F.map_from_arrays(
        F.array(*[F.lit(c) for c in classes]), F.array(*[F.round(F.col(p), 6) for p in prob_cols])
    )


def probabilities_long(df: DataFrame, sort: bool = True) -> DataFrame:
    """Unroll the probability map to one row per class, ranked by probability."""
    long = df.select("obs_id", F.explode("probabilities").alias("class", "probability"))
    if sort:
        w = Window.partitionBy("obs_id").orderBy(F.desc("probability"), "class")
        long = long.withColumn("rank", F.row_number().over(w).cast("int"))
    return long


def round_coordinates(df: DataFrame) -> DataFrame:
    return df.select(
        "obs_id",
        F.round("longitude", 4).alias("lon"),
        F.round("latitude", 4).alias("lat"),
        "region",
        "reef_health",
        "restoration_suitability",
        "coral_cover_percentage",
    )


def prediction_envelope(
    df: DataFrame, task: str, model_name: str, model_version: str, alias: str, run_id: str
) -> DataFrame:
    """Attach task, model identity and one run timestamp to each prediction."""
    return df.withColumns(
        {
            "task": F.lit(task),
            "model_name": F.lit(model_name),
            "model_version": F.lit(model_version),
            "alias": F.lit(alias),
            "run_id": F.lit(run_id),
            "prediction_ts": F.current_timestamp(),
            "disclaimer": F.lit("Predictions on synthetic data; not for conservation decisions."),
        }
    )


def paired(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """1:1 join on the key that fails when it runs if a row of either side has no partner."""
    both = a.withColumn("__a", F.lit(True)).join(b.withColumn("__b", F.lit(True)), key, "full")
    whole = F.col("__a").isNotNull() & F.col("__b").isNotNull()
    checked = F.when(whole, F.col(key)).otherwise(F.raise_error(F.concat(F.lit("no partner for "), F.col(key).cast("string"))))
    return both.withColumn(key, checked).drop("__a", "__b")
