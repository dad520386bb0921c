"""Scalar Column expressions (group B): all native, all null-safe.

Every function takes and returns ``Column`` so Catalyst folds them into one
projection inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidepool import schema as S


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(x: str | Column, lo: float = 0.0, hi: float = 1.0) -> Column:
    """Clip to [lo, hi]; NULL and NaN stay NULL.

    ``greatest``/``least`` skip nulls and rank NaN highest, so a bare clip
    would turn a missing reading into ``hi``.
    """
    x = col(x)
    return F.when(x.isNull() | F.isnan(x), F.lit(None).cast("double")).otherwise(
        F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), x))
    )


def clip_fast(x: str | Column, lo: float = 0.0, hi: float = 1.0) -> Column:
    """Single-reference clip for inputs known to be non-null (fixture paths).

    Keeps substituted expressions small when the optimizer pushes a filter
    through a chain of projections.
    """
    return F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), col(x)))


def thermal_stress_index(t: str | Column = "water_temperature_c") -> Column:
    return clip((col(t) - 28.5) / 4.5)


def oxygen_stress_index(do: str | Column = "dissolved_oxygen_mg_l") -> Column:
    return clip((F.lit(6.0) - col(do)) / 3.5)


def acidity_deviation(ph: str | Column = "ph") -> Column:
    return F.abs(col(ph) - 8.1)


def water_quality_index(
    constants: Mapping[str, float] = S.TRAINING_FEATURE_CONSTANTS,
) -> Column:
    ph_stress = clip(acidity_deviation() / constants["ph_normaliser"])
    turb_stress = clip(F.col("turbidity_ntu") / constants["turbidity_normaliser"])
    raw = (
        0.40 * thermal_stress_index()
        + 0.30 * oxygen_stress_index()
        + 0.20 * ph_stress
        + 0.10 * turb_stress
    )
    return clip(F.lit(1.0) - raw)


def _rugosity_norm() -> Column:
    return (F.col("rugosity_index") - 1.0) / 9.0


def substrate_stability_score() -> Column:
    return clip(0.60 * (F.col("hard_substrate_percentage") / 100.0) + 0.40 * _rugosity_norm())


def structural_complexity_score() -> Column:
    return clip(0.5 * F.col("acoustic_complexity_index") + 0.5 * _rugosity_norm())


def derived_feature_columns(
    constants: Mapping[str, float] = S.TRAINING_FEATURE_CONSTANTS,
) -> dict[str, Column]:
    return {
        "thermal_stress_index": thermal_stress_index(),
        "oxygen_stress_index": oxygen_stress_index(),
        "acidity_deviation": acidity_deviation(),
        "water_quality_index": water_quality_index(constants),
        "substrate_stability_score": substrate_stability_score(),
        "structural_complexity_score": structural_complexity_score(),
    }


_HEALTH_TERMS = [
    # (weight, raw component, clipped?)
    (0.20, lambda: (F.col("water_temperature_c") - 28.5) / 4.5, True),
    (0.12, lambda: (F.lit(8.10) - F.col("ph")) / 0.55, True),
    (0.08, lambda: (F.lit(6.00) - F.col("dissolved_oxygen_mg_l")) / 3.50, True),
    (0.10, lambda: F.col("turbidity_ntu") / 20.0, True),
    (0.25, lambda: F.col("bleaching_percentage") / 100.0, False),
    (0.12, lambda: F.col("disease_percentage") / 45.0, True),
    (0.13, lambda: F.lit(1.0) - F.col("coral_cover_percentage") / 72.0, True),
]

_RESTORATION_TERMS = [
    (0.15, lambda: F.lit(1.0) - F.abs(F.col("water_temperature_c") - 28.0) / 6.5, True),
    (0.12, lambda: (F.col("ph") - 7.75) / 0.55, True),
    (0.10, lambda: F.col("light_intensity") / 500.0, True),
    (0.22, lambda: F.col("hard_substrate_percentage") / 100.0, True),
    (0.10, lambda: F.lit(1.0) - F.abs(F.col("current_speed_m_s") - 0.18) / 0.45, True),
    (0.12, lambda: F.lit(1.0) - F.col("turbidity_ntu") / 18.0, True),
    (0.09, lambda: F.lit(1.0) - F.greatest(F.lit(0.0), F.col("depth_m") - 15.0) / 25.0, True),
    (0.10, lambda: F.col("coral_cover_percentage") / 65.0, True),
]


def _with_weighted_score(df, terms, out: str, digits: int | None, null_safe: bool = True):
    """Staged projection: raw components -> clipped components -> clipped sum.

    Staging keeps every null-safe clip over a column reference, so the
    generated code stays linear in the number of terms.
    """
    names = [f"__{out}_{i}" for i in range(len(terms))]
    df = df.withColumns({n: t[1]() for n, t in zip(names, terms)})
    cl = clip if null_safe else clip_fast
    df = df.withColumns({n: cl(n) for n, t in zip(names, terms) if t[2]})
    raw = None
    for n, (w, _, _) in zip(names, terms):
        raw = F.lit(w) * F.col(n) if raw is None else raw + F.lit(w) * F.col(n)
    df = df.withColumn(f"__{out}_raw", raw)
    score = cl(f"__{out}_raw")
    if digits is not None:
        score = F.round(score, digits)
    return df.withColumn(out, score).drop(*names, f"__{out}_raw")


def with_scores(df, specs: dict, digits: int | None = None, null_safe: bool = True):
    """Several weighted scores in the same three projection stages
    ({out: terms}); keeps the plan shallow when both labels are needed."""
    cl = clip if null_safe else clip_fast
    raw_cols, clipped, sums = {}, {}, {}
    for out, terms in specs.items():
        names = [f"__{out}_{i}" for i in range(len(terms))]
        raw_cols.update({n: t[1]() for n, t in zip(names, terms)})
        clipped.update({n: cl(n) for n, t in zip(names, terms) if t[2]})
        total = None
        for n, (w, _, _) in zip(names, terms):
            total = F.lit(w) * F.col(n) if total is None else total + F.lit(w) * F.col(n)
        sums[f"__{out}_raw"] = total
    df = df.withColumns(raw_cols).withColumns(clipped).withColumns(sums)
    finals = {}
    for out in specs:
        sc = cl(f"__{out}_raw")
        finals[out] = F.round(sc, digits) if digits is not None else sc
    drop = list(raw_cols) + list(sums)
    return df.withColumns(finals).drop(*drop)


HEALTH_TERMS = _HEALTH_TERMS
RESTORATION_TERMS = _RESTORATION_TERMS


def with_health_score(df, out: str = "health_score", digits: int | None = None, null_safe: bool = True):
    """Noise-free reef health stress score in [0, 1] (higher = worse)."""
    return _with_weighted_score(df, _HEALTH_TERMS, out, digits, null_safe)


def with_restoration_score(df, out: str = "restoration_score", digits: int | None = None, null_safe: bool = True):
    return _with_weighted_score(df, _RESTORATION_TERMS, out, digits, null_safe)


def health_class(score: str | Column) -> Column:
    s = col(score)
    t1, t2, t3 = S.HEALTH_THRESHOLDS
    return (
        F.when(s < t1, "healthy")
        .when(s < t2, "stressed")
        .when(s < t3, "bleached")
        .when(s >= t3, "severely_degraded")
    )


def restoration_class(score: str | Column) -> Column:
    s = col(score)
    t1, t2 = S.RESTORATION_THRESHOLDS
    return F.when(s < t1, "unsuitable").when(s < t2, "moderately_suitable").when(s >= t2, "suitable")


def ordinal_map(classes: list[str]) -> Column:
    """Literal map class -> ordinal position (declared order)."""
    pairs = []
    for i, c in enumerate(classes):
        pairs += [F.lit(c), F.lit(i)]
    return F.create_map(*pairs)


def pretty_label(c: str | Column) -> Column:
    return F.coalesce(F.initcap(F.regexp_replace(col(c), "_", " ")), F.lit("—"))


def format_number(c: str | Column, suffix: str = "") -> Column:
    x = col(c)
    return F.when(x.isNull() | F.isnan(x), F.lit("—")).otherwise(
        F.format_string("%.1f" + suffix.replace("%", "%%"), x)
    )


def recommendation(feature_drift: str | Column, prediction_drift: str | Column) -> Column:
    f, p = col(feature_drift), col(prediction_drift)
    return (
        F.when(f & p, S.REC_RETRAIN)
        .when(f, S.REC_INVESTIGATE_FEATURE)
        .when(p, S.REC_INVESTIGATE_PREDICTION)
        .otherwise(S.REC_OK)
    )


def is_finite(c: str | Column) -> Column:
    x = col(c)
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
