"""Preprocessing fits and transforms (I01-I06): exact statistics, no ML estimator
whose definition differs (ML ``Imputer`` is approximate, ``StandardScaler``
divides by the sample std)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool import schema as S
from tidepool.operators import ordered as O
from tidepool.operators import scalar as B


def fit_medians(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row: exact median per column, from counts of distinct values."""
    q = O.exact_quantiles(df, [], cols, {"median": 0.5})
    return q.agg(*[F.round(F.max(F.when(F.col("column") == c, F.col("median"))), 6).alias(c) for c in cols])


def fit_mode(df: DataFrame, col: str) -> DataFrame:
    """Most frequent category; ties -> smallest."""
    return df.agg(F.mode(col, deterministic=True).alias(col), F.countDistinct(col).alias("categories"))


def fit_scaler(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row of mean and population std per column."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std")]
    return df.agg(*aggs)


def standard_scale(df: DataFrame, fitted: DataFrame, cols: list[str]) -> DataFrame:
    j = df.crossJoin(F.broadcast(fitted))  # fitted has exactly one row
    out = j.withColumns({c: F.coalesce(F.try_divide(F.col(c) - F.col(f"{c}__mean"), F.col(f"{c}__std")), F.col(c) - F.col(f"{c}__mean")) for c in cols})
    return out.drop(*[f"{c}__{s}" for c in cols for s in ("mean", "std")])


def scaler_integrity(fitted: DataFrame, train: DataFrame, cols: list[str], rtol: float = 1e-4) -> DataFrame:
    """Fitted means equal the training means within ``rtol``."""
    means = train.agg(*[F.avg(c).alias(f"{c}__train") for c in cols])
    j = fitted.crossJoin(means)
    return j.select(
        *[
            (F.abs(F.col(f"{c}__mean") - F.col(f"{c}__train")) <= rtol * F.greatest(F.abs(F.col(f"{c}__train")), F.lit(1e-12))).alias(
                f"{c}_ok"
            )
            for c in cols
        ]
    )


#: Indicator columns that one categorical column may give.
MOST_CATEGORIES = 1000


def fit_categories(df: DataFrame, col: str) -> list[str]:
    """Sorted distinct categories of the training data, MOST_CATEGORIES at most: a column with more is none to encode."""
    found = [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().limit(MOST_CATEGORIES + 1).collect()]
    if len(found) > MOST_CATEGORIES:
        raise ValueError(f"{col} has more than {MOST_CATEGORIES} categories")
    return sorted(found)


def onehot_name(col: str, value: str) -> str:
    return f"cat__{col}_" + "".join(ch if ch.isalnum() else "_" for ch in value)


def one_hot(df: DataFrame, col: str, categories: list[str]) -> DataFrame:
    """K indicator columns; unknown or null -> all zeros."""
    return df.withColumns(
        {onehot_name(col, c): F.when(F.col(col) == c, 1.0).otherwise(0.0) for c in categories}
    )


@dataclass(frozen=True)
class Preparation:
    """What a training set fixes: fill values, means and population deviations, categories. A few numbers per column, whatever the rows."""

    medians: dict[str, float]
    mode: str
    means: dict[str, float]
    stds: dict[str, float]
    categories: list[str]

    @property
    def feature_columns(self) -> list[str]:
        return [*[f"num__{c}" for c in S.NUMERIC_FEATURES], *[onehot_name("region", c) for c in self.categories]]

    def impute(self, df: DataFrame) -> DataFrame:
        """Missing or NaN sensors become the training median, a missing region the training mode."""
        sensors = {c: F.coalesce(F.nanvl(F.col(c), F.lit(None).cast("double")), F.lit(self.medians[c])) for c in S.SENSOR_COLUMNS}
        return df.withColumns({**sensors, "region": F.coalesce("region", F.lit(self.mode))})

    def apply(self, df: DataFrame) -> DataFrame:
        """df with imputed inputs, derived features and the feature columns; an unknown region has all indicators 0, a constant column is centred only."""
        full = B.add_derived_features(self.impute(df))
        scaled = {f"num__{c}": (F.col(c) - F.lit(self.means[c])) / F.lit(self.stds[c] or 1.0) for c in S.NUMERIC_FEATURES}
        return one_hot(full.withColumns(scaled), "region", self.categories)


def fit_preparation(train: DataFrame) -> Preparation:
    """Fitted on the training rows only: exact medians, the mode, then means and population deviations of the imputed features."""
    clean = train.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in S.SENSOR_COLUMNS})
    q = {r["column"]: r["median"] for r in O.exact_quantiles(clean, [], S.SENSOR_COLUMNS, {"median": 0.5}).collect()}
    mode = fit_mode(train, "region").first()["region"]
    first = Preparation({c: q.get(c, 0.0) for c in S.SENSOR_COLUMNS}, mode, {}, {}, [])
    full = B.add_derived_features(first.impute(train))
    m = fit_scaler(full, S.NUMERIC_FEATURES).first()
    means = {c: m[f"{c}__mean"] or 0.0 for c in S.NUMERIC_FEATURES}
    stds = {c: m[f"{c}__std"] or 0.0 for c in S.NUMERIC_FEATURES}
    return Preparation(first.medians, mode, means, stds, fit_categories(full, "region"))
