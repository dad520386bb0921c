"""Provenance of rows (M31): every row says where it is from, synthetic and real rows stay apart, label sources stay out of features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: domains of the provenance columns ------------------------------
OBSERVATION_TYPES = ("measured", "modelled", "derived", "synthetic")
LABEL_TYPES = ("observed", "derived", "weak", "proxy", "synthetic")
REQUIRED = ("data_source", "is_synthetic", "observation_type", "label_type", "source_licence", "citation")


def row_rules(required: tuple[str, ...] = REQUIRED) -> dict[str, Column]:
    """Rule name -> condition that a row breaks it."""
    blank = F.lit(False)
    for c in required:
        blank = blank | F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")
    synthetic = F.coalesce(F.col("is_synthetic"), F.lit(False))
    real = F.coalesce(~F.col("is_synthetic"), F.lit(False))
    return {
        "provenance_missing": blank,
        "observation_type_unknown": ~F.coalesce(F.col("observation_type").isin(*OBSERVATION_TYPES), F.lit(True)),
        "label_type_unknown": ~F.coalesce(F.col("label_type").isin(*LABEL_TYPES), F.lit(True)),
        "synthetic_row_called_measured": synthetic & F.coalesce(F.col("observation_type") != "synthetic", F.lit(False)),
        "real_row_called_synthetic": real & F.coalesce(F.col("observation_type") == "synthetic", F.lit(False)),
        "synthetic_label_called_observed": synthetic & F.coalesce(F.col("label_type") == "observed", F.lit(False)),
    }


def provenance_guard(df: DataFrame, table: str, features: dict[str, list[str]], label_sources: list[str]) -> DataFrame:
    """(table, rule, broken_rows, rows): a row per table and broken rule, from one pass.

    Besides the row rules: ``mixed_training_table`` counts the smaller side of
    a table that holds both synthetic and real rows, ``label_source_in_features``
    all rows of a table whose feature list names a label source. A table that
    breaks nothing has no row.
    """
    rules = row_rules()
    leaks = [t for t, cols in features.items() if set(cols) & set(label_sources)]
    sums = {n: F.sum(F.when(c, 1).otherwise(0)).cast("long") for n, c in rules.items()}
    t = df.groupBy(F.col(table).alias("table")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.coalesce(F.col("is_synthetic"), F.lit(False)).cast("long")).alias("_made"), F.sum(F.coalesce(~F.col("is_synthetic"), F.lit(False)).cast("long")).alias("_real"),
        *[v.alias(n) for n, v in sums.items()],
    )
    t = t.withColumns({"mixed_training_table": F.least("_made", "_real"), "label_source_in_features": F.when(F.col("table").isin(leaks), F.col("rows")).otherwise(F.lit(0).cast("long"))})
    names = [*rules, "mixed_training_table", "label_source_in_features"]
    return t.unpivot(["table", "rows"], names, "rule", "broken_rows").where("broken_rows > 0").select("table", "rule", "broken_rows", "rows")
