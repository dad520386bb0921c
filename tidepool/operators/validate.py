"""Validation (group C): every violation as a row, in one scan.

Each check becomes a nullable struct in an array; ``filter`` drops passing
checks and ``explode`` emits one violation row per failing cell. The region
box check is a left join to the fixed 4-row bounds dimension (broadcast:
its size is fixed by definition), never a per-row Python function.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool import schema as S


def _fmt(v: float) -> str:
    return repr(float(v))


def _violation(context: str, column: str | None, check: str, failed: Column, case: Column) -> Column:
    return F.when(
        failed,
        F.struct(
            F.lit(context).alias("schema_context"),
            F.lit(column).cast("string").alias("column"),
            F.lit(check).alias("check"),
            case.cast("string").alias("failure_case"),
        ),
    )


def range_checks(bounds: dict = S.COLUMN_BOUNDS) -> list[Column]:
    out = []
    for c, (lo, hi) in bounds.items():
        x = F.col(c)
        out.append(_violation("Column", c, f"greater_than_or_equal_to({_fmt(lo)})", x < lo, x))
        out.append(_violation("Column", c, f"less_than_or_equal_to({_fmt(hi)})", x > hi, x))
    return out


def not_null_checks(columns: list[str] = S.REQUIRED_COLUMNS) -> list[Column]:
    return [_violation("Column", c, "not_nullable", F.col(c).isNull(), F.lit(None)) for c in columns]


DOMAINS = {
    "region": S.REGIONS,
    "reef_health": S.HEALTH_CLASSES,
    "restoration_suitability": S.RESTORATION_CLASSES,
}


def domain_checks(domains: dict = DOMAINS) -> list[Column]:
    out = []
    for c, values in domains.items():
        x = F.col(c)
        out.append(_violation("Column", c, f"isin({values!r})", x.isNotNull() & ~x.isin(values), x))
    return out


def type_checks(raw_text: dict[str, str]) -> list[Column]:
    """raw text column -> declared column: text present but not castable to double."""
    out = []
    for raw, c in raw_text.items():
        x = F.col(raw)
        out.append(
            _violation("Column", c, "coerce_dtype('float64')", x.isNotNull() & x.try_cast("double").isNull(), x)
        )
    return out


def region_bounds_check() -> Column:
    """Row-level: inside its region's box; unknown region passes (joined columns)."""
    inside = (
        (F.col("latitude") >= F.col("lat_min"))
        & (F.col("latitude") <= F.col("lat_max"))
        & (F.col("longitude") >= F.col("lon_min"))
        & (F.col("longitude") <= F.col("lon_max"))
    )
    failed = F.col("lat_min").isNotNull() & ~F.coalesce(inside, F.lit(False))
    return _violation("DataFrameSchema", None, "coordinates_within_region_bounds", failed, F.lit(False))


def join_region_bounds(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Left join to the fixed region box dimension (4 rows)."""
    from tidepool.sources.fixtures import region_bounds

    return df.join(F.broadcast(region_bounds(spark)), "region", "left")


def _check_specs(raw_text: dict[str, str]):
    """(context, column, check, failed condition, failure-case column) for every check."""
    specs = []
    for c, (lo, hi) in S.COLUMN_BOUNDS.items():
        x = F.col(c)
        specs.append(("Column", c, f"greater_than_or_equal_to({_fmt(lo)})", x < lo, x))
        specs.append(("Column", c, f"less_than_or_equal_to({_fmt(hi)})", x > hi, x))
    for c in S.REQUIRED_COLUMNS:
        specs.append(("Column", c, "not_nullable", F.col(c).isNull(), F.lit(None)))
    for c, values in DOMAINS.items():
        x = F.col(c)
        specs.append(("Column", c, f"isin({values!r})", x.isNotNull() & ~x.isin(values), x))
    for raw, c in raw_text.items():
        x = F.col(raw)
        specs.append(("Column", c, "coerce_dtype('float64')", x.isNotNull() & x.try_cast("double").isNull(), x))
    inside = (
        (F.col("latitude") >= F.col("lat_min"))
        & (F.col("latitude") <= F.col("lat_max"))
        & (F.col("longitude") >= F.col("lon_min"))
        & (F.col("longitude") <= F.col("lon_max"))
    )
    specs.append(
        ("DataFrameSchema", None, "coordinates_within_region_bounds",
         F.col("lat_min").isNotNull() & ~F.coalesce(inside, F.lit(False)), F.lit(False))
    )
    return specs


def validate_all(
    spark: SparkSession, df: DataFrame, raw_text: dict[str, str] | None = None, id_col: str = "obs_id"
) -> DataFrame:
    """All violations as a long frame (obs_id, schema_context, column, check, failure_case).

    The per-row pass only builds a compact array of failing check ids;
    failure values are materialised after the explode (failing rows only)
    and check metadata comes from a broadcast dimension of fixed size.
    """
    specs = _check_specs(raw_text or {})
    joined = join_region_bounds(spark, df)
    ids = F.filter(F.array(*[F.when(cond, F.lit(i)) for i, (_, _, _, cond, _) in enumerate(specs)]), lambda v: v.isNotNull())
    cases = F.array(*[case.cast("string") for (_, _, _, _, case) in specs])
    exploded = joined.select(F.col(id_col), F.explode(ids).alias("__id"), cases.alias("__cases"))
    out = exploded.select(id_col, "__id", F.element_at("__cases", F.col("__id") + 1).alias("failure_case"))
    meta = spark.createDataFrame(
        [(i, ctx, col, chk) for i, (ctx, col, chk, _, _) in enumerate(specs)],
        "__id int, schema_context string, column string, check string",
    )
    return out.join(F.broadcast(meta), "__id").select(id_col, "schema_context", "column", "check", "failure_case")


def violations_only(spark: SparkSession, df: DataFrame, kind: str, raw_text: dict[str, str] | None = None) -> DataFrame:
    checks = {
        "range": range_checks,
        "not_null": not_null_checks,
        "domain": domain_checks,
        "types": lambda: type_checks(raw_text or {}),
    }[kind]()
    arr = F.filter(F.array(*checks), lambda v: v.isNotNull())
    return df.select("obs_id", F.explode(arr).alias("v")).select("obs_id", "v.*")


def region_bound_violations(spark: SparkSession, df: DataFrame) -> DataFrame:
    j = join_region_bounds(spark, df)
    return j.select("obs_id", region_bounds_check().alias("v")).filter(F.col("v").isNotNull()).select("obs_id", "v.*")


def null_summary(df: DataFrame) -> DataFrame:
    cols = df.columns
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(cols)).alias("columns"),
        sum((F.sum(F.col(c).isNull().cast("long")) for c in cols), F.lit(0)).alias("total_nulls"),
    )


def retraining_permission(recommendation: Column, reason: Column) -> Column:
    return F.upper(F.coalesce(recommendation, F.lit(""))).startswith("RETRAIN") | (
        F.trim(F.coalesce(reason, F.lit(""))) != ""
    )
