"""Retraining gates (C16, C17): one aggregate pass plus small unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool import schema as S
from tidepool.functions import columns as C
from tidepool.sources.io import row_partitions

MIN_ROWS = 250  # int(200 / (1 - 0.2))


def repeated_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row, `dups`: how many rows of df repeat another one in all of `columns`.

    Rows are told apart by two 64-bit hashes of them (128 bits), and only these
    are shuffled, into partitions that follow the number of rows. As in grouping,
    nulls and NaN equal themselves and -0.0 equals 0.0.
    """
    flat = [F.when(F.col(c) == 0, F.lit(0.0)).otherwise(F.col(c)) if t in ("double", "float") else F.col(c) for c, t in df.select(*columns).dtypes]
    # a null leaves a hash as it is: which columns are null is hashed too
    gaps = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    keys = df.select(F.xxhash64(F.lit(1), gaps, *flat).alias("a"), F.xxhash64(F.lit(2), gaps, *flat).alias("b"))
    dealt = keys.repartition(row_partitions(df.sparkSession, df.count()), "a", "b")
    return dealt.groupBy("a", "b").agg(F.count(F.lit(1)).alias("c")).agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("dups"))


def input_checks(spark: SparkSession, df: DataFrame, target: str, classes: list[str], dups: int | None = None) -> DataFrame:
    """Eight checks -> one row each: (check_order, check, passed, detail).

    `dups` is what ``repeated_rows`` found, if it is known: it serves all targets.
    """
    fin = F.lit(True)
    for c in S.SENSOR_COLUMNS:
        fin = fin & C.is_finite(c)
    s = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.coalesce(F.sum(x), F.lit(0)).alias(n) for n, x in (("nonfinite_rows", F.when(fin, 0).otherwise(1)), ("null_target", F.col(target).isNull().cast("long")), ("bad_region", F.when(F.col("region").isin(S.REGIONS), 0).otherwise(1)))],
    )
    d = repeated_rows(df, S.OBSERVATION_COLUMNS) if dups is None else spark.range(1).select(F.lit(dups).cast("long").alias("dups"))
    k = (
        df.groupBy(target)
        .agg(F.count(F.lit(1)).alias("c"))
        .agg(F.countDistinct(target).alias("present"), F.min("c").alias("min_class"))
    )
    missing_schema = [c for c in S.REQUIRED_COLUMNS if c not in df.columns]
    x = s.crossJoin(d).crossJoin(k)
    names = [
        "region_domain", "schema", "min_rows", "duplicates", "non_finite",
        "target_present", "all_classes_present", "min_per_class",
    ]
    dim = spark.createDataFrame([(i + 1, n) for i, n in enumerate(names)], "check_order int, check string")
    chk = F.col("check")
    passed = (
        F.when(chk == "region_domain", F.col("bad_region") == 0)
        .when(chk == "schema", F.lit(not missing_schema))
        .when(chk == "min_rows", F.col("n") >= MIN_ROWS)
        .when(chk == "duplicates", F.col("dups") <= F.col("n") * 0.5)
        .when(chk == "non_finite", F.col("nonfinite_rows") == 0)
        .when(chk == "target_present", F.col("null_target") == 0)
        .when(chk == "all_classes_present", F.col("present") == len(classes))
        .otherwise(F.col("min_class") >= 5)
    )
    detail = (
        F.when(chk == "region_domain", F.col("bad_region").cast("string"))
        .when(chk == "schema", F.lit(str(len(missing_schema))))
        .when(chk == "min_rows", F.col("n").cast("string"))
        .when(chk == "duplicates", F.col("dups").cast("string"))
        .when(chk == "non_finite", F.col("nonfinite_rows").cast("string"))
        .when(chk == "target_present", F.col("null_target").cast("string"))
        .when(chk == "all_classes_present", F.col("present").cast("string"))
        .otherwise(F.col("min_class").cast("string"))
    )
    return F.broadcast(dim).crossJoin(x).select("check_order", "check", passed.alias("passed"), detail.alias("detail"))
