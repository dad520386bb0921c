"""Classification metrics (I13-I15, I07) from one grouped pass.

Rows are reduced once to the (truth, prediction) confusion counts -- at most
k x k rows -- and every metric is arithmetic on that tiny table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def confusion_counts(df: DataFrame, t: str, p: str, group: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(group or []), F.col(t).alias("y_true"), F.col(p).alias("y_pred")).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(spark: SparkSession, df: DataFrame, t: str, p: str, classes: list[str]) -> DataFrame:
    """All k x k cells in label order, zeros kept."""
    cc = confusion_counts(df, t, p)
    dim_t = spark.createDataFrame(list(enumerate(classes)), "true_order int, y_true string")
    dim_p = spark.createDataFrame(list(enumerate(classes)), "pred_order int, y_pred string")
    grid = F.broadcast(dim_t.crossJoin(dim_p))  # k x k, fixed by the class list
    return grid.join(cc, ["y_true", "y_pred"], "left").na.fill(0, ["n"]).select(
        "true_order", "y_true", "pred_order", "y_pred", F.col("n").cast("long")
    )


def per_class(df: DataFrame, t: str, p: str, group: list[str] | None = None) -> DataFrame:
    """precision, recall, f1, support per class present in truth or prediction."""
    return per_class_of_counts(confusion_counts(df, t, p, group), group)


def per_class_of_counts(cc: DataFrame, group: list[str] | None = None) -> DataFrame:
    """per_class from confusion counts (y_true, y_pred, n)."""
    g = group or []
    # a cell counts once for its true class and once for its predicted one
    none = F.lit(0).cast("long")
    as_true = F.struct(F.col("y_true").alias("class"), F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(none).alias("tp"), F.col("n").alias("support"), none.alias("predicted"))
    as_pred = F.struct(F.col("y_pred").alias("class"), none.alias("tp"), none.alias("support"), F.col("n").alias("predicted"))
    x = cc.select(*g, F.explode(F.array(as_true, as_pred)).alias("c")).groupBy(*g, "c.class").agg(*[F.sum(f"c.{k}").alias(k) for k in ("tp", "support", "predicted")])
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    x = x.withColumns({"precision": prec, "recall": rec})
    f1 = F.when(F.col("precision") + F.col("recall") > 0, 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    return x.withColumn("f1", f1)


def classification_metrics(df: DataFrame, t: str, p: str, group: list[str] | None = None, digits: int | None = 4) -> DataFrame:
    """Scalar metrics, rounded to ``digits``; None keeps them whole, as gates must compare them."""
    return metrics_of_counts(confusion_counts(df, t, p, group), group, digits)


def metrics_of_counts(cc: DataFrame, group: list[str] | None = None, digits: int | None = 4) -> DataFrame:
    g = group or []
    scalars = {
        "accuracy": F.sum("tp") / F.sum("support"),
        "balanced_accuracy": F.avg(F.when(F.col("support") > 0, F.col("recall"))),
        "macro_precision": F.avg("precision"),
        "macro_recall": F.avg("recall"),
        "macro_f1": F.avg("f1"),
        "weighted_f1": F.sum(F.col("f1") * F.col("support")) / F.sum("support"),
    }
    shown = [(v if digits is None else F.round(v, digits)).alias(n) for n, v in scalars.items()]
    return per_class_of_counts(cc, g).groupBy(*g).agg(*shown, F.sum("support").alias("n"))


def per_class_recall(df: DataFrame, t: str, p: str) -> DataFrame:
    return df.groupBy(F.col(t).alias("class")).agg(F.avg((F.col(p) == F.col(t)).cast("double")).alias("recall"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (k * n_c) per class (a k-row table)."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    tot = c.agg(F.count(F.lit(1)).alias("k"), F.sum("n_c").alias("n"))
    return c.crossJoin(F.broadcast(tot)).select(label, (F.col("n") / (F.col("k") * F.col("n_c"))).alias("class_weight"))


def attach_class_weights(df: DataFrame, label: str) -> DataFrame:
    """Broadcast join of the k-row weight table (k = number of classes)."""
    return df.join(F.broadcast(class_weights(df, label)), label)
