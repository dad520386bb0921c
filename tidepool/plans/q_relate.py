"""Groups D and H: joins and set operations (all implicit in the monitored system)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool import schema as S
from tidepool.operators import aggregate as A
from tidepool.operators import drift as D
from tidepool.operators import scalar as B
from tidepool.plans import q_drift as QD
from tidepool.plans import sqlviews as V
from tidepool.plans.registry import register
from tidepool.sources import fixtures as X


def _obs(spark, sf_dir):
    return X.observations(spark, sf_dir)


def _dim(classes, name="class"):
    return "(SELECT * FROM (VALUES " + ", ".join(f"({i}, {V.q(c)})" for i, c in enumerate(classes)) + f") t(class_order, {name}))"


@register(
    "join_task_predictions",
    """SELECT h.obs_id, h.predicted_class AS health_class, h.confidence AS health_confidence,
       r.predicted_class AS restoration_class, r.confidence AS restoration_confidence
    FROM predictions_health h JOIN predictions_restoration r ON h.obs_id = r.obs_id""",
)
def join_task_predictions(spark, sf_dir):
    """1:1 inner join of both tasks' predictions on the key (was a positional zip)."""
    h = X.predictions(spark, sf_dir, "health").select(
        "obs_id", F.col("predicted_class").alias("health_class"), F.col("confidence").alias("health_confidence")
    )
    r = X.predictions(spark, sf_dir, "restoration").select(
        "obs_id", F.col("predicted_class").alias("restoration_class"), F.col("confidence").alias("restoration_confidence")
    )
    return B.paired(h, r, "obs_id")


@register(
    "join_features_target",
    "SELECT obs_id, " + ", ".join(S.SENSOR_COLUMNS) + ", region, reef_health FROM observations",
)
def join_features_target(spark, sf_dir):
    obs = _obs(spark, sf_dir)
    x = obs.select("obs_id", *S.SENSOR_COLUMNS, "region")
    y = obs.select("obs_id", "reef_health")
    return B.paired(x, y, "obs_id")


def _shares(src, label):
    return f"SELECT {label} AS class, count(*) / (SELECT count(*) FROM {src}) AS share FROM {src} GROUP BY 1"


@register(
    "join_label_shares",
    f"""SELECT coalesce(r.class, c.class) AS class, round(coalesce(r.share, 0.0), 6) AS reference_share,
       round(coalesce(c.share, 0.0), 6) AS current_share
    FROM ({_shares('ref_pred_restoration', 'predicted_class')}) r
    FULL OUTER JOIN ({_shares('prod_pred_restoration', 'predicted_class')}) c ON r.class = c.class""",
)
def join_label_shares(spark, sf_dir):
    return D.share_change_flags(QD.scored(spark, sf_dir), "restoration_class").select("class", "reference_share", "current_share")


def _recall_sql(src_expr):
    return f"""SELECT y_true AS class, avg(CASE WHEN y_pred = y_true THEN 1.0 ELSE 0.0 END) AS recall FROM ({src_expr}) GROUP BY 1"""


@register(
    "join_class_recall",
    f"""SELECT c.class, round(c.recall, 6) AS champion_recall, round(h.recall, 6) AS challenger_recall,
       round(h.recall - c.recall, 6) AS recall_change
    FROM ({_recall_sql("SELECT y_true, y_pred FROM scored_health")}) c
    JOIN ({_recall_sql("SELECT s.y_true, p.predicted_class AS y_pred FROM scored_health s JOIN predictions_health p ON s.obs_id = p.obs_id")}) h
    ON c.class = h.class""",
)
def join_class_recall(spark, sf_dir):
    """Champion (threshold rule) against challenger (centre scorer) recall by class: both sides from one scored pass."""
    scored = X.scored_pairs(spark, sf_dir, "health", with_scorer=True)
    sides = {"c": "y_pred", "h": "predicted_class"}
    j = scored.groupBy(F.col("y_true").alias("class")).agg(*[F.avg((F.col(p) == F.col("y_true")).cast("double")).alias(n) for n, p in sides.items()])
    return j.select(
        "class",
        F.round("c", 6).alias("champion_recall"),
        F.round("h", 6).alias("challenger_recall"),
        F.round(F.col("h") - F.col("c"), 6).alias("recall_change"),
    )


@register(
    "join_class_weights",
    """WITH c AS (SELECT reef_health, count(*) AS n_c FROM observations GROUP BY 1),
    k AS (SELECT count(*) AS k, sum(n_c) AS n FROM c)
    SELECT o.obs_id, o.reef_health, round(n / (k * n_c), 6) AS class_weight
    FROM observations o JOIN c USING (reef_health) CROSS JOIN k""",
)
def join_class_weights(spark, sf_dir):
    from tidepool.operators import metrics as M

    obs = _obs(spark, sf_dir).select("obs_id", "reef_health")
    return M.attach_class_weights(obs, "reef_health").withColumn("class_weight", F.round("class_weight", 6))


@register(
    "complete_domain",
    f"""WITH c AS (SELECT region, reef_health, count(*) AS n FROM observations GROUP BY 1, 2),
    g AS (SELECT r.region, d.class_order, d.reef_health FROM (VALUES {", ".join(f"({V.q(r)})" for r in S.REGIONS)}) r(region)
          CROSS JOIN {_dim(S.HEALTH_CLASSES, "reef_health")} d)
    SELECT g.region, g.class_order, g.reef_health, CAST(coalesce(c.n, 0) AS BIGINT) AS n
    FROM g LEFT JOIN c ON g.region = c.region AND g.reef_health = c.reef_health""",
)
def complete_domain(spark, sf_dir):
    """Fixed region x class grid (16 rows), missing -> 0."""
    c = _obs(spark, sf_dir).groupBy("region", "reef_health").agg(F.count(F.lit(1)).alias("n"))
    regions = spark.createDataFrame([(r,) for r in S.REGIONS], "region string")
    dim = regions.crossJoin(A.class_dim(spark, S.HEALTH_CLASSES, "reef_health"))
    return F.broadcast(dim).join(c, ["region", "reef_health"], "left").na.fill(0, ["n"]).select(
        "region", "class_order", "reef_health", F.col("n").cast("long")
    )


@register(
    "grid_complete_bins",
    """WITH r AS (SELECT min(depth_m) AS lo, max(depth_m) AS hi FROM observations),
    c AS (SELECT least(9, CAST(greatest(0, ceil((depth_m - lo) / ((hi - lo) / 10)) - 1) AS INTEGER)) AS depth_bin,
                 reef_health, count(*) AS n FROM observations, r GROUP BY 1, 2)
    SELECT CAST(b.i AS INTEGER) AS depth_bin, d.reef_health, CAST(coalesce(c.n, 0) AS BIGINT) AS n
    FROM range(10) b(i) CROSS JOIN (VALUES ('healthy'), ('stressed'), ('bleached'), ('severely_degraded')) d(reef_health)
    LEFT JOIN c ON c.depth_bin = b.i AND c.reef_health = d.reef_health""",
)
def grid_complete_bins(spark, sf_dir):
    """Cross join of the (parameter-sized) bin axis with the class axis, then
    left join of the observed counts: empty cells kept (observed=False)."""
    obs = _obs(spark, sf_dir)
    r = F.broadcast(obs.agg(F.min("depth_m").alias("lo"), F.max("depth_m").alias("hi")))
    idx, _ = A.cut_right_closed(F.col("depth_m"), F.col("lo"), F.col("hi"), 10)
    c = obs.crossJoin(r).groupBy(idx.alias("depth_bin"), "reef_health").agg(F.count(F.lit(1)).alias("n"))
    axes = spark.range(10).select(F.col("id").cast("int").alias("depth_bin")).crossJoin(
        spark.createDataFrame([(c_,) for c_ in S.HEALTH_CLASSES], "reef_health string")
    )
    return axes.join(c, ["depth_bin", "reef_health"], "left").na.fill(0, ["n"]).select(
        "depth_bin", "reef_health", F.col("n").cast("long")
    )


@register(
    "missing_classes",
    f"""WITH o AS (SELECT DISTINCT CAST(timestamp AS DATE) AS day, reef_health FROM observations)
    SELECT day, d.reef_health FROM (SELECT DISTINCT day FROM o) CROSS JOIN {_dim(S.HEALTH_CLASSES, "reef_health")} d
    EXCEPT SELECT day, reef_health FROM o""",
)
def missing_classes(spark, sf_dir):
    """Left anti: classes that a day with observations lacks. Both sides are distinct (day, class) pairs."""
    present = _obs(spark, sf_dir).select(F.to_date("timestamp").alias("day"), "reef_health").distinct()
    declared = F.array(*[F.lit(c) for c in S.HEALTH_CLASSES])
    required = present.select("day").distinct().select("day", F.explode(declared).alias("reef_health"))
    return required.join(present, ["day", "reef_health"], "left_anti")


@register(
    "unexpected_classes",
    f"SELECT DISTINCT region FROM observations_dirty WHERE region NOT IN {V.in_list(S.REGIONS)}",
)
def unexpected_classes(spark, sf_dir):
    """Left anti the other way: observed values outside the expected domain."""
    expected = spark.createDataFrame([(r,) for r in S.REGIONS], "region string")
    return X.observations_dirty(spark, sf_dir).select("region").distinct().join(F.broadcast(expected), "region", "left_anti")


@register(
    "union_region_blocks",
    "SELECT region, count(*) AS n, round(avg(coral_cover_percentage), 6) AS mean_cover FROM observations GROUP BY region",
)
def union_region_blocks(spark, sf_dir):
    obs = _obs(spark, sf_dir)
    blocks = [obs.filter(F.col("region") == r) for r in S.REGIONS]
    u = blocks[0]
    for b in blocks[1:]:
        u = u.unionByName(b)
    return u.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("coral_cover_percentage"), 6).alias("mean_cover"))


@register(
    "union_windows",
    f"""WITH u AS (SELECT 'reference' AS side, predicted_class FROM ref_pred_health
                  UNION ALL SELECT 'current', predicted_class FROM prod_pred_health)
    SELECT side, {", ".join(f"CAST(count(*) FILTER (WHERE predicted_class = {V.q(c)}) AS BIGINT) AS {c}" for c in S.HEALTH_CLASSES)}
    FROM u GROUP BY side""",
)
def union_windows(spark, sf_dir):
    r, c = QD.scored_windows(spark, sf_dir, "health")
    u = r.select(F.lit("reference").alias("side"), "predicted_class").unionByName(
        c.select(F.lit("current").alias("side"), "predicted_class")
    )
    return A.contingency(u, "side", "predicted_class", S.HEALTH_CLASSES)


@register(
    "label_union",
    "SELECT DISTINCT class FROM (SELECT y_true AS class FROM scored_health UNION SELECT predicted_class FROM prod_pred_health)",
)
def label_union(spark, sf_dir):
    truth = X.scored_pairs(spark, sf_dir, "health").select(F.col("y_true").alias("class"))
    cur = QD.scored_windows(spark, sf_dir, "health")[1].select(F.col("predicted_class").alias("class"))
    return truth.union(cur).distinct()


@register(
    "label_except",
    f"""SELECT class FROM (SELECT class FROM {_dim(S.HEALTH_CLASSES)} UNION ALL SELECT class FROM {_dim(S.RESTORATION_CLASSES)}) d
    EXCEPT SELECT reef_health FROM observations""",
)
def label_except(spark, sf_dir):
    """Declared classes of both labels that never occur as a health label."""
    declared = spark.createDataFrame([(c,) for c in S.HEALTH_CLASSES + S.RESTORATION_CLASSES], "class string")
    return declared.subtract(_obs(spark, sf_dir).select(F.col("reef_health").alias("class")).distinct())


@register(
    "filter_regions",
    f"SELECT obs_id, region FROM observations WHERE region IN {V.in_list(S.REGIONS[:2])}",
)
def filter_regions(spark, sf_dir):
    """Rows of the chosen regions; an empty choice is no filter."""
    return B.filter_values(_obs(spark, sf_dir), "region", S.REGIONS[:2]).select("obs_id", "region")


@register(
    "filter_classes",
    f"""SELECT 'chosen' AS choice, reef_health, count(*) AS n FROM observations WHERE reef_health IN {V.in_list(S.HEALTH_CLASSES[:2])} GROUP BY 2
    UNION ALL SELECT 'none', reef_health, count(*) FROM observations GROUP BY 2""",
)
def filter_classes(spark, sf_dir):
    """Rows of the chosen classes beside the unfiltered rows of an empty choice."""
    obs = _obs(spark, sf_dir).select("reef_health")
    out = None
    for name, chosen in (("chosen", S.HEALTH_CLASSES[:2]), ("none", [])):
        n = B.filter_values(obs, "reef_health", chosen).groupBy("reef_health").agg(F.count(F.lit(1)).alias("n")).withColumn("choice", F.lit(name))
        out = n if out is None else out.unionByName(n)
    return out.select("choice", "reef_health", "n")


@register(
    "filter_finite",
    f"""SELECT obs_id FROM observations_dirty WHERE {" AND ".join(f"{c} IS NOT NULL AND isfinite({c})" for c in S.SENSOR_COLUMNS)}""",
)
def filter_finite(spark, sf_dir):
    """Rows whose every sensor column is a finite number."""
    return B.filter_finite(X.observations_dirty(spark, sf_dir), S.SENSOR_COLUMNS).select("obs_id")
