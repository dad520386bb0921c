"""Queries over coordinates and provenance: nearest neighbours, containment, mixing rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool import schema as S
from tidepool.operators import provenance as PV
from tidepool.operators import spatial as SP
from tidepool.plans.q_learn import LABEL_INPUTS
from tidepool.plans.registry import register
from tidepool.sources import fixtures as X


@register(
    "nn_label_agreement",
    # pairs nearer than half a degree each way: a farther neighbour would show as a missing row
    """WITH p AS (SELECT region, latitude AS y, longitude AS x, min(obs_id) AS a, count(*) AS n FROM observations GROUP BY 1, 2, 3),
    d AS (SELECT o.*, p.a, p.n, (SELECT 1) AS one FROM observations o JOIN p ON p.region = o.region AND p.y = o.latitude AND p.x = o.longitude),
    s AS (SELECT region, latitude, longitude, min(obs_id) AS b FROM d WHERE obs_id > a GROUP BY 1, 2, 3),
    z AS (SELECT d.obs_id, d.region, CASE WHEN d.obs_id > d.a THEN d.a ELSE s.b END AS nn_id, 0.0::DOUBLE AS distance FROM d JOIN s USING (region, latitude, longitude)),
    l AS (SELECT region, y, x, a AS obs_id FROM p WHERE n = 1),
    c AS (SELECT l.obs_id, l.region, p.a, (p.y - l.y) * (p.y - l.y) + (p.x - l.x) * (p.x - l.x) AS d2 FROM l JOIN p
          ON p.region = l.region AND p.y BETWEEN l.y - 0.5 AND l.y + 0.5 AND p.x BETWEEN l.x - 0.5 AND l.x + 0.5 AND (p.y <> l.y OR p.x <> l.x)),
    f AS (SELECT obs_id, region, arg_min(a, (d2, a)) AS nn_id, sqrt(min(d2)) AS distance FROM c GROUP BY 1, 2),
    n AS (SELECT * FROM z UNION ALL SELECT * FROM f),
    t AS (SELECT n.region, 'health' AS task, o.reef_health AS own, q.reef_health AS other FROM n JOIN observations o ON o.obs_id = n.obs_id JOIN observations q ON q.obs_id = n.nn_id
          UNION ALL SELECT n.region, 'restoration', o.restoration_suitability, q.restoration_suitability FROM n JOIN observations o ON o.obs_id = n.obs_id JOIN observations q ON q.obs_id = n.nn_id),
    k AS (SELECT region, task, own, count(*) AS n, sum(CASE WHEN own = other THEN 1 ELSE 0 END) AS same FROM t GROUP BY 1, 2, 3),
    h AS (SELECT region, task, CAST(sum(n) AS BIGINT) AS rows, sum(same) / sum(n) AS agreement, sum(n::DOUBLE * n) / sum(n) / sum(n) AS chance FROM k GROUP BY 1, 2),
    m AS (SELECT region, quantile_cont(distance, 0.5) AS median_distance FROM n GROUP BY 1)
    SELECT region, task, rows, round(agreement, 6) AS agreement, round(chance, 6) AS chance, round(agreement - chance, 6) AS excess, round(median_distance, 6) AS median_distance
    FROM h JOIN m USING (region)""",
)
def nn_label_agreement(spark, sf_dir):
    """How often a row's label equals its nearest neighbour's in the region, against chance."""
    found = SP.nearest(X.observations(spark, sf_dir), "region", "obs_id", "latitude", "longitude", S.TARGET_COLUMNS)
    return SP.neighbour_agreement(found, "region", S.TASK_TARGET)


# --- the polygons that the containment query asks about: fixed values ---------------
#: polygon -> rings of (latitude, longitude); the second ring of the first polygon is a hole.
RINGS = {
    "lagoon": [[(10.2, 72.2), (10.2, 73.8), (11.9, 73.8), (11.1, 73.0), (11.9, 72.2)], [(10.5, 72.8), (10.5, 73.2), (10.8, 73.2), (10.8, 72.8)]],
    "mannar_arc": [[(8.6, 78.1), (8.9, 79.9), (10.4, 79.4), (9.3, 79.1), (9.2, 78.6), (10.1, 78.2)]],
    "kutch_shelf": [[(22.1, 68.1), (22.1, 69.9), (23.9, 69.9), (23.0, 69.0), (22.6, 69.3), (22.5, 68.4)]],
    "andaman_ridge": [[(6.6, 92.1), (7.0, 93.9), (8.4, 93.2), (7.9, 92.9), (8.4, 92.3)], [(7.0, 92.5), (7.2, 92.9), (7.5, 92.6)]],
}


def ring_vertices(spark):
    rows = [(p, i, k, lat, lon) for p, rings in RINGS.items() for i, ring in enumerate(rings) for k, (lat, lon) in enumerate(ring)]
    return spark.createDataFrame(rows, "polygon string, ring int, place int, lat double, lon double")


def _edges_sql() -> str:
    rows = []
    for p, rings in RINGS.items():
        for ring in rings:
            for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1]):
                if a != c:
                    y1, x1, y2, x2 = (a, b, c, d) if a < c else (c, d, a, b)
                    rows.append(f"('{p}', {y1}::DOUBLE, {x1}::DOUBLE, {y2}::DOUBLE, {x2}::DOUBLE)")
    return f"(SELECT * FROM (VALUES {', '.join(rows)}) t(polygon, y1, x1, y2, x2))"


@register(
    "point_in_polygon",
    f"""WITH c AS (SELECT o.obs_id, o.region, e.polygon, count(*) AS n FROM observations o JOIN {_edges_sql()} e
          ON o.latitude >= e.y1 AND o.latitude < e.y2 AND e.x1 + (o.latitude - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) > o.longitude GROUP BY 1, 2, 3),
    t AS (SELECT region, count(*) AS rows FROM observations GROUP BY 1)
    SELECT c.region, polygon, count(*) AS inside, any_value(rows) AS rows, round(count(*) / any_value(rows) * 100, 4) AS pct_inside
    FROM c JOIN t USING (region) WHERE n % 2 = 1 GROUP BY 1, 2""",
)
def point_in_polygon(spark, sf_dir):
    """How many observations of each region lie in each polygon."""
    obs = X.observations(spark, sf_dir)
    inside = SP.point_in_polygon(obs, ring_vertices(spark), "obs_id", "latitude", "longitude")
    rows = obs.groupBy("region").agg(F.count(F.lit(1)).alias("rows"))
    n = inside.join(obs.select("obs_id", "region"), "obs_id").groupBy("region", "polygon").agg(F.count(F.lit(1)).alias("inside"))
    return n.join(F.broadcast(rows), "region").select("region", "polygon", "inside", "rows", F.round(F.col("inside") / F.col("rows") * 100, 4).alias("pct_inside"))  # a row a region


#: The features that each region's training table declares: two of them name label sources.
TABLE_FEATURES = {
    "Lakshadweep": ["salinity_ppt", "rugosity_index", "sonar_backscatter"],
    "Gulf of Mannar": list(S.SENSOR_COLUMNS),
    "Gulf of Kutch": ["light_intensity", "ph"],
    "Andaman and Nicobar Islands": ["acoustic_complexity_index", "salinity_ppt"],
}
_LABEL_SOURCES = list(LABEL_INPUTS["health"])

_PROVENANCE_SQL = """v AS (SELECT region AS "table",
      CASE WHEN _ep % 89 = 0 THEN NULL WHEN _ep % 89 = 1 THEN ' ' ELSE 'sensor-archive' END AS data_source,
      region <> 'Gulf of Kutch' OR _ep % 7 = 0 AS is_synthetic,
      CASE WHEN _ep % 83 = 0 THEN 'guessed' WHEN _ep % 83 = 1 THEN 'measured' WHEN _ep % 83 = 2 THEN 'synthetic'
           WHEN region <> 'Gulf of Kutch' OR _ep % 7 = 0 THEN 'synthetic' ELSE 'measured' END AS observation_type,
      CASE WHEN _ep % 79 = 0 THEN 'certain' WHEN _ep % 79 = 1 AND region = 'Lakshadweep' THEN 'observed' ELSE 'synthetic' END AS label_type,
      CASE WHEN _ep % 97 = 3 THEN NULL ELSE 'open' END AS source_licence, 'survey report' AS citation FROM obs_base)"""


def provenance_rows(spark, sf_dir):
    """Observations as training tables, one a region, with provenance columns of which some rows break each rule."""
    ep, kutch = F.col("_ep"), F.col("region") == "Gulf of Kutch"
    made = ~kutch | (ep % 7 == 0)
    return X.observations_base(spark, sf_dir).select(
        F.col("region").alias("table"),
        F.when(ep % 89 == 0, None).when(ep % 89 == 1, " ").otherwise("sensor-archive").alias("data_source"),
        made.alias("is_synthetic"),
        F.when(ep % 83 == 0, "guessed").when(ep % 83 == 1, "measured").when(ep % 83 == 2, "synthetic").when(made, "synthetic").otherwise("measured").alias("observation_type"),
        F.when(ep % 79 == 0, "certain").when((ep % 79 == 1) & (F.col("region") == "Lakshadweep"), "observed").otherwise("synthetic").alias("label_type"),
        F.when(ep % 97 == 3, None).otherwise("open").alias("source_licence"),
        F.lit("survey report").alias("citation"),
    )


def _guard_sql() -> str:
    types, labels = (", ".join(f"'{x}'" for x in xs) for xs in (PV.OBSERVATION_TYPES, PV.LABEL_TYPES))
    leaks = ", ".join(f"'{t}'" for t, cols in TABLE_FEATURES.items() if set(cols) & set(_LABEL_SOURCES))
    blank = " OR ".join(f"{c} IS NULL OR trim({c}::VARCHAR) = ''" for c in PV.REQUIRED)
    return f"""WITH {_PROVENANCE_SQL},
    t AS (SELECT "table", count(*) AS rows, count(*) FILTER ({blank}) AS provenance_missing,
      count(*) FILTER (observation_type NOT IN ({types})) AS observation_type_unknown, count(*) FILTER (label_type NOT IN ({labels})) AS label_type_unknown,
      count(*) FILTER (is_synthetic AND observation_type <> 'synthetic') AS synthetic_row_called_measured,
      count(*) FILTER (NOT is_synthetic AND observation_type = 'synthetic') AS real_row_called_synthetic,
      count(*) FILTER (is_synthetic AND label_type = 'observed') AS synthetic_label_called_observed,
      least(count(*) FILTER (is_synthetic), count(*) FILTER (NOT is_synthetic)) AS mixed_training_table,
      CASE WHEN "table" IN ({leaks}) THEN count(*) ELSE 0 END AS label_source_in_features FROM v GROUP BY 1)
    SELECT "table", rule, broken_rows, rows FROM t UNPIVOT (broken_rows FOR rule IN (provenance_missing, observation_type_unknown, label_type_unknown,
      synthetic_row_called_measured, real_row_called_synthetic, synthetic_label_called_observed, mixed_training_table, label_source_in_features)) WHERE broken_rows > 0"""


@register("provenance_guard", _guard_sql())
def provenance_guard(spark, sf_dir):
    """Every provenance rule that some rows of a region's training table break."""
    return PV.provenance_guard(provenance_rows(spark, sf_dir), "table", TABLE_FEATURES, _LABEL_SOURCES)
