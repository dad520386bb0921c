"""Steps that must stay bounded as tables grow, on rows of their own."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepool import schema as S
from tidepool.operators import learning as L
from tidepool.operators import ml as ML
from tidepool.operators import ordered as O
from tidepool.operators import softmax
from tidepool.sources import fixtures as X
from tidepool.sources import io as IO


@pytest.fixture(scope="module")
def observations(spark):
    """Rows with gaps, whose labels depend on two sensors and chance."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(6000):
        x = rng.normal(10, 3, len(S.SENSOR_COLUMNS))
        sensors = [None if i % 50 == 7 and j == 2 else float(v) for j, v in enumerate(x)]
        kinds = [c[int(np.clip((x[0] + x[4] + rng.normal(0, 3) - 12) / 16 * len(c), 0, len(c) - 1))] for c in (S.HEALTH_CLASSES, S.RESTORATION_CLASSES)]
        rows.append((f"o{i}", S.REGIONS[i % 4], 2015 + i % 5, *sensors, *kinds))
    schema = "obs_id string, region string, y int, " + ", ".join(f"{c} double" for c in S.SENSOR_COLUMNS) + ", reef_health string, restoration_suitability string"
    return spark.createDataFrame(rows, schema).withColumn("timestamp", F.make_date("y", F.lit(6), F.lit(1)).cast("timestamp_ntz"))


def test_large_fits_start_near_their_optimum_and_end_on_all_rows(observations):
    fits = ML.fold_fits()
    design = L.prepare(L.learning_rows(observations), fits)
    whole = softmax.fit_softmax(design, fits)
    started = softmax.fit_softmax(design, fits, start_rows=1000)
    for name, model in whole.items():
        np.testing.assert_allclose(started[name].weights, model.weights, atol=2e-5)


def test_gradient_passes_agree_with_single_fits(observations):
    fits = [*ML.fold_fits()[:2], *ML.region_fits(S.REGIONS)[1:2], L.Fit("restoration/few", "restoration", "part_restoration", (1, 2), (3,), tuple(S.SENSOR_COLUMNS[:3]))]
    design = L.prepare(L.learning_rows(observations), fits)
    plans = {i: softmax._plan(f, design) for i, f in enumerate(fits)}
    rng = np.random.default_rng(1)
    weights = {i: rng.normal(0, 0.3, (len(p.class_weights), len(p.columns) + len(p.regions) + 1)) for i, p in plans.items()}
    batches = design.rows.toArrow().to_batches()
    for spoil in (False, True):
        if spoil:  # a test row of no fit that holds an infinite value
            t = design.rows.withColumn("depth_m", F.when((F.col("part_health") == 0) & (F.col("part_restoration") == 0) & (F.col("home") == S.REGIONS[1]), float("inf")).otherwise(F.col("depth_m")))
            batches = t.toArrow().to_batches()
        full, light = ({r["fit"]: np.frombuffer(r["value"]) for b in work(plans, weights, S.NUMERIC_FEATURES)(iter(batches)) for r in b.to_pylist()} for work in (softmax._pass, softmax._gradient_pass))
        for i, p in plans.items():
            np.testing.assert_allclose(light[i], full[i][: 1 + weights[i].size], rtol=1e-8, atol=1e-6)


def test_table_build_deals_rows_by_their_number(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    whole = X._observations_base_raw(spark, sf)
    assert IO.row_partitions(spark, 10**9) == 2000
    monkeypatch.setattr(IO, "PARTITION_ROWS", 100)
    small = X._observations_base_raw(spark, sf)
    n = X.table(spark, sf, "lineitem").count()
    assert small.rdd.getNumPartitions() == max(8, -(-n // 100))
    assert small.exceptAll(whole).isEmpty() and whole.exceptAll(small).isEmpty()


def test_cuts_read_counts_once(spark):
    rows = spark.range(3000).select(F.col("id").cast("string").alias("obs_id"), F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").alias("kind"))
    cuts = O.order_cuts(rows, {"t": "kind"}, lambda n: F.array(F.floor(n / 4)))
    # the ids pass once for the counts (written) and once for the rows at the cuts
    assert cuts._jdf.queryExecution().optimizedPlan().toString().count("Range (0, 3000") == 1
    split = O.stratified_split(rows, "kind", 0.25, salt="t")
    assert {(r["kind"], r["split"]): r["count"] for r in split.groupBy("kind", "split").count().collect()} == {(k, s): n for k in ("a", "b", None) for s, n in (("test", 250), ("train", 750))}


def test_repeated_rows_tells_rows_apart_as_grouping_does(spark):
    rows = [(1.0, None, "a"), (1.0, None, "a"), (None, 1.0, "a"), (0.0, 2.0, "b"), (-0.0, 2.0, "b"), (float("nan"), 2.0, "b"), (float("nan"), 2.0, "b"), (1.0, None, None), (1.0, None, "")]
    from tidepool.operators.retrain import repeated_rows

    df = spark.createDataFrame(rows, "x double, y double, s string")
    assert repeated_rows(df, df.columns).first()["dups"] == 3
    assert repeated_rows(df.where("false"), df.columns).first()["dups"] == 0
    # no row travels: what is shuffled are two hashes
    assert "repartitionbyexpression [a#" in repeated_rows(df, df.columns)._jdf.queryExecution().optimizedPlan().toString().lower()


def test_space_time_join_explodes_places_not_rows(spark):
    from tidepool.plans.q_grid import nearest_cells

    places = spark.createDataFrame([("2020-01-05", 10, 20), ("2020-01-09", 10, 20), ("2020-03-01", 0, 0)], "day string, lat_idx int, lon_idx int").withColumn("day", F.col("day").cast("date"))
    g = spark.createDataFrame([("2020-01-05", 11, 20, 1.0), ("2020-01-06", 10, 20, 2.0), ("2020-01-04", 10, 20, 3.0), ("2020-01-10", 9, 21, 4.0)], "time string, g_lat int, g_lon int, value double").withColumn("time", F.col("time").cast("date"))
    found = {str(r["day"]): r["best"].asDict() for r in nearest_cells(places, g).collect()}
    assert set(found) == {"2020-01-05", "2020-01-09"}
    first = found["2020-01-05"]
    assert (first["cell_dist"], first["day_dist"], str(first["time"]), first["value"]) == (0, 1, "2020-01-04", 3.0)
    assert found["2020-01-09"]["cell_dist"] == 2


def test_mutual_information_counts_serve_both_tasks(spark):
    from tidepool.plans.q_profile import _binned_counts

    rows = [(*[float(i + j) if (i + j) % 7 else None for j in range(len(S.SENSOR_COLUMNS))], "ab"[i % 2], None if i % 5 == 0 else "uv"[i % 2]) for i in range(40)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in S.SENSOR_COLUMNS) + ", p string, q string")
    counts = _binned_counts(df, {"one": "p", "two": "q"})
    assert counts.where("n is null or bin is null or bin > 9").isEmpty()
    sums = {(r["task"], r["column"]): r["s"] for r in counts.groupBy("task", "column").agg(F.sum("n").alias("s")).collect()}
    assert sums == {(t, c): 40 for t in ("one", "two") for c in S.SENSOR_COLUMNS}
    c = S.SENSOR_COLUMNS[0]
    values = [r[0] for r in rows]
    lo, hi = min(v for v in values if v is not None), max(v for v in values if v is not None)
    for r in counts.where((F.col("column") == c) & (F.col("task") == "one")).collect():
        assert r["n"] == sum(1 for row in rows if row[-2] == r["y"] and (0 if row[0] is None else min(9, int((row[0] - lo) / ((hi - lo) / 10)))) == r["bin"])


def test_only_columns_of_many_values_are_joined_to_ranks(spark, monkeypatch):
    import pandas as pd

    from tidepool.operators import profile as PR

    rng = np.random.default_rng(2)
    n = 400
    few, many = rng.integers(0, 5, n).astype(float), rng.normal(size=n)
    data = {"few": few, "many": many, "both": np.round(many + few, 2), "gaps": np.where(np.arange(n) % 9 == 0, np.nan, many * few)}
    frame = pd.DataFrame(data)
    df = spark.createDataFrame([tuple(float(x) for x in r) for r in frame.itertuples(index=False)], ", ".join(f"{c} double" for c in data))
    joined = []
    pairs_of = PR._pairs_of
    monkeypatch.setattr(PR, "_pairs_of", lambda rows, cols, value, centres, ranks: joined.append(sorted(set(cols) - set(ranks))) or pairs_of(rows, cols, value, centres, ranks))
    found = {}
    for room in (10**6, 420, 5, 0):
        monkeypatch.setattr(PR, "RANK_ROWS", room)
        found[room] = {(r["col_a"], r["col_b"]): r["rho"] for r in PR.rank_correlation_pairs(df, list(data), "rho").collect()}
    sizes = [len(x) for x in joined]
    assert (sizes[0], sizes[2], sizes[3]) == (0, 3, 4) and 0 < sizes[1] < 4
    assert found[10**6] == found[420] == found[5] == found[0]
    whole = frame[["few", "many", "both"]].corr("spearman")
    for a, b in (("few", "many"), ("few", "both"), ("many", "both")):
        assert abs(found[0][a, b] - whole.loc[a, b]) < 1e-6
