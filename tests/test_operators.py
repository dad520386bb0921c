"""Operator semantics against brute force on small fixtures."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidepool import schema as S
from tidepool.operators import aggregate as A
from tidepool.operators import drift as D
from tidepool.operators import ordered as O
from tidepool.operators import scalar as B
from tidepool.plans import q_profile, registry
from tidepool.sources import fixtures as X
from tests.conftest import SMALL

registry.load_all()
LABEL_QUERIES = [
    f"{n}_by_task" for n in ("confusion_matrix", "classification_metrics", "per_class_metrics", "model_metrics", "leaderboard",
                             "quality_gate", "compare_champion", "promotion_decision", "closed_form_benchmark", "mutual_information")
]


def test_shift_identity_and_negative(spark):
    obs = X.observations(spark, SMALL)
    assert B.apply_shift(obs, 0.0) is obs
    with pytest.raises(ValueError):
        B.apply_shift(obs, -1.0)
    shifted = B.apply_shift(obs, 1.0).agg(F.max("water_temperature_c")).first()[0]
    assert shifted <= 35.0


def test_right_closed_cut_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (10.0,)], "x double")
    r = df.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    idx, _ = A.cut_right_closed(F.col("x"), F.col("lo"), F.col("hi"), 10)
    got = [row[0] for row in df.crossJoin(r).select(idx).collect()]
    assert got == [0, 0, 1, 9]  # min joins the first bin; 2.0 sits on a right edge


def test_histogram_left_closed_max_in_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (10.0,), (float("nan"),)], "x double")
    h = {r["bin"]: r["count"] for r in A.histogram(spark, df, "x", 10).collect()}
    assert h[0] == 1 and h[1] == 1 and h[2] == 1 and h[9] == 1 and sum(h.values()) == 4


def test_rank_within_matches_row_number(spark):
    obs = X.observations(spark, SMALL).select("obs_id", "reef_health")
    d = obs.withColumn("h", O.hash_key(42, "obs_id"))
    ours = O.rank_within(d, ["reef_health"], "h", "obs_id", "r").select("obs_id", "r")
    ref = d.select("obs_id", F.row_number().over(Window.partitionBy("reef_health").orderBy("h", "obs_id")).alias("r"))
    assert ours.exceptAll(ref).count() == 0 and ref.exceptAll(ours).count() == 0


def test_stratified_split_exact_counts(spark):
    obs = X.observations(spark, SMALL).select("obs_id", "reef_health")
    s = O.stratified_split(obs, "reef_health", 0.2, 42)
    got = {(r[0], r[1]): r[2] for r in s.groupBy("reef_health", "split").count().collect()}
    for cls, n in {r[0]: r[1] for r in obs.groupBy("reef_health").count().collect()}.items():
        assert got.get((cls, "test"), 0) == int(np.floor(0.2 * n + 0.5))


def test_kfold_balanced(spark):
    obs = X.observations(spark, SMALL).select("obs_id", "reef_health")
    f = O.stratified_kfold(obs, "reef_health", 5)
    sizes = [r[1] for r in f.groupBy("fold").count().collect()]
    assert max(sizes) - min(sizes) <= 4


def both(ref, cur):
    return ref.withColumn("side", F.lit("reference")).unionByName(cur.withColumn("side", F.lit("current")))


@pytest.mark.parametrize("outlier", [0.0, 1e9])
def test_wasserstein_and_ks_match_numpy(spark, outlier):
    rng = np.random.default_rng(0)
    a, b = rng.normal(0, 1, 400).round(3), rng.normal(0.5, 1, 300).round(3)
    a[:150] = 0.0  # one value held by a great part of the rows
    a[-1] = outlier
    ref = spark.createDataFrame([(float(x),) for x in a], "v double")
    cur = spark.createDataFrame([(float(x),) for x in b], "v double")
    d = D.distances(spark, D.value_counts(both(ref, cur), ["v"]), ["v"]).first()
    grid = np.sort(np.unique(np.concatenate([a, b])))
    fa = np.searchsorted(np.sort(a), grid, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), grid, side="right") / len(b)
    assert d["ks_statistic"] == pytest.approx(np.max(np.abs(fa - fb)))
    assert d["wasserstein"] == pytest.approx(np.sum(np.abs(fa - fb)[:-1] * np.diff(grid)))
    assert d["std_reference"] == pytest.approx(a.std())
    assert (d["mean_reference"], d["mean_current"]) == (pytest.approx(a.mean()), pytest.approx(b.mean()))
    flags = {m: D.feature_drift(D.distances(spark, D.value_counts(both(ref, cur), ["v"]), ["v"]), m).first() for m in D.METHODS}
    assert flags["ks"]["method"] == "ks" and flags["ks"]["drifted"] == (flags["ks"]["value"] < 0.1)
    assert flags["wasserstein_normed"]["drifted"] == (flags["wasserstein_normed"]["value"] >= 0.1)


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    rows = [("a", float(x)) for x in rng.normal(0, 1, 301).round(2)] + [("b", 5.0)] * 7 + [("a", 1e12), ("c", None), ("b", None)]
    rows += [("a", 0.0)] * 400
    got = {r["g"]: r for r in O.exact_quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], ["v"], {"low": 0.25, "mid": 0.5, "high": 0.99}).collect()}
    for g in ("a", "b"):
        v = [x for k, x in rows if k == g and x is not None]
        assert [got[g][n] for n in ("low", "mid", "high")] == pytest.approx(np.quantile(v, [0.25, 0.5, 0.99]).tolist())
    assert "c" not in got


def counted(spark, classes, ref, cur):
    rows = [(side, c) for side, counts in (("reference", ref), ("current", cur)) for c, n in zip(classes, counts) for _ in range(n)]
    return spark.createDataFrame(rows, "side string, predicted_class string")


@pytest.mark.parametrize(
    "classes,ref,cur,expected",
    [
        (S.HEALTH_CLASSES, [837, 361, 174, 128], [86, 588, 550, 276], 914.8388),
        (S.RESTORATION_CLASSES, [890, 475, 135], [437, 790, 273], 279.7565),
    ],
)
def test_chi2_reproduces_published_statistics(spark, classes, ref, cur, expected):
    r = D.prediction_drift(counted(spark, classes, ref, cur), {"t": ("predicted_class", classes)}).first()
    assert r["statistic"] == pytest.approx(expected, abs=0.02)
    assert r["p_value"] == pytest.approx(0.0, abs=1e-6)
    assert sum(r["reference_distribution"].values()) == pytest.approx(1.0, abs=1e-3)


def test_chi2_survival_function(spark):
    # published table values: P(X > x) = 0.05
    df = spark.createDataFrame([(3.841459, 1, 0.05), (5.991465, 2, 0.05), (7.814728, 3, 0.05), (2000.0, 3, 0.0), (0.0, 2, 1.0), (1.0, 0, 1.0)], "x double, k int, p double")
    for r in df.withColumn("got", D.chi2_sf(F.col("x"), F.col("k"), 4)).collect():
        assert r["got"] == pytest.approx(r["p"], abs=1e-6)


def test_empty_sides_are_neutral(spark):
    classes = S.HEALTH_CLASSES
    for ref, cur in (([5, 0, 0, 0], [5, 0, 0, 0]), ([5, 3, 0, 0], [0, 0, 0, 0]), ([0, 0, 0, 0], [0, 0, 0, 0])):
        r = D.prediction_drift(counted(spark, classes, ref, cur), {"t": ("predicted_class", classes)}).first()
        assert (r["statistic"], r["p_value"], r["drifted"]) == (0.0, 1.0, False)
    for rows in ([], [("reference", 0.5)], [("current", 0.5)]):
        r = D.confidence_drift(spark, spark.createDataFrame(rows, "side string, c double"), {"health": "c"}).first()
        assert (r["task"], r["statistic"], r["p_value_asymptotic"], r["drifted"]) == ("health", 0.0, 1.0, False)


def test_windows_hold_every_row(spark):
    obs = X.observations(spark, SMALL)
    ref, cur = D.split_windows(obs)
    assert ref.count() > 0 and cur.count() > 0 and ref.count() + cur.count() == obs.count()
    assert D.sided(obs).groupBy("side").count().count() == 2
    ids = obs.select("obs_id")
    for n in (0, 1, 100, 5999):
        expected = ids.orderBy(O.hash_key(42, "obs_id"), "obs_id").limit(n)
        got = O.seeded_sample(ids, n)
        assert got.count() == min(n, ids.count()) and got.exceptAll(expected).count() == 0
    assert D.reference_window(obs, 10**9).count() == obs.count()


def test_no_drift_on_same_window(spark):
    obs = X.observations(spark, SMALL)
    fd = D.feature_drift(D.distances(spark, D.value_counts(both(obs, obs), S.SENSOR_COLUMNS), S.SENSOR_COLUMNS))
    assert fd.count() == len(S.SENSOR_COLUMNS) and fd.filter(F.col("drifted")).count() == 0


def test_constant_columns(spark):
    from tidepool.operators import preprocess as P

    df = spark.createDataFrame([(3.0, 1.0), (3.0, 2.0)], "a double, b double")
    scaled = P.standard_scale(df, P.fit_scaler(df, ["a", "b"]), ["a", "b"]).collect()
    assert sorted((r["a"], r["b"]) for r in scaled) == [(0.0, -1.0), (0.0, 1.0)]
    r = df.agg(F.min("a").alias("lo"), F.max("a").alias("hi"))
    idx, _ = A.cut_right_closed(F.col("a"), F.col("lo"), F.col("hi"), 10)
    assert len({x[0] for x in df.crossJoin(r).select(idx).collect()}) == 1


def test_filters(spark):
    df = spark.createDataFrame([("x", 1.0), ("y", float("nan")), (None, None)], "c string, v double")
    assert B.filter_values(df, "c", []).count() == 3 and B.filter_values(df, "c", ["x"]).count() == 1
    assert B.filter_finite(df, ["v"]).count() == 1


def test_shared_folder_is_required_beyond_one_machine(spark, monkeypatch):
    from tidepool.sources import io as IO

    class Cluster:
        class sparkContext:  # noqa: N801
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

        class conf:  # noqa: N801
            get = staticmethod(lambda *a: None)

    with pytest.raises(ValueError):
        IO.shared_dir(Cluster, "x")


def test_preparation_fills_scales_and_ignores_unknown_regions(spark):
    from tidepool.operators import preprocess as P

    train = X.observations(spark, SMALL).limit(400)
    fitted = P.fit_preparation(train)
    rows = train.limit(3).withColumns({"ph": F.lit(None).cast("double"), "depth_m": F.lit(float("nan")), "region": F.lit("Atlantis")})
    got = fitted.apply(rows).collect()
    expected = np.array([r[0] for r in train.select("ph").collect()])
    for r in got:
        assert r["num__ph"] == pytest.approx((np.median(expected) - expected.mean()) / expected.std())
        assert not any(r[P.onehot_name("region", c)] for c in fitted.categories)
        assert all(np.isfinite(r[c]) for c in fitted.feature_columns)


def test_correlations_cover_all_numeric_features(spark):
    x = B.add_derived_features(X.observations(spark, SMALL)).select(*S.NUMERIC_FEATURES).toPandas().to_numpy()
    at = {c: i for i, c in enumerate(S.NUMERIC_FEATURES)}

    def average_rank(v):
        _, which, n = np.unique(v, return_inverse=True, return_counts=True)
        return (np.cumsum(n) - (n - 1) / 2)[which]

    ranks = np.column_stack([average_rank(x[:, i]) for i in range(x.shape[1])])
    for name, value, data in (("pearson_matrix_features", "r", x), ("spearman_matrix_features", "rho", ranks)):
        exact = np.corrcoef(data, rowvar=False)
        got = registry.QUERIES[name](spark, SMALL).collect()
        assert len({(r.col_a, r.col_b) for r in got}) == len(got) == len(at) * (len(at) - 1) // 2
        for r in got:
            assert r[value] == pytest.approx(exact[at[r.col_a], at[r.col_b]], abs=2e-6)
            assert r.strong == (abs(exact[at[r.col_a], at[r.col_b]]) > 0.8)


def test_label_queries_cover_both_tasks(spark):
    got = {n: [r.task for r in registry.QUERIES[n](spark, SMALL).collect()] for n in LABEL_QUERIES}
    assert {n: set(t) for n, t in got.items()} == {n: set(S.TASK_CLASSES) for n in LABEL_QUERIES}
    assert [got["confusion_matrix_by_task"].count(t) for t in S.TASK_CLASSES] == [16, 9]
    gates = {(r.task, r.gate): r.threshold for r in registry.QUERIES["compare_champion_by_task"](spark, SMALL).collect()}
    assert gates == {(t, g): v for t, own in S.COMPARISON_GATES.items() for g, v in own.items()}


@pytest.mark.parametrize("name", ["train_logistic", "train_forest", "score_batch"])
def test_fits_cover_both_tasks(spark, name):
    assert {r.task for r in registry.QUERIES[name](spark, SMALL).select("task").distinct().collect()} == set(S.TASK_CLASSES)


def test_every_implausibility_rule_counts(spark):
    base = dict.fromkeys(S.SENSOR_COLUMNS, 1.0) | {"water_temperature_c": 28.0, "ph": 8.1, "salinity_ppt": 35.0, "dissolved_oxygen_mg_l": 6.0, "coral_cover_percentage": 30.0, "bleaching_percentage": 5.0, "disease_percentage": 0.0}
    rows = [base, base | {"coral_cover_percentage": 0.0, "bleaching_percentage": 0.0, "disease_percentage": 3.0}, base | {"bleaching_percentage": 80.0}, base | {"bleaching_percentage": 70.0}]
    got = q_profile.count_rules(spark.createDataFrame(rows)).first().asDict()
    assert {n: c for n, c in got.items() if c} == {"cover0_disease_pos": 1, "bleaching_cover_gt_100": 1}
    assert set(registry.QUERIES["implausible_rows_all"](spark, SMALL).columns) == set(got)


def test_every_run_is_looked_up(spark):
    got = registry.QUERIES["duplicate_registration_all"](spark, SMALL).collect()
    assert sum(r.runs for r in got) == X.table(spark, SMALL, "events").count()
    assert {(r.model_name, r.registered) for r in got} == {(m, x) for m in ("reef_health_model", "restoration_model") for x in (True, False)}


@pytest.mark.parametrize("most", [0, 2_000_000])
def test_correlations_of_gappy_columns_equal_pandas(spark, monkeypatch, most):
    from tidepool.operators import profile as PR

    monkeypatch.setattr(PR, "RANK_ROWS", most)
    r = np.random.default_rng(3)
    x = r.integers(0, 6, (200, 3)).astype(float)
    x[:, 1] += x[:, 0]
    x[r.random((200, 3)) < 0.1] = np.nan
    rows = [(*[None if np.isnan(v) and i % 2 else float(v) for v in row], 7.0) for i, row in enumerate(x)]
    frame = spark.createDataFrame(rows, "a double, b double, c double, flat double")
    table = frame.toPandas()
    got = {(p.col_a, p.col_b): p for p in PR.correlation_pairs(frame, ["a", "b", "c", "flat"], "r").collect()}
    ranks = table.rank()  # ranks of a column's own values, as the operator's
    by_rank = {(p.col_a, p.col_b): p for p in PR.rank_correlation_pairs(frame, ["a", "b", "c", "flat"], "r").collect()}
    for (a, b), p in got.items():
        if b == "flat":
            assert p.r is None and by_rank[a, b].r is None
            continue
        assert p.r == pytest.approx(table[a].corr(table[b]), abs=2e-6) and p.strong == (abs(p.r) > 0.8)
        assert by_rank[a, b].r == pytest.approx(ranks[a].corr(ranks[b]), abs=2e-6)


def test_requests_are_judged_record_by_record(spark):
    import json

    from tidepool.plans import q_validate as Q

    good = {c: sum(S.COLUMN_BOUNDS[c]) / 2 for c in S.SENSOR_COLUMNS} | {"region": S.REGIONS[0]}
    changes = {
        "fine": ({}, ""),
        "placed": ({"latitude": 1.0, "timestamp": "2024-01-01"}, ""),
        "extra": ({"reef_name": "x", "zone": 1}, "extra_field:reef_name,extra_field:zone"),
        "high": ({"ph": 9.5}, "range:ph"),
        "strange": ({"region": "Atlantis"}, "unknown_region"),
    }
    rows = [(k, 1, json.dumps(good | c)) for k, (c, _) in changes.items()]
    rows += [("short", 1, json.dumps({k: v for k, v in good.items() if k != "depth_m"})), ("torn", 1, '{"ph": 8')]
    rows += [(f"n{i}", 2, json.dumps(good)) for i in range(51)] + [(f"m{i}", 3, json.dumps(good)) for i in range(50)]
    got = {r.obs_id: r for r in Q.judge_requests(spark.createDataFrame(rows, "obs_id string, batch long, json string")).collect()}
    assert {k: got[k].reasons for k in changes} == {k: w for k, (_, w) in changes.items()}
    assert got["short"].reasons == "missing:depth_m" and got["torn"].status == "quarantined"
    assert all(got[f"n{i}"].reasons == "batch_size" for i in range(51)) and all(got[f"m{i}"].status == "accepted" for i in range(50))


def test_paired_rows_need_partners(spark):
    a, b = (spark.createDataFrame([(k, v) for k in ks], f"id string, {v} string") for v, ks in (("x", "abc"), ("y", "abc")))
    assert B.paired(a, b, "id").count() == 3
    with pytest.raises(Exception, match="no partner"):
        B.paired(a, b.where("id <> 'b'"), "id").collect()


def test_every_decision_occurs(spark):
    decisions = {r.decision for r in registry.QUERIES["promotion_requests"](spark, SMALL).collect()}
    assert decisions >= {"blocked_missing_approval", "blocked_rejected", "blocked_review_required", "promote", "dry_run_ok"}
    assert {r.decision for r in registry.QUERIES["rollback_requests"](spark, SMALL).collect()} == {"roll_back", "nothing_to_do", "blocked_unknown_version", "blocked_no_target"}
    checks = {(r.check, r.passed) for r in registry.QUERIES["retrain_input_checks"](spark, SMALL).collect()}
    assert {c for c, p in checks if not p} >= {"region_domain", "min_rows", "duplicates", "non_finite", "target_present", "all_classes_present", "min_per_class"}
    assert {r.written for r in registry.QUERIES["write_if_valid"](spark, SMALL).collect()} == {True, False}
    for name in ("space_time_join", "static_grid_join"):
        rows = registry.QUERIES[name](spark, SMALL).collect()
        assert 0 < sum(r[1] is not None for r in rows)
