"""Splits, per-fit preparation, classifiers, the model store and the drift run."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tidepool import schema as S
from tidepool.operators import drift as D
from tidepool.operators import learning as L
from tidepool.operators import ml as ML
from tidepool.operators import ordered as O
from tidepool.operators import scalar as B
from tidepool.operators import softmax, trees
from tidepool.plans import q_learn, registry
from tidepool.sources import fixtures as X

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def loaded():
    registry.load_all()


@pytest.fixture(scope="module")
def gappy(spark):
    """Observations with missing sensors, NaN, missing and unknown regions, and missing labels."""
    n = F.col("_n")
    obs = X.observations(spark, SMALL).withColumn("_n", F.pmod(F.xxhash64("obs_id"), F.lit(100)))
    none = F.lit(None).cast("double")
    return obs.withColumns({
        "ph": F.when(n < 8, none).otherwise(F.col("ph")),
        "depth_m": F.when(n == 9, F.lit(float("nan"))).when(n == 3, none).otherwise(F.col("depth_m")),
        "region": F.when(n == 10, None).when(n == 11, "Atlantis").otherwise(F.col("region")),
        "reef_health": F.when(n == 12, None).otherwise(F.col("reef_health")),
    }).drop("_n")


@pytest.fixture(scope="module")
def rows(spark, gappy):
    return L.learning_rows(gappy)


@pytest.fixture(scope="module")
def held(rows):
    return rows.toPandas()


def test_folds_are_runs_of_the_seeded_order(spark):
    obs = X.observations(spark, SMALL).select("obs_id", *S.TARGET_COLUMNS)
    names = {t: f"part_{t}" for t in S.TASK_TARGET}
    got = O.split_and_folds(obs, S.TASK_TARGET, names).toPandas()
    for task, label in S.TASK_TARGET.items():
        ordered = obs.withColumn("h", F.md5(F.concat(F.lit(f"42|{task}|"), "obs_id"))).toPandas().sort_values(["h", "obs_id"])
        for _, own in ordered.groupby(label):
            n = len(own)
            first = int(np.floor(0.2 * n + 0.5))
            parts = [0] * first + [1 + sum((i >= (n - first) * j // 5) for j in range(1, 5)) for i in range(n - first)]
            found = got.set_index("obs_id")[names[task]]
            assert found[own.obs_id].tolist() == parts


def test_split_of_tiny_and_null_classes(spark):
    df = spark.createDataFrame([(str(i), c) for i, c in enumerate(["a", "b", "b", None, None, None, "c"])], "obs_id string, k string")
    parts = O.split_and_folds(df, {"t": "k"}, {"t": "part"}).collect()
    assert len(parts) == 7 and all(0 <= r.part <= 5 for r in parts)
    split = O.stratified_split(df, "k").groupBy("k", "split").count().collect()
    assert {(r.k, r.split): r["count"] for r in split} == {("a", "train"): 1, ("b", "train"): 2, ("c", "train"): 1, (None, "test"): 1, (None, "train"): 2}
    assert O.stratified_split(df.limit(0), "k").count() == 0


def test_split_shuffles_no_rows(spark):
    done = O.stratified_splits(X.observations(spark, SMALL), S.TASK_TARGET, {t: f"s_{t}" for t in S.TASK_TARGET})
    plan = done._jdf.queryExecution().executedPlan().toString().splitlines()
    # what is shuffled are counts, cuts and the few rows beside a cut
    moved = [line for line in plan if "Exchange hashpartitioning" in line or "SortMergeJoin" in line]
    assert moved and not any("obs_id" in line or "__id" in line for line in moved)
    ranked = O.stratified_kfold(X.observations(spark, SMALL).select("obs_id", "reef_health"), "reef_health")
    wide = [line for line in ranked._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line and "REPARTITION" in line]
    assert not wide


def brute_preparation(held, fit):
    own = held[held[fit.cell].isin(fit.train) & held[f"y_{fit.task}"].notna()]
    medians = own[S.SENSOR_COLUMNS].median()
    return own, own[S.SENSOR_COLUMNS].fillna(medians), medians, own.region.mode().sort_values().iloc[0]


def test_preparation_of_every_fold_equals_pandas(rows, held):
    fits = ML.fold_fits()
    design = L.prepare(rows, fits)
    for f in fits:
        own, filled, medians, mode = brute_preparation(held, f)
        p = design.preparation(f)
        assert p.mode == mode and p.categories == sorted(own.region.dropna().unique())
        for c in S.SENSOR_COLUMNS:
            assert p.medians[c] == pytest.approx(medians[c]) and p.means[c] == pytest.approx(filled[c].mean()) and p.stds[c] == pytest.approx(filled[c].std(ddof=0))
        counts = own[f"y_{f.task}"].value_counts()
        assert design.class_counts[f.training_set] == {int(k): int(n) for k, n in counts.items()}
        acid = (filled.ph - 8.1).abs()
        assert p.means["acidity_deviation"] == pytest.approx(acid.mean()) and p.stds["acidity_deviation"] == pytest.approx(acid.std(ddof=0))


def test_no_fit_knows_the_rows_it_is_judged_on(spark, rows):
    fits = [f for f in ML.fold_fits() if f.task == "health"][:1] + ML.year_fits([1995, 1996, 1997])[:1]
    own = rows.withColumn("year", F.when(F.col("year") > 1997, 1997).otherwise(F.greatest("year", F.lit(1995))))
    before = ML.fit_models(L.prepare(own, fits), fits, "logistic_regression")
    for f in fits:
        assert not set(f.train) & set(f.judge)
        spoiled = own.withColumns({c: F.when(F.col(f.cell).isin(list(f.judge)), F.lit(1e6)).otherwise(F.col(c)) for c in ("ph", "depth_m")})
        spoiled = spoiled.withColumn("region", F.when(F.col(f.cell).isin(list(f.judge)), "Elsewhere").otherwise(F.col("region")))
        after = ML.fit_models(L.prepare(spoiled, [f]), [f], "logistic_regression")[f.name]
        one, two = after.preparation, before[f.name].preparation
        assert (one.medians, one.mode, one.categories) == (two.medians, two.mode, two.categories)
        assert one.means == pytest.approx(two.means) and one.stds == pytest.approx(two.stds)
        assert np.allclose(after.weights, before[f.name].weights, atol=1e-6)


def test_softmax_equals_spark_ml(spark, rows):
    fits = [f for f in ML.final_fits() if f.task == "restoration"]
    design = L.prepare(rows, fits)
    (f,) = fits
    model = ML.fit_models(design, fits, "logistic_regression")[f.name]
    p = design.preparation(f)
    own = design.of(f, f.teaches())
    scaled = own.select(F.col("y_restoration").cast("double").alias("label"), F.array(*map(F.lit, design.class_weights(f)))[F.col("y_restoration")].alias("w"),
                        *[((F.col(c) - p.means[c]) / (p.stds[c] or 1.0)).alias(c) for c in S.NUMERIC_FEATURES], *[F.when(F.col("region") == r, 1.0).otherwise(0.0).alias(f"r{i}") for i, r in enumerate(p.categories)])
    data = VectorAssembler(inputCols=scaled.columns[2:], outputCol="features").transform(scaled).cache()
    own = LogisticRegression(family="multinomial", regParam=1.0 / data.agg(F.sum("w")).first()[0], weightCol="w", standardization=False, maxIter=2000, tol=1e-12).fit(data)
    assert np.allclose(own.coefficientMatrix.toArray(), model.weights[:, :-1], atol=2e-3)
    b = own.interceptVector.toArray()
    assert np.allclose(b - b.mean(), model.weights[:, -1], atol=5e-3)


@pytest.mark.parametrize("algorithm", ML.ALGORITHMS)
def test_models_bear_gaps_and_unknown_regions_and_repeat(spark, rows, gappy, algorithm):
    fits = ML.final_fits()
    design = L.prepare(rows, fits)
    models = ML.fit_models(design, fits, algorithm, quick=True)
    new = gappy.limit(300).withColumn("region", F.when(F.col("depth_m") < 20, "Atlantis").otherwise(F.col("region"))).drop(*S.TARGET_COLUMNS)
    for name, model in models.items():
        got = ML.score(model, new).collect()
        assert len(got) == 300 and {r.predicted_class for r in got} <= set(S.TASK_CLASSES[model.task])
        assert all(abs(sum(r.probabilities.values()) - 1) < 1e-4 and r.confidence == pytest.approx(max(r.probabilities.values())) for r in got)
        assert ML.importance(spark, model).count() == len(model.feature_columns)
    again = ML.fit_models(L.prepare(rows, fits), fits, algorithm, quick=True)
    for name, model in models.items():
        one, two = (sorted(map(tuple, ML.score(m, new).select("obs_id", "predicted_class").collect())) for m in (model, again[name]))
        assert one == two
    counts = ML.judged(design, fits, models).groupBy("task").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("y_true") == F.col("y_pred"), F.col("n"))).alias("hit")).collect()
    for r in counts:
        assert r.n == rows.where(f"part_{r.task} = 0 and y_{r.task} is not null").count() and r.hit > 0.4 * r.n


def test_leaves_and_bootstrap(spark):
    r = np.random.default_rng(1)
    x = r.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(np.int64)
    bins = trees.binned(x, trees.bin_edges(x))
    column, cut_bin, child, value, _ = trees.grow_forest_tree(bins, y, np.ones(2), 2, 12, 40, np.random.default_rng([42, 0]))
    leaf = trees.walk(bins.astype(np.int64), column, cut_bin, child)
    assert (value[leaf].argmax(axis=1) == y).mean() > 0.9
    assert np.unique(leaf, return_counts=True)[1].min() > 10  # 40 rows of the bootstrap sample
    grown, _ = trees.grow_booster(bins, y.astype(float), np.ones(4000), 20, 4, 0.3, 0.8, 1.0, np.random.default_rng(0))
    margin = sum(t[3][trees.walk(bins.astype(np.int64), *t[:3]), 0] for t in grown)
    assert ((margin > 0) == y).mean() > 0.97


def test_store_fits_once(spark, rows, monkeypatch):
    digest = ML.fingerprint_rows(rows)
    store = ML.Store(spark)
    for algorithm in ML.ALGORITHMS:
        first = store.models(rows, digest, algorithm, quick=True)
        with monkeypatch.context() as m:
            m.setattr(ML, "fit_models", lambda *a, **k: pytest.fail("fitted again"))
            loaded = store.models(rows, digest, algorithm, quick=True)
        for name, model in first.items():
            for field, v in vars(model).items():
                own = getattr(loaded[name], field)
                assert np.array_equal(v, own) if isinstance(v, np.ndarray) else v == own, field
    assert store.key(digest, "random_forest", ML.final_fits()[0], True) != store.key(digest, "random_forest", ML.final_fits()[0], False)
    assert ML.fingerprint_rows(rows.limit(100)) != digest and ML.fingerprint_rows(rows.orderBy("ph")) == digest
    assert store.load("nothing") is None


def test_best_model_ties_go_to_the_first(spark):
    rows = [("health", a, 0.7, 0.8) for a in ML.ALGORITHMS] + [("restoration", a, f, 0.5) for a, f in zip(ML.ALGORITHMS, (0.1, 0.3, 0.2))]
    frame = spark.createDataFrame(rows, "task string, algorithm string, cv_macro_f1_mean double, cv_balanced_accuracy_mean double")
    assert {(r.task, r.algorithm) for r in ML.select_best(frame).where("best").collect()} == {("health", "logistic_regression"), ("restoration", "random_forest")}


def test_queries_cover_tasks_and_parts(spark):
    got = {n: registry.QUERIES[n](spark, SMALL).collect() for n in ("cross_validate", "cross_validate_folds", "leave_one_region_out", "temporal_holdout", "feature_ablation", "train_logistic", "select_best_model")}
    assert {n: len(r) for n, r in got.items() if n != "temporal_holdout"} == {"cross_validate": 2, "cross_validate_folds": 10, "leave_one_region_out": 8, "feature_ablation": 16, "train_logistic": 2, "select_best_model": 6}
    assert len(got["temporal_holdout"]) >= 4
    folds = {(r.task, r.fold): r for r in got["cross_validate_folds"]}
    for r in got["cross_validate"]:
        f1 = [folds[r.task, k].macro_f1 for k in range(1, 6)]
        assert r.cv_macro_f1_mean == pytest.approx(np.mean(f1), abs=2e-6) and r.cv_macro_f1_std == pytest.approx(np.std(f1), abs=2e-6)
    full = {r.task: r.macro_f1 for r in got["feature_ablation"] if r.subset == "all"}
    assert full == {r.task: r.macro_f1 for r in got["train_logistic"]}
    assert sum(r.best for r in got["select_best_model"]) == 2


def test_label_inputs_are_those_of_the_formulas(spark):
    from tidepool.functions import columns as C

    obs = X.observations(spark, SMALL).limit(500).cache()
    for task, score in (("health", C.with_health_score), ("restoration", C.with_restoration_score)):
        changed = set()
        for c in S.SENSOR_COLUMNS:
            moved = score(score(obs, "a").withColumn(c, F.col(c) * 0.9 + 1), "b")
            if moved.where("abs(a - b) > 1e-9").count():
                changed.add(c)
        assert changed == set(q_learn.LABEL_INPUTS[task])


def test_drift_run_equals_its_parts(spark):
    one = registry.QUERIES["drift_run"](spark, SMALL).first()
    _, models = q_learn.final_models(spark, SMALL, "logistic_regression")
    table = q_learn.scored_sides(D.sided(X.observations(spark, SMALL)), {t: models[f"{t}/final"] for t in S.TASK_CLASSES}).cache()
    share = registry.QUERIES["drift_share"](spark, SMALL).first()
    assert (one.drifted_count, one.total_columns, one.drifted_share) == (share.drifted_count, share.total_columns, share.drifted_share)
    tasks = {t: (f"{t}_class", S.TASK_CLASSES[t]) for t in S.TASK_CLASSES}
    for r in D.prediction_drift(table, tasks).collect():
        assert (one[f"{r.task}_prediction_statistic"], one[f"{r.task}_prediction_drifted"], one.reference_n, one.production_n) == (r.statistic, r.drifted, r.n_reference, r.n_current)
    for r in D.confidence_drift(spark, table, {t: f"{t}_confidence" for t in S.TASK_CLASSES}).collect():
        assert (one[f"{r.task}_confidence_statistic"], one[f"{r.task}_confidence_delta"]) == (r.statistic, r.delta)
    # each task's model alone gives the same classes
    for t in S.TASK_CLASSES:
        alone = ML.score(models[f"{t}/final"], D.sided(X.observations(spark, SMALL)), ["side"]).groupBy("side", "predicted_class").count()
        both = table.groupBy("side", F.col(f"{t}_class").alias("predicted_class")).count()
        assert sorted(map(tuple, alone.collect())) == sorted(map(tuple, both.collect()))


def test_scored_features_are_those_of_the_scalar_operators(spark):
    obs = X.observations(spark, SMALL).limit(50)
    _, models = q_learn.final_models(spark, SMALL, "logistic_regression")
    m = models["health/final"]
    x = B.add_derived_features(obs).select(*S.NUMERIC_FEATURES, "region", "obs_id").toPandas()
    z = np.column_stack([(x[c] - m.preparation.means[c]) / m.preparation.stds[c] for c in S.NUMERIC_FEATURES] + [x.region == r for r in m.preparation.categories] + [np.ones(len(x))])
    p = softmax._probabilities(z.astype(float), m.weights)[0]
    got = {r.obs_id: r.probabilities for r in ML.score(m, obs).collect()}
    for i, obs_id in enumerate(x.obs_id):
        assert [got[obs_id][c] for c in S.HEALTH_CLASSES] == pytest.approx(p[i], abs=1e-6)


def test_cell_moments_are_those_of_all_rows_of_the_cell(spark, monkeypatch):
    import numpy as np

    from tidepool import schema as S
    from tidepool.operators import learning as L

    monkeypatch.setattr(L, "CHUNK_ROWS", 7)
    rng = np.random.default_rng(3)
    keys = [(-1, None if i % 5 == 0 else "abc"[i % 3], i % 4 if i % 7 else None) for i in range(90)]
    values = 1e6 + rng.random((90, len(S.NUMERIC_FEATURES)))
    values[:, 0] = 0.1
    rows = [(*k, *map(float, v)) for k, v in zip(keys, values)]
    design = spark.createDataFrame(rows, "set int, region string, y_health int, " + ", ".join(f"{c} double" for c in S.NUMERIC_FEATURES)).repartition(4)
    found = {tuple(cell.values()): rest for cell, *rest in L._moments(design, ["set", "region", "y_health"])}
    assert set(found) == set(keys) and sum(n for n, _, _ in found.values()) == 90
    for key, (n, mean, m2) in found.items():
        own = values[[k == key for k in keys]]
        assert n == len(own) and np.allclose(mean, own.mean(axis=0), rtol=1e-13) and np.allclose(m2, own.var(axis=0) * n, rtol=1e-8, atol=1e-18)
    empty = L._moments(design.where("set = 5"), ["set", "region", "y_health"])
    assert empty == []
