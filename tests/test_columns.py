"""Formula points, null-safe clipping and class thresholds."""

import math

import pytest

from tidepool.functions import columns as C


def _one(spark, expr, **cols):
    schema = ", ".join(f"{k} double" for k in cols)
    df = spark.createDataFrame([tuple(cols.values())], schema)
    return df.select(expr.alias("v")).first()["v"]


def test_clip_keeps_null_and_nan_missing(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (2.0,), (-1.0,), (0.5,)], "x double")
    got = [r["v"] for r in df.select(C.clip("x").alias("v")).collect()]
    assert got[0] is None and got[1] is None
    assert got[2:] == [1.0, 0.0, 0.5]


@pytest.mark.parametrize("t,expected", [(28.5, 0.0), (33.0, 1.0), (30.75, 0.5), (20.0, 0.0)])
def test_thermal_stress_points(spark, t, expected):
    assert _one(spark, C.thermal_stress_index(), water_temperature_c=t) == pytest.approx(expected)


@pytest.mark.parametrize("do,expected", [(6.0, 0.0), (2.5, 1.0)])
def test_oxygen_stress_points(spark, do, expected):
    assert _one(spark, C.oxygen_stress_index(), dissolved_oxygen_mg_l=do) == pytest.approx(expected)


def test_acidity_and_substrate_points(spark):
    assert _one(spark, C.acidity_deviation(), ph=8.1) == pytest.approx(0.0)
    assert _one(spark, C.substrate_stability_score(), hard_substrate_percentage=0.0, rugosity_index=1.0) == pytest.approx(0.0)
    assert _one(spark, C.substrate_stability_score(), hard_substrate_percentage=100.0, rugosity_index=10.0) == pytest.approx(1.0)


def test_null_input_null_output(spark):
    assert _one(spark, C.thermal_stress_index(), water_temperature_c=None) is None


@pytest.mark.parametrize("s,cls", [(0.2799, "healthy"), (0.28, "stressed"), (0.47, "bleached"), (0.66, "severely_degraded")])
def test_health_class_left_closed(spark, s, cls):
    assert _one(spark, C.health_class("s"), s=s) == cls


@pytest.mark.parametrize("s,cls", [(0.3999, "unsuitable"), (0.40, "moderately_suitable"), (0.63, "suitable")])
def test_restoration_class_left_closed(spark, s, cls):
    assert _one(spark, C.restoration_class("s"), s=s) == cls


def test_serving_and_training_wqi_differ(spark):
    from tidepool import schema as S

    cols = dict(water_temperature_c=28.0, dissolved_oxygen_mg_l=7.0, ph=7.8, turbidity_ntu=10.0)
    a = _one(spark, C.water_quality_index(S.TRAINING_FEATURE_CONSTANTS), **cols)
    b = _one(spark, C.water_quality_index(S.SERVING_FEATURE_CONSTANTS), **cols)
    assert not math.isclose(a, b)
