"""Nearest neighbours, containment and provenance rules against plain versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepool.operators import provenance as PV
from tidepool.operators import spatial as SP


def scattered(seed):
    r = random.Random(seed)
    rows = [("a", f"c{i}", 10 + r.gauss(0, 0.001), 20 + r.gauss(0, 0.001), r.choice("pq")) for i in range(60)]  # a cluster
    rows += [("a", f"u{i}", r.uniform(0, 30), r.uniform(-40, 40), r.choice("pq")) for i in range(40)]
    rows += [("a", f"d{i}", 5.0, 5.0, r.choice("pq")) for i in range(7)]  # one place, many rows
    rows += [("a", f"g{i}{j}", 1.0 + i / 4, 1.0 + j / 4, "p") for i in range(5) for j in range(5)]  # ties
    rows += [("a", "far", -80.0, 170.0, "p"), ("b", "two", 0.0, 0.0, "p"), ("b", "one", 0.0, 90.0, None), ("lone", "x", 1.0, 1.0, "q")]
    return rows


@pytest.mark.parametrize("crowd", [4, 4096])
def test_nearest_equals_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(SP, "CROWD", crowd)
    rows = scattered(crowd)
    odd = [("a", "n1", None, 1.0, "p"), ("a", "n2", float("nan"), 1.0, "p"), (None, "n3", 1.0, 1.0, "p"), ("a", None, 1.0, 1.0, "p")]
    frame = spark.createDataFrame(rows + odd, "g string, id string, y double, x double, k string").withColumn("first", F.lit("own"))
    got = {r.id: r for r in SP.nearest(frame, "g", "id", "y", "x", ["k"]).collect()}
    assert set(got) == {r[1] for r in rows}
    for g, i, y, x, k in rows:
        others = [((oy - y) * (oy - y) + (ox - x) * (ox - x), oi, ok) for og, oi, oy, ox, ok in rows if og == g and oi != i]
        if not others:
            assert (got[i].nn_id, got[i].distance) == (None, None)
            continue
        d2, nn, nk = min(others, key=lambda o: (o[0], o[1]))
        assert (got[i].nn_id, got[i].nn_k, got[i].k) == (nn, nk, k), i
        assert got[i].distance == pytest.approx(np.sqrt(d2))


def test_agreement_counts_labelled_pairs(spark):
    rows = [("a", "1", 0.0, 0.0, "p"), ("a", "2", 0.0, 0.1, "p"), ("a", "3", 0.0, 0.3, "q"), ("a", "4", 5.0, 5.0, None)]
    found = SP.nearest(spark.createDataFrame(rows, "g string, id string, y double, x double, k string"), "g", "id", "y", "x", ["k"])
    (r,) = SP.neighbour_agreement(found, "g", {"t": "k"}).collect()
    assert (r.rows, r.agreement, r.chance) == (3, pytest.approx(2 / 3, abs=1e-6), pytest.approx(5 / 9, abs=1e-6))


def test_nearest_of_no_rows(spark):
    assert SP.nearest(spark.createDataFrame([], "g string, id string, y double, x double, k string"), "g", "id", "y", "x", ["k"]).count() == 0


def brute_inside(rings, y, x):
    odd = False
    for ring in rings:
        for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1]):
            if a == c:
                continue
            y1, x1, y2, x2 = (a, b, c, d) if a < c else (c, d, a, b)
            if y1 <= y < y2 and x1 + (y - y1) * (x2 - x1) / (y2 - y1) > x:
                odd = not odd
    return odd


@pytest.mark.parametrize("most", [0, 200_000])
def test_containment_equals_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(SP, "BROADCAST_EDGES", most)
    r = random.Random(most)
    star = [(3 + s * np.sin(t), 3 + s * np.cos(t)) for s, t in zip([2.5, 0.9] * 7, np.linspace(0, 2 * np.pi, 14, endpoint=False))]
    star = [(float(a), float(b)) for a, b in star]
    polygons = {"star": [star], "holed": [[(0, 0), (0, 6), (6, 6), (6, 0)], [(2, 2), (2, 4), (4, 4), (4, 2)]], "comb": [[(0, 0), (0, 6), (5, 5), (1, 4), (5, 3), (1, 2), (5, 1)]], "parts": [[(0, 0), (0, 1), (1, 1), (1, 0)], [(4, 4), (4, 5), (5, 5), (5, 4)]], "left": [[(0, 0), (0, 3), (6, 3), (6, 0)]], "right": [[(0, 3), (0, 6), (6, 6), (6, 3)]]}
    polygons = {k: [[(float(a), float(b)) for a, b in ring] for ring in v] for k, v in polygons.items()}
    points = [(i, r.uniform(-1, 7), r.uniform(-1, 7)) for i in range(300)] + [(1000 + 10 * i + j, float(i), float(j)) for i in range(7) for j in range(7)] + [(5000, None, 1.0), (5001, 1.0, None), (None, 1.0, 1.0)]
    vertices = [(p, i, k, *v) for p, rings in polygons.items() for i, ring in enumerate(rings) for k, v in enumerate(ring)]
    got = SP.point_in_polygon(spark.createDataFrame(points, "id long, y double, x double"), spark.createDataFrame(vertices, "polygon string, ring int, place int, lat double, lon double"), "id", "y", "x", band=0.7).collect()
    expected = {(i, p) for i, y, x in points if None not in (i, y, x) for p, rings in polygons.items() if brute_inside(rings, y, x)}
    assert {(r.id, r.polygon) for r in got} == expected and len(got) == len(expected)
    # a point on the shared edge of two polygons is in one of them
    assert all(((1000 + 10 * i + 3, "left") in expected) != ((1000 + 10 * i + 3, "right") in expected) for i in range(6))


GOOD = ("t", "survey", False, "measured", "observed", "open", "report")


@pytest.mark.parametrize(
    "change, rules",
    [
        ({}, set()),
        ({"data_source": None}, {"provenance_missing"}),
        ({"citation": "  "}, {"provenance_missing"}),
        ({"is_synthetic": None}, {"provenance_missing"}),
        ({"observation_type": "guessed"}, {"observation_type_unknown"}),
        ({"label_type": "sure"}, {"label_type_unknown"}),
        ({"is_synthetic": True, "label_type": "synthetic"}, {"synthetic_row_called_measured", "mixed_training_table"}),
        ({"observation_type": "synthetic"}, {"real_row_called_synthetic"}),
        ({"is_synthetic": True, "observation_type": "synthetic"}, {"synthetic_label_called_observed", "mixed_training_table"}),
    ],
)
def test_each_provenance_rule(spark, change, rules):
    names = ["table", "data_source", "is_synthetic", "observation_type", "label_type", "source_licence", "citation"]
    frame = spark.createDataFrame([GOOD, tuple((dict(zip(names, GOOD)) | change).values())], "table string, data_source string, is_synthetic boolean, observation_type string, label_type string, source_licence string, citation string")
    got = PV.provenance_guard(frame, "table", {"t": ["ph"]}, ["bleaching_percentage"]).collect()
    assert {(r.rule, r.broken_rows, r.rows) for r in got} == {(x, 1, 2) for x in rules}
    leaked = PV.provenance_guard(frame, "table", {"t": ["bleaching_percentage"]}, ["bleaching_percentage"]).where("rule = 'label_source_in_features'").collect()
    assert [(r.broken_rows, r.rows) for r in leaked] == [(2, 2)]
