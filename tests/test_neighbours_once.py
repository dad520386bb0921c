"""Neighbours are searched for once, and rows meet their points once."""

from tidepool.operators import spatial as SP


def test_neighbours_are_searched_for_once_and_rows_meet_their_points_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    schema = "g string, id string, k string, nn_id string, nn_k string, distance double"
    rows = [("a", str(i), "p" if i % 3 else None, None if i == 5 else str(i + 1), "q" if i % 2 else "p", float(i % 4)) for i in range(40)]
    found = spark.createDataFrame(rows, schema).mapInArrow(count, schema)
    (r,) = SP.neighbour_agreement(found, "g", {"t": "k"}).collect()
    used = [x for x in rows if x[3] is not None and x[2] is not None]
    assert seen.value == len(rows)
    assert (r["rows"], r.agreement) == (len(used), round(sum(x[2] == x[4] for x in used) / len(used), 6))
    # equal points: two ids in one row of the points, and one join for the rows
    twins = spark.createDataFrame([("a", i, 1.0, 1.0, "p") for i in ("c", "b", "b", "a")] + [("a", "z", 2.0, 2.0, "q")] * 2, "g string, id string, y double, x double, k string")
    near = SP.nearest(twins, "g", "id", "y", "x", ["k"])
    assert sorted((x.id, x.nn_id) for x in near.collect() if x.id != "z") == [("a", "b"), ("b", "a"), ("b", "a"), ("c", "a")]
    assert [x.nn_id for x in near.where("id = 'z'").collect()] == [None, None]
    assert near._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
