"""Points among points and rings: exact nearest neighbours and containment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.operators import ordered as O
from tidepool.sources.io import cut

#: Cell widths are 2**level degrees: the finest level that is tried, and one that holds the globe in a few cells.
FINEST, COARSEST = -16, 9
#: Points of one part of a crowded cell.
CROWD = 4096
#: Edges of rings that go to every task; more are joined by a shuffle.
BROADCAST_EDGES = 200_000
SALTS = 32


def _start_level(points: DataFrame) -> int:
    """The coarsest level at which half the points have a cell of their own, from one pass: clustered points start at fine cells."""
    levels = range(FINEST, COARSEST)
    cells = [F.approx_count_distinct(F.xxhash64("group", *[F.floor(F.col(c) / 2.0**level) for c in ("y", "x")])).alias(f"n{i}") for i, level in enumerate(levels)]
    r = points.agg(F.count(F.lit(1)).alias("n"), *cells).first()
    return max((level for i, level in enumerate(levels) if 2 * r[f"n{i}"] >= r["n"]), default=FINEST)


def nearest(rows: DataFrame, group: str, id_col: str, y: str, x: str, carry: list[str]) -> DataFrame:
    """(group, id, `carry` columns, nn_id, nn_<carry>, distance): each row's nearest other row of its group, ties to the smallest id.

    Rows without a group, id or coordinates have no neighbour and are left out;
    a row that is alone in its group has a null neighbour. Equal points are one
    point with its two smallest ids, whatever their number. A point looks into
    the 3 x 3 cells around it: what it finds nearer than a cell's width is its
    neighbour, else it goes on to cells of twice the width. Crowded cells are
    dealt in parts.
    """
    known = F.col(group).isNotNull() & F.col(id_col).isNotNull() & F.col(y).isNotNull() & F.col(x).isNotNull() & ~F.isnan(y) & ~F.isnan(x)
    own = rows.where(known).select(F.col(group).alias("group"), F.col(id_col).alias("id"), F.col(y).cast("double").alias("y"), F.col(x).cast("double").alias("x"), F.struct(*carry).alias("info"))
    own = cut(own, "points")
    who = F.struct("id", "info")
    first = own.groupBy("group", "y", "x").agg(F.min_by(who, "id").alias("first"), F.count(F.lit(1)).alias("n"))
    points = cut(first, "distinct-points")
    # a point of several rows: the nearest is the smallest other id, at distance 0
    several, point = points.where("n > 1").drop("n"), ["group", "y", "x"]
    second = own.join(several, point).where(F.col("id") > F.col("first.id")).groupBy(*point).agg(F.min_by(who, "id").alias("second"))
    # both ids are brought together by points, so that the rows meet them in one join
    twins = cut(several.join(second, point, "left"), "shared-points")
    near = own.join(twins, point).withColumn("nn", F.when(F.col("id") > F.col("first.id"), F.col("first")).otherwise(F.col("second")))
    settled = [near.select("group", "id", "info", "nn", F.lit(0.0).alias("distance"))]

    todo = points.where("n = 1").select("group", "y", "x", F.col("first.id").alias("id"), F.col("first.info").alias("info"))
    level = _start_level(points)
    step = F.array(F.lit(-1), F.lit(0), F.lit(1))
    while not todo.isEmpty():
        width = 2.0**level
        cell = {"cy": F.floor(F.col("y") / width), "cx": F.floor(F.col("x") / width)}
        around = todo.withColumns(cell).withColumn("_dy", F.explode(step)).withColumn("_dx", F.explode(step))
        around = around.withColumns({"cy": F.col("cy") + F.col("_dy"), "cx": F.col("cx") + F.col("_dx")}).drop("_dy", "_dx")
        placed = points.withColumns(cell)
        parts = placed.groupBy("group", "cy", "cx").agg(F.ceil(F.count(F.lit(1)) / CROWD).alias("parts")).where("parts > 1")
        at = ["group", "cy", "cx"]
        dealt = placed.join(parts, at, "left").withColumn("part", F.pmod(F.xxhash64("y", "x"), F.coalesce("parts", F.lit(1))))
        asked = around.join(parts, at, "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("parts") - 1, F.lit(0)).cast("long"))))
        other = dealt.select(*at, "part", F.col("y").alias("oy"), F.col("x").alias("ox"), "first")
        pairs = asked.select(*at, "part", "id", "y", "x").join(other, [*at, "part"]).where("oy <> y or ox <> x")
        square = (F.col("oy") - F.col("y")) * (F.col("oy") - F.col("y")) + (F.col("ox") - F.col("x")) * (F.col("ox") - F.col("x"))
        best = pairs.withColumn("d2", square).groupBy("group", "id").agg(F.min_by(F.struct("d2", "first"), F.struct("d2", F.col("first.id"))).alias("best"))
        looked = cut(todo.join(best, ["group", "id"], "left"), "neighbours")
        # at the coarsest level the cells around a point hold all there is
        last = level >= COARSEST
        done = F.lit(True) if last else F.coalesce(F.col("best.d2") < width * width, F.lit(False))
        settled.append(looked.where(done).select("group", "id", "info", F.col("best.first").alias("nn"), F.sqrt("best.d2").alias("distance")))
        todo = looked.where(~done).drop("best")
        level += 1
    out = settled[0]
    for s in settled[1:]:
        out = out.unionByName(s)
    return out.select(
        F.col("group").alias(group), F.col("id").alias(id_col), *[F.col(f"info.{c}").alias(c) for c in carry], F.col("nn.id").alias("nn_id"), *[F.col(f"nn.info.{c}").alias(f"nn_{c}") for c in carry], "distance"
    )


def neighbour_agreement(found: DataFrame, group: str, labels: dict[str, str]) -> DataFrame:
    """(group, task, rows, agreement, chance, excess, median_distance) of a ``nearest`` frame that carries the labels.

    Agreement is the share of rows with a neighbour and both labels whose labels
    are equal; chance the sum of squared class shares of these rows. Labels and
    distances are written once, so that neighbours are not searched for each part.
    """
    found = cut(found.where("nn_id is not null").select(group, *labels.values(), *[f"nn_{c}" for c in labels.values()], "distance"), "neighbour-labels")
    each = F.explode(F.array(*[F.struct(F.lit(t).alias("task"), F.col(c).alias("own"), F.col(f"nn_{c}").alias("other")) for t, c in labels.items()]))
    pairs = found.select(group, each.alias("p")).select(group, "p.*").where("own is not null and other is not null")
    counts = pairs.groupBy(group, "task", "own").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("own") == F.col("other")).cast("long")).alias("same"))
    shares = counts.groupBy(group, "task").agg(
        F.sum("n").alias("rows"), (F.sum("same") / F.sum("n")).alias("agreement"), (F.sum(F.col("n").cast("double") * F.col("n")) / F.sum("n") / F.sum("n")).alias("chance")
    )
    medians = O.exact_quantiles(found, [group], ["distance"], {"median_distance": 0.5}).drop("column")
    out = shares.join(medians, group).withColumn("excess", F.col("agreement") - F.col("chance"))
    return out.select(group, "task", "rows", *[F.round(c, 6).alias(c) for c in ("agreement", "chance", "excess", "median_distance")])


def ring_edges(vertices: DataFrame) -> DataFrame:
    """(polygon, y1, x1, y2, x2) with y1 < y2 from vertices (polygon, ring, place, lat, lon); the last vertex joins the first; level edges cross no ray and go."""
    w = Window.partitionBy("polygon", "ring").orderBy("place")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    e = vertices.select("polygon", "ring", "place", "lat", "lon", F.coalesce(F.lead("lat").over(w), F.first("lat").over(whole)).alias("lat2"), F.coalesce(F.lead("lon").over(w), F.first("lon").over(whole)).alias("lon2"))
    up = F.col("lat") < F.col("lat2")
    pick = {"y1": F.when(up, F.col("lat")).otherwise(F.col("lat2")), "x1": F.when(up, F.col("lon")).otherwise(F.col("lon2")), "y2": F.when(up, F.col("lat2")).otherwise(F.col("lat")), "x2": F.when(up, F.col("lon2")).otherwise(F.col("lon"))}
    return e.where("lat <> lat2").select("polygon", *[v.alias(k) for k, v in pick.items()])


def point_in_polygon(points: DataFrame, vertices: DataFrame, id_col: str, lat: str, lon: str, band: float = 0.25) -> DataFrame:
    """(id, polygon) of every point inside a polygon, by the parity of edges that a ray to the east crosses, over all rings: holes and separate parts count.

    An edge takes its lower end and not its upper one, and is crossed if it
    meets the point's latitude strictly east of the point: so of two polygons
    that share an edge, a point on it is in one. Edges are cut by latitude bands
    and a point probes its own band. Points with a null id or coordinate are in
    none; ids must differ.
    """
    edges = ring_edges(vertices)
    bands = F.sequence(F.floor(F.col("y1") / band), F.floor(F.col("y2") / band))
    edges = cut(edges.withColumn("band", F.explode(bands)), "ring-edges")
    p = points.select(F.col(id_col).alias("_id"), F.col(lat).cast("double").alias("_y"), F.col(lon).cast("double").alias("_x")).where("_id is not null").withColumn("band", F.floor(F.col("_y") / band))
    if edges.count() <= BROADCAST_EDGES:
        on, edges = ["band"], F.broadcast(edges)
    else:
        on, p = ["band", "salt"], p.withColumn("salt", F.pmod(F.xxhash64("_id"), F.lit(SALTS)).cast("int"))
        edges = edges.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    meets = F.col("x1") + (F.col("_y") - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    crossed = p.join(edges, on).where((F.col("_y") >= F.col("y1")) & (F.col("_y") < F.col("y2")) & (meets > F.col("_x")))
    odd = crossed.groupBy("_id", "polygon").agg((F.count(F.lit(1)) % 2).alias("_odd")).where("_odd = 1")
    return odd.select(F.col("_id").alias(id_col), "polygon")
