"""Points and polygons: which polygon holds a point, and the nearest one.

Points meet polygons in the cells of a quadtree that splits by count: a degree square with more points than a task
should hold becomes four, and so on. Points that no split can part, and edges that many points ask for, are dealt to parts.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import stored
from .shaping import dealt_join

#: Degrees of the cells that the tree starts from, how often a cell may be split, and how many points a cell keeps.
CELL, LEVELS, MOST = 1.0, 12, 100_000
RADIUS = 6378137.0
#: Metres of the first cells in the search for the nearest polygon: the largest, and how often they may be halved.
FIRST_CELL_M, HALVINGS = 100_000.0, 7


def edges(rings: DataFrame, key: str = "polygon_id", points: str = "points") -> DataFrame:
    """x1, y1, x2, y2 of each edge of rings given as arrays of (x, y), closed or not."""
    pts = F.col(points)
    closed = F.concat(pts, F.array(F.element_at(pts, 1)))
    steps = F.transform(F.sequence(F.lit(0), F.size(pts) - 1), lambda i: F.struct(F.get(closed, i)["x"].alias("x1"), F.get(closed, i)["y"].alias("y1"), F.get(closed, i + 1)["x"].alias("x2"), F.get(closed, i + 1)["y"].alias("y2")))
    return rings.select(key, F.explode(steps).alias("e")).select(key, "e.*").where("x1 <> x2 OR y1 <> y2")


def cells(low: Column, high: Column, width: float = CELL) -> Column:
    return F.explode(F.sequence(F.floor(low / width).cast("int"), F.floor(high / width).cast("int")))


def crowded(points: DataFrame, most: int = MOST, levels: int = LEVELS) -> list[DataFrame]:
    """For each level of the tree, from the coarsest, the cells (cx, cy) with more than ``most`` points: those that are split.

    Points are counted once, by the finest cells; what is left has a row a place. A level has at most points / most
    cells, which are broadcast.
    """
    fine = CELL / (1 << levels)
    counts = stored(points.groupBy(F.floor(F.col("x") / fine).alias("ix"), F.floor(F.col("y") / fine).alias("iy")).agg(F.count(F.lit(1)).alias("n")), "cell-counts")
    out = []
    for level in range(levels):
        at = [F.shiftright(c, levels - level).cast("int").alias(k) for c, k in (("ix", "cx"), ("iy", "cy"))]
        split = stored(counts.groupBy(*at).agg(F.sum("n").alias("n")).where(F.col("n") > most).select("cx", "cy"), "split-cells")
        if split.isEmpty():
            break
        out.append(split)
    return out


def placed(points: DataFrame, split: list[DataFrame]) -> DataFrame:
    """``points`` (x, y) with level, cx and cy of the leaf that holds them."""
    out = points.withColumns({"level": F.lit(0), "cx": F.floor(F.col("x") / CELL).cast("int"), "cy": F.floor(F.col("y") / CELL).cast("int")})
    for level, cut in enumerate(split):
        width = CELL / (2 << level)
        out = out.join(F.broadcast(cut.withColumn("_split", F.lit(level))), ["cx", "cy"], "left")
        deeper = F.col("_split").isNotNull() & (F.col("level") == level)
        out = out.withColumns({"level": F.when(deeper, level + 1).otherwise(F.col("level")), "cx": F.when(deeper, F.floor(F.col("x") / width).cast("int")).otherwise(F.col("cx")), "cy": F.when(deeper, F.floor(F.col("y") / width).cast("int")).otherwise(F.col("cy"))}).drop("_split")
    return out


def spread(boxes: DataFrame, split: list[DataFrame]) -> DataFrame:
    """A row for each leaf that a box (x_lo, x_hi, y_lo, y_hi) reaches."""
    out = boxes.withColumn("level", F.lit(0)).withColumn("cx", cells(F.col("x_lo"), F.col("x_hi"))).withColumn("cy", cells(F.col("y_lo"), F.col("y_hi")))
    for level, cut in enumerate(split):
        width = CELL / (2 << level)
        out = out.join(F.broadcast(cut.withColumn("_split", F.lit(level))), ["cx", "cy"], "left")
        deeper = F.col("_split").isNotNull() & (F.col("level") == level)
        half = lambda c, low, high, w=width: F.filter(F.array(F.col(c) * 2, F.col(c) * 2 + 1), lambda k: (k >= F.floor(F.col(low) / w)) & (k <= F.floor(F.col(high) / w)))
        out = out.withColumn("cx", F.explode(F.when(deeper, half("cx", "x_lo", "x_hi")).otherwise(F.array("cx"))))
        out = out.withColumn("cy", F.explode(F.when(deeper, half("cy", "y_lo", "y_hi")).otherwise(F.array("cy"))))
        out = out.withColumn("level", F.when(deeper, level + 1).otherwise(F.col("level"))).drop("_split")
    return out


def finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))


def contained(points: DataFrame, polygon_edges: DataFrame, key: str = "polygon_id", x: str = "x", y: str = "y", point: str = "point_id", most: int = MOST) -> DataFrame:
    """(point, polygon) for points inside or on the border; of several polygons the least key.

    Points meet only the polygons whose bounding boxes reach their leaf of the quadtree, by an equi-join; then a ray is
    cast. No join key has more than ``most`` points. Points without finite coordinates are in no polygon.
    """
    box = polygon_edges.groupBy(key).agg(F.min(F.least("x1", "x2")).alias("x_lo"), F.max(F.greatest("x1", "x2")).alias("x_hi"), F.min(F.least("y1", "y2")).alias("y_lo"), F.max(F.greatest("y1", "y2")).alias("y_hi"))
    at = stored(points.select(F.col(point), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).where(finite(F.col("x")) & finite(F.col("y"))), "points")
    split = crowded(at, most)
    near = dealt_join(placed(at, split), spread(box, split), ["level", "cx", "cy"], most)
    near = near.where("x BETWEEN x_lo AND x_hi AND y BETWEEN y_lo AND y_hi").select(point, "x", "y", key, F.floor(F.col("y") / CELL).cast("int").alias("cy"))
    # a ray to the side crosses only edges on the point's height, so a polygon's edges are dealt by rows of the grid
    bands = polygon_edges.withColumn("cy", cells(F.least("y1", "y2"), F.greatest("y1", "y2")))
    rows = dealt_join(stored(near, "near-polygons"), bands, [key, "cy"], most)
    turn = (F.col("x2") - F.col("x1")) * (F.col("y") - F.col("y1")) - (F.col("y2") - F.col("y1")) * (F.col("x") - F.col("x1"))
    on = (turn == 0) & F.col("x").between(F.least("x1", "x2"), F.greatest("x1", "x2")) & F.col("y").between(F.least("y1", "y2"), F.greatest("y1", "y2"))
    up = (F.col("y1") <= F.col("y")) & (F.col("y") < F.col("y2")) & (turn > 0)
    down = (F.col("y2") <= F.col("y")) & (F.col("y") < F.col("y1")) & (turn < 0)
    hit = rows.groupBy(point, key).agg(F.max(on).alias("on"), F.count_if(up | down).alias("crossings")).where(F.col("on") | (F.col("crossings") % 2 == 1))
    return hit.groupBy(point).agg(F.min(key).alias(key))


def mercator_x(lon: Column) -> Column:
    return lon * F.lit(math.pi / 180 * RADIUS)


def mercator_y(lat: Column) -> Column:
    """Web Mercator; distances grow with the latitude, as they do there. The poles and what lies beyond have no value: null."""
    return F.when(F.abs(lat) < 90, F.log(F.tan(F.lit(math.pi / 4) + lat * F.lit(math.pi / 360))) * RADIUS)


def first_width(e: DataFrame) -> float:
    """The least cell width, of those tried, at which the edges do not fall into more than four cells each on average."""
    widths = [FIRST_CELL_M / (1 << k) for k in range(HALVINGS + 1)]
    reach = lambda a, b, w: F.floor(F.col(b) / w) - F.floor(F.col(a) / w) + 1
    sums = e.agg(F.count(F.lit(1)), *[F.sum(reach("x_lo", "x_hi", w) * reach("y_lo", "y_hi", w)) for w in widths]).first()  # one row
    return min((w for w, n in zip(widths, sums[1:], strict=True) if n is not None and n <= 4 * sums[0]), default=FIRST_CELL_M)


def nearest(points: DataFrame, polygon_edges: DataFrame, key: str = "polygon_id", x: str = "x", y: str = "y", point: str = "point_id", most: int = MOST) -> DataFrame:
    """(point, polygon, distance_m): the polygon whose border is nearest in Web Mercator metres, the least key in a tie.

    A search in rings: points meet the edges of their grid cell and the eight around it, by an equi-join. A point is done
    if what it met is no farther than a cell is wide, as nothing outside the nine cells can be nearer; the others go on
    with cells twice as wide, until one cell holds all edges. The first cells are as small as the edges allow, so that a city's
    points meet few edges; a cell with more than ``most`` points is dealt to parts. Points without a place on the map (a
    coordinate that is null or not finite, a latitude of 90 or beyond), and all points if there are no edges, have no
    polygon and no distance. Edges without a place count for nothing.
    """
    metres = polygon_edges.select(key, *[(mercator_x if c[0] == "x" else mercator_y)(F.col(c)).alias(c) for c in ("x1", "y1", "x2", "y2")])
    metres = metres.where(reduce(lambda a, b: a & b, [finite(F.col(c)) for c in ("x1", "y1", "x2", "y2")]))
    e = stored(metres.withColumns({"x_lo": F.least("x1", "x2"), "x_hi": F.greatest("x1", "x2"), "y_lo": F.least("y1", "y2"), "y_hi": F.greatest("y1", "y2")}), "edges")
    every = stored(points.select(F.col(point), mercator_x(F.col(x).cast("double")).alias("px"), mercator_y(F.col(y).cast("double")).alias("py")), "points")
    there = finite(F.col("px")) & finite(F.col("py"))
    nowhere = lambda rows: rows.select(point, F.lit(None).cast(e.schema[key].dataType).alias(key), F.lit(None).cast("double").alias("distance_m"))
    left, found = every.where(there), [nowhere(every.where(~there))]
    bounds = e.agg(F.min("x_lo"), F.max("x_hi"), F.min("y_lo"), F.max("y_hi")).first()
    reach = left.agg(F.min("px"), F.max("px"), F.min("py"), F.max("py")).first()
    if bounds[0] is None or reach[0] is None:
        return nowhere(every)
    span = max(max(bounds[1], reach[1]) - min(bounds[0], reach[0]), max(bounds[3], reach[3]) - min(bounds[2], reach[2]))
    width = first_width(e)
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((F.col("px") - F.col("x1")) * dx + (F.col("py") - F.col("y1")) * dy) / (dx * dx + dy * dy)))
    # at an end the distance is that to the corner itself, so edges that share it tie exactly
    off = lambda p, a, b, step: F.when(t <= 0, F.col(p) - F.col(a)).when(t >= 1, F.col(p) - F.col(b)).otherwise(F.col(p) - F.col(a) - t * step)
    d = F.sqrt(F.pow(off("px", "x1", "x2", dx), 2) + F.pow(off("py", "y1", "y2", dy), 2))
    while True:
        cell = lambda c, w=width: F.floor(F.col(c) / w).cast("int")
        near_edges = e.withColumn("cx", F.explode(F.sequence(cell("x_lo"), cell("x_hi")))).withColumn("cy", F.explode(F.sequence(cell("y_lo"), cell("y_hi"))))
        around = lambda c: F.explode(F.array(*[cell(c) + k for k in (-1, 0, 1)]))
        asks = left.withColumn("cx", around("px")).withColumn("cy", around("py"))
        best = dealt_join(asks, near_edges, ["cx", "cy"], most).groupBy(point).agg(F.min(F.struct(d.alias("distance_m"), F.col(key).alias(key))).alias("c"))
        last = width > span
        near = stored(best.select(point, f"c.{key}", "c.distance_m").where(F.lit(last) | (F.col("distance_m") <= width)), "nearest")
        found.append(near)
        left = stored(left.join(near.select(point), point, "left_anti"), "points")
        if last or left.isEmpty():
            return reduce(DataFrame.unionByName, found)
        width *= 2


def conform_to_polygons(places: DataFrame, polygon_edges: DataFrame, tolerance_m: float, key: str = "polygon_id", point: str = "place_id") -> DataFrame:
    """spatial_status (inside, near_boundary, outside) and province; valid places outside become review or invalid."""
    inside = contained(places, polygon_edges, key, "longitude", "latitude", point).select(point, F.col(key).alias("_in"))
    out = places.join(inside, point, "left")
    far = nearest(out.where(F.col("_in").isNull()), polygon_edges, key, "longitude", "latitude", point).select(point, F.col(key).alias("_near"), "distance_m")
    out = out.join(far, point, "left")
    near = F.col("distance_m") <= tolerance_m
    status = F.when(F.col("_in").isNotNull(), "inside").when(near, "near_boundary").otherwise("outside")
    ruled = F.when(F.col("validation_status") == "invalid", "invalid").when(status == "near_boundary", "review").when(status == "outside", "invalid").otherwise(F.col("validation_status"))
    return out.withColumns({"spatial_status": status, "province_id": F.coalesce("_in", F.when(near, F.col("_near"))), "validation_status": ruled}).drop("_in", "_near")
