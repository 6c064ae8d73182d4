"""Points and polygons against brute force: hot cells, borders, poles, nulls."""

import math
import random

import pytest
from pyspark.sql import functions as F

from placeforge.operators import geo

RINGS = "polygon_id int, points array<struct<x:double,y:double>>"


def ring_edges(spark, rings):
    return geo.edges(spark.createDataFrame([(k, [{"x": float(x), "y": float(y)} for x, y in p]) for k, p in rings], RINGS))


def inside(p, ring):
    """Inside or on the border, by the even-odd rule."""
    x, y = p
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]], strict=True):
        turn = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
        if turn == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
            return True
        if (y1 <= y) != (y2 <= y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
            odd = not odd
    return odd


@pytest.mark.parametrize("most", [5, 40, 100_000])
def test_contained_with_a_hot_cell(spark, most):
    r = random.Random(2)
    blocks = [(k, [(10 + k % 8 / 8, 20 + k // 8 / 8), (10 + (k % 8 + 1) / 8, 20 + k // 8 / 8), (10 + (k % 8 + 1) / 8, 20 + (k // 8 + 1) / 8), (10 + k % 8 / 8, 20 + (k // 8 + 1) / 8)]) for k in range(64)]
    wide = [(100, [(-20, -20), (40, -20), (41, 60), (-20, 60)]), (101, [(9.5, 19.5), (10.5, 20.5), (11, 19)])]
    # a city: most points in one degree square, many of them in one place and on corners
    spots = [(10 + r.randint(0, 64) / 64, 20 + r.randint(0, 64) / 64) for _ in range(150)] + [(10.3, 20.3)] * 100 + [(r.uniform(-60, 60), r.uniform(-60, 80)) for _ in range(60)]
    rows = [*[(k, *p) for k, p in enumerate(spots)], (900, None, 1.0), (901, float("nan"), 1.0), (902, 3.0, float("inf"))]
    got = {q.point_id: q.polygon_id for q in geo.contained(spark.createDataFrame(rows, "point_id int, x double, y double"), ring_edges(spark, blocks + wide), most=most).collect()}
    wanted = {k: min(found) for k, p in enumerate(spots) if (found := [key for key, ring in blocks + wide if inside(p, ring)])}
    assert got == wanted


def test_no_leaf_is_crowded(spark):
    r = random.Random(3)
    points = spark.createDataFrame([(k, 10 + r.gauss(0, 0.05), 20 + r.gauss(0, 0.05)) for k in range(2000)] + [(9000 + k, 1.5, 1.5) for k in range(50)], "point_id int, x double, y double")
    split = geo.crowded(points, 60)
    sizes = {(q.level, q.cx, q.cy): q["count"] for q in geo.placed(points, split).groupBy("level", "cx", "cy").count().collect()}
    assert len(split) > 2 and max(sizes.values()) <= 60 and sum(sizes.values()) == 2050


def test_nearest_polygon_matches_brute_force(spark):
    r = random.Random(3)
    rings = [(k, [(x + 0.2 * math.cos(t), y + 0.3 * math.sin(t)) for t in (0, 1.5, 3, 4.5)]) for k in range(12) for x, y in [(r.uniform(-170, 170), r.uniform(-70, 70))]]
    spots = [(k, r.uniform(-179, 179), r.uniform(-80, 80)) for k in range(60)]
    edges = geo.edges(spark.createDataFrame([(k, [{"x": x, "y": y} for x, y in p]) for k, p in rings], "polygon_id int, points array<struct<x:double,y:double>>"))
    got = {r.point_id: (r.polygon_id, r.distance_m) for r in geo.nearest(spark.createDataFrame(spots, "point_id int, x double, y double"), edges).collect()}
    flat = lambda x, y: (math.radians(x) * geo.RADIUS, math.log(math.tan(math.pi / 4 + math.radians(y) / 2)) * geo.RADIUS)

    def far(p, a, b):
        (px, py), (ax, ay), (bx, by) = flat(*p), flat(*a), flat(*b)
        t = max(0, min(1, ((px - ax) * (bx - ax) + (py - ay) * (by - ay)) / ((bx - ax) ** 2 + (by - ay) ** 2)))
        return math.hypot(px - ax - t * (bx - ax), py - ay - t * (by - ay))

    assert len(got) == len(spots)
    for k, x, y in spots:
        d, polygon = min((min(far((x, y), a, b) for a, b in zip(p, [*p[1:], p[0]], strict=True)), key) for key, p in rings)
        assert got[k][0] == polygon and got[k][1] == pytest.approx(d, rel=1e-9)


def test_places_without_a_place_on_the_map(spark):
    ring = ring_edges(spark, [(1, [(0, 0), (1, 0), (1, 1)])])
    rows = [(1, 0.5, -90.0), (2, 0.5, 95.0), (3, None, 1.0), (4, 0.5, 90.0), (5, float("nan"), 2.0)]
    schema = "point_id int, x double, y double"
    assert sorted(map(tuple, geo.nearest(spark.createDataFrame(rows, schema), ring).collect())) == [(k, None, None) for k in range(1, 6)]
    mixed = geo.nearest(spark.createDataFrame([*rows, (6, 2.0, 0.0)], schema), ring).collect()
    assert {q.point_id: q.polygon_id for q in mixed} == {1: None, 2: None, 3: None, 4: None, 5: None, 6: 1}
    assert sorted(map(tuple, geo.nearest(spark.createDataFrame(rows, schema), ring.limit(0)).collect())) == [(k, None, None) for k in range(1, 6)]
    places = spark.createDataFrame([(k, x, y, "valid") for k, x, y in [*rows, (7, 0.9, 0.1), (8, 1.0005, 0.5)]], "place_id int, longitude double, latitude double, validation_status string")
    got = {q.place_id: (q.spatial_status, q.validation_status) for q in geo.conform_to_polygons(places, ring, 1000.0).collect()}
    assert got == {**{k: ("outside", "invalid") for k in range(1, 6)}, 7: ("inside", "valid"), 8: ("near_boundary", "review")}


def test_dealt_join_is_the_join(spark):
    from placeforge.operators.shaping import dealt_join

    left = spark.range(500).select((F.col("id") % 7 * (F.col("id") % 3)).alias("k"), "id")
    right = spark.createDataFrame([(k, n) for k in range(9) for n in range(k % 3)], "k long, n int")
    for most in (1, 30, 1000):
        assert sorted(map(tuple, dealt_join(left, right, ["k"], most).collect())) == sorted(map(tuple, left.join(right, "k").collect()))


def test_corners_that_two_squares_share_tie(spark):
    """Off a shared corner both squares are equally far, to the last bit: the least key has it."""
    at = lambda k: [(x, k * 10.0 - 25 + y) for x, y in ((15.0, 0.0), (25.0, 0.0), (25.0, 10.0), (15.0, 10.0))]
    rings = spark.createDataFrame([(k, at(k)) for k in range(5)], RINGS)
    points = [(100 * k + j, 50 + j * 0.25, k * 10.0 - 15) for k in range(4) for j in range(80)]
    got = geo.nearest(spark.createDataFrame(points, "point_id long, x double, y double"), geo.edges(rings)).collect()
    assert {r.point_id: r.polygon_id for r in got} == {p: p // 100 for p, _, _ in points}
