import json
import math
import random

from atlasmill.functions.geo import RADIUS_M
from atlasmill.operators.proximity import containing_regions, near_pairs, region_cover

POINTS = "k string, lat double, lon double, code string, cell long"


def metres(a, b):
    p = math.radians
    x = math.sin(p(b[0] - a[0]) / 2) ** 2 + math.cos(p(a[0])) * math.cos(p(b[0])) * math.sin(p(b[1] - a[1]) / 2) ** 2
    return 2 * RADIUS_M * math.asin(min(1, math.sqrt(x)))


def rows(spark, pts):
    return spark.createDataFrame([(k, y, x, "c", 1) for k, y, x in pts], POINTS)


def test_near_equals_brute_force_at_poles_dateline_equator_and_city(spark):
    rng = random.Random(3)
    pts = []
    for i in range(700):
        place = i % 7
        if place == 0:
            y, x = 90 - rng.random() * 0.003, rng.uniform(-180, 180)
        elif place == 1:
            y, x = -90 + rng.random() * 0.003, rng.uniform(-180, 180)
        elif place == 2:
            y, x = rng.uniform(-0.002, 0.002), rng.choice([-180, 180]) + 0.0
            x = x - math.copysign(rng.random() * 0.002, x)
        elif place == 3:
            y, x = rng.uniform(-0.002, 0.002), rng.uniform(-0.002, 0.002)
        elif place == 4:
            y, x = 85 + rng.uniform(-0.002, 0.002), rng.uniform(10, 10.02)
        elif place == 5:
            y, x = -85 + rng.uniform(-0.002, 0.002), rng.uniform(179.99, 180)
        else:
            y, x = 24.6 + rng.random() * 0.003, 46.6 + rng.random() * 0.003
        pts.append((f"p{i:04d}", y, x))
    want = {(a[0], b[0]) for i, a in enumerate(pts) for b in pts[i + 1 :] if metres(a[1:], b[1:]) <= 75}
    got = [(r["key_a"], r["key_b"]) for r in near_pairs(rows(spark, pts), "k", "lat", "lon", 75.0).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 1000


def test_near_other_radii(spark):
    rng = random.Random(5)
    pts = [(f"p{i:03d}", 50 + rng.random() * 0.2, 8 + rng.random() * 0.2) for i in range(200)]
    for radius in (500.0, 3000.0):
        want = {(a[0], b[0]) for i, a in enumerate(pts) for b in pts[i + 1 :] if metres(a[1:], b[1:]) <= radius}
        assert {(r["key_a"], r["key_b"]) for r in near_pairs(rows(spark, pts), "k", "lat", "lon", radius).collect()} == want


def test_near_leaves_out_unusable_rows_and_keeps_ties(spark):
    pts = [("a", 1.0, 1.0), ("b", 1.0, 1.0), ("c", 1.0, 1.0), ("d", None, 1.0), ("e", 0.0, 0.0), ("f", 0.0, 0.0), ("g", 91.0, 1.0), ("h", 1.0, float("nan")), (None, 1.0, 1.0), ("a", 1.0, 1.0)]
    got = {(r["key_a"], r["key_b"]) for r in near_pairs(rows(spark, pts), "k", "lat", "lon", 75.0).collect()}
    assert got == {("a", "b"), ("a", "c"), ("b", "c")}
    assert near_pairs(rows(spark, []), "k", "lat", "lon", 75.0).count() == 0


SQUARE = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
HOLE = [[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]]
FAR = [[10, 10], [11, 10], [11, 11], [10, 11], [10, 10]]


def test_regions_holes_parts_and_bad_geometry(spark):
    shapes = [
        ("multi", json.dumps({"type": "MultiPolygon", "coordinates": [[SQUARE, HOLE], [FAR]]}), 1),
        ("inner", json.dumps({"type": "Polygon", "coordinates": [HOLE]}), 1),
        ("bad", "{not json", 1), ("null", None, 1), ("line", json.dumps({"type": "LineString", "coordinates": SQUARE}), 1), (None, json.dumps({"type": "Polygon", "coordinates": [FAR]}), 1),
    ]
    cover = region_cover(spark.createDataFrame(shapes, "id string, g string, level int"), "id", "g")
    pts = [("in", 0.5, 0.5), ("hole", 1.5, 1.5), ("part", 10.5, 10.5), ("out", 6.0, 6.0), ("none", None, 0.5)]
    got = {(r["key"], r["region"]) for r in containing_regions(rows(spark, pts), "k", "lat", "lon", cover).collect()}
    assert got == {("in", "multi"), ("hole", "inner"), ("part", "multi")}
    empty = region_cover(spark.createDataFrame([], "id string, g string"), "id", "g")
    assert containing_regions(rows(spark, pts), "k", "lat", "lon", empty).count() == 0


def test_regions_equal_brute_force_on_a_star(spark):
    rng = random.Random(8)
    ring = [[46 + math.cos(t) * r, 24 + math.sin(t) * r] for i in range(40) for t, r in [(i / 40 * 2 * math.pi, 0.2 if i % 2 else 0.07)]]
    ring.append(ring[0])
    pts = [(f"p{i}", 24 + rng.uniform(-0.2, 0.2), 46 + rng.uniform(-0.2, 0.2)) for i in range(600)]

    def inside(y, x):
        odd = False
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                odd = not odd
        return odd

    cover = region_cover(spark.createDataFrame([("s", json.dumps({"type": "Polygon", "coordinates": [ring]}))], "id string, g string"), "id", "g")
    got = {r["key"] for r in containing_regions(rows(spark, pts), "k", "lat", "lon", cover).collect()}
    assert got == {k for k, y, x in pts if inside(y, x)}
