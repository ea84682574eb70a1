"""Polygon cells against a plain crossing count."""

import math
import random

from wakeline.operators import spatial


def star(r, feature, x, y, radius, corners, low=0.4):
    """A ring of random radius round a point."""
    ring = []
    for k in range(corners):
        angle, far = 2 * math.pi * k / corners, radius * r.uniform(low, 1.0)
        ring.append((x + far * math.cos(angle), y + far * math.sin(angle)))
    return [(feature, *ring[k], *ring[(k + 1) % corners]) for k in range(corners)]


def plain(point, edges):
    x, y = point
    return sum((b > y) != (d > y) and x < a + (y - b) * (c - a) / (d - b) for _f, a, b, c, d in edges) % 2 == 1


def test_inside_equals_plain_count(spark):
    r = random.Random(2)
    rings = {"small": star(r, "small", 0.3, 0.2, 0.4, 9), "long": star(r, "long", 5.0, 5.0, 6.0, 4_000), "box": [
        ("box", -3.0, -3.0, 3.0, -3.0), ("box", 3.0, -3.0, 3.0, 3.0), ("box", 3.0, 3.0, -3.0, 3.0), ("box", -3.0, 3.0, -3.0, -3.0),
        ("box", -1.0, -1.0, 1.0, -1.0), ("box", 1.0, -1.0, 1.0, 1.0), ("box", 1.0, 1.0, -1.0, 1.0), ("box", -1.0, 1.0, -1.0, -1.0)]}
    points = [(i, r.uniform(-4, 12), r.uniform(-4, 12)) for i in range(3_000)] + [(i + 3_000, r.uniform(-0.2, 0.8), r.uniform(-0.2, 0.6)) for i in range(500)]
    points += [(4_000, None, 1.0), (4_001, 0.0, 2.0)]
    edges = spark.createDataFrame([e for ring in rings.values() for e in ring], "feature_id string, a_lon double, a_lat double, b_lon double, b_lat double")
    where = spark.createDataFrame(points, "id long, longitude double, latitude double").repartition(3)
    want = {(i, f) for i, x, y in points if x is not None for f, ring in rings.items() if plain((x, y), ring)}
    for cell in (0.05, 0.7):
        got = [tuple(row) for row in spatial.inside_polygon(where, edges, ["id"], cell).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_border_cells_hold_few_edges_of_a_long_ring(spark):
    r = random.Random(3)
    for corners in (500, 8_000):
        ring = spark.createDataFrame(star(r, "f", 0.0, 0.0, 2.0, corners, 0.999), "feature_id string, a_lon double, a_lat double, b_lon double, b_lat double")
        cells = spatial.polygon_cover(ring, 0.5).selectExpr("size(edges) AS n", "level").collect()
        assert max(c.n for c in cells if c.n is not None) <= 120
    assert {c.level for c in cells if c.n is None} >= {0, 1}  # inner blocks without edges


def test_no_rings(spark):
    rings = spark.createDataFrame([], "feature_id string, a_lon double, a_lat double, b_lon double, b_lat double")
    where = spark.createDataFrame([(1, 0.0, 0.0)], "id long, longitude double, latitude double")
    assert spatial.inside_polygon(where, rings, ["id"], 0.1).collect() == []


def test_nearest_at_any_distance_equals_brute_force(spark):
    r = random.Random(4)
    lines = [(f"f{i:03}", x, y, x + dx, y + dy) for i in range(300) for x, y, dx, dy in [
        (r.choice([-170, 4, 100]) + r.uniform(-3, 3), r.choice([-60, 54]) + r.uniform(-3, 3), r.uniform(-9, 9) * (i % 10 == 0), r.uniform(-0.3, 0.3))]]
    lines += [("dot", 20.0, 60.0, None, None), ("twin b", -40.0, 10.0, None, None), ("twin a", -40.0, 10.0, None, None), ("gone", None, None, None, None)]
    points = [(i, r.uniform(-180, 180), r.uniform(-90, 90)) for i in range(200)] + [(500 + i, 4 + r.uniform(-4, 4), 54 + r.uniform(-4, 4)) for i in range(200)]
    points += [(900, -40.0, 10.0), (901, 180.0, -90.0), (902, None, 1.0), (903, 0.0, 91.0)]

    def far(x, y, a, b, c, d):
        flat = lambda u, v: ((u - x) * 60 * math.cos(math.radians((v + y) / 2)), (v - y) * 60)
        (ax, ay), (bx, by) = flat(a, b), flat(a if c is None else c, b if d is None else d)
        vx, vy = bx - ax, by - ay
        long2 = vx * vx + vy * vy
        t = 0 if long2 <= 1e-12 else max(0, min(1, -(ax * vx + ay * vy) / long2))
        return math.hypot(ax + t * vx, ay + t * vy)

    segs = spark.createDataFrame([(*line, f"kind {line[0][:1]}", None) for line in lines],
                                 "feature_id string, a_lon double, a_lat double, b_lon double, b_lat double, infrastructure_type string, name string")
    places = spark.createDataFrame(points, "id long, longitude double, latitude double").repartition(3)
    got = {row.id: row for row in spatial.infrastructure_context(places, segs, "id", 5.0, 0.5).collect()}
    assert len(got) == len(points)
    for i, x, y in points:
        row = got[i]
        if i in (902, 903):
            assert row.nearest_reference_id is None and not row.found_within_search_radius
            continue
        distance, feature = min((round(far(x, y, *line[1:]), 7), line[0]) for line in lines if line[1] is not None)
        assert abs(row.nearest_distance_nm - distance) < 1e-6 and (row.nearest_reference_id == feature or len(
            [line for line in lines if line[1] is not None and abs(far(x, y, *line[1:]) - distance) < 1e-6]) > 1)
        assert row.found_within_search_radius == (distance <= 5) and row.near_infrastructure_reference == (distance <= 0.5)
        assert row.nearest_type == f"kind {row.nearest_reference_id[:1]}" and row.nearest_name == row.nearest_reference_id
    assert got[900].nearest_reference_id == "twin a"
    none = spatial.infrastructure_context(places, segs.limit(0), "id", 5.0, 0.5).collect()
    assert len(none) == len(points) and all(row.nearest_reference_id is None and not row.near_infrastructure_reference for row in none)
