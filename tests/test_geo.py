"""Quadtree covers against plain ray casting."""

from __future__ import annotations

import math
import random

import pytest

from civicspark.operators import geo

ZONES = "zone string, coordinates array<array<array<array<double>>>>"


def star(rng, x, y, size, n):
    ring = []
    for i in range(n):
        r, a = size * rng.uniform(0.3, 1), 2 * math.pi * i / n
        ring.append([x + r * math.cos(a), y + r * math.sin(a)])
    return [*ring, ring[0]]


def inside(px, py, polygon):
    hits = 0
    for ring in polygon:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False):
            if (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1:
                hits += 1
    return hits % 2 == 1


@pytest.fixture(scope="module")
def shapes():
    """A polygon ten thousand times as large as others, stars with holes, long thin ones, several in a zone, far away ones."""
    rng = random.Random(6)
    zones = [("zz large", [[star(rng, 0, 0, 10000, 40)]])]
    zones += [(f"s{i}", [[star(rng, rng.uniform(-5, 5), rng.uniform(-5, 5), rng.uniform(0.5, 2), 25)]]) for i in range(8)]
    zones.append(("hole", [[[[-8, -8], [-4, -8], [-4, -4], [-8, -4], [-8, -8]], [[-7, -7], [-5, -7], [-5, -5], [-7, -5], [-7, -7]]]]))
    zones.append(("thin", [[[[-50, 20], [50, 20.5], [50, 20.6], [-50, 20.1], [-50, 20]]]]))
    zones.append(("two", [[star(rng, 30, 30, 4, 200)], [star(rng, 3e6, -4e6, 1000, 9)]]))
    zones = [(z, [[[[float(v) for v in p] for p in ring] for ring in polygon] for polygon in polygons]) for z, polygons in zones]
    points = [(rng.uniform(-10, 10), rng.uniform(-10, 10)) for _ in range(600)] + [(rng.uniform(-12000, 12000), rng.uniform(-12000, 12000)) for _ in range(400)]
    points += [(rng.uniform(25, 35), rng.uniform(25, 35)) for _ in range(200)] + [(rng.uniform(-60, 60), rng.uniform(19.9, 20.7)) for _ in range(200)]
    points += [(3e6 + rng.uniform(-1000, 1000), -4e6 + rng.uniform(-1000, 1000)) for _ in range(100)]
    return zones, points


def test_points_match_ray_casting(spark, shapes):
    zones, points = shapes
    rows = [(i, x, y) for i, (x, y) in enumerate(points)] + [(0, *points[0]), (-1, None, 1.0), (-2, float("nan"), 1.0)]
    got = geo.points_in_polygons(
        spark.createDataFrame(rows, "id long, x double, y double"), spark.createDataFrame(zones, ZONES), key="id", x="x", y="y"
    )
    want = {}
    for i, (x, y) in enumerate(points):
        held = [z for z, polygons in zones if any(inside(x, y, p) for p in polygons)]
        if held:
            want[i] = min(held)
    assert {r.id: r.zone for r in got.collect()} == want and len(set(want.values())) > 8


def test_covers_are_bounded_whatever_the_size(spark, shapes):
    cover = geo.cover(spark.createDataFrame(shapes[0], ZONES))
    finest = cover.cells.groupBy("zone", "polygon").agg({"level": "min"}).collect()
    counts = {(r.zone, r.polygon): r["count"] for r in cover.cells.groupBy("zone", "polygon").count().collect()}
    assert len(finest) == len(counts) == sum(len(p) for _, p in shapes[0])
    assert all(2 <= n <= 34 * 34 for n in counts.values())
    # inner cells of several levels, and no edge within any
    inner = cover.cells.where("inner")
    assert len({(r.zone, r.level) for r in inner.select("zone", "level").distinct().collect()}) > 2 * len(shapes[0])
    assert inner.join(cover.edges, ["zone", "polygon", "level", "ix", "iy"]).isEmpty()
    # cells don't overlap: areas add up to no more than the box
    areas = cover.cells.selectExpr("zone", "polygon", "pow(4.0, level) AS a").groupBy("zone", "polygon").sum("a").collect()
    levels = {(r.zone, r.polygon): r["min(level)"] for r in finest}
    assert all(r["sum(a)"] <= 34 * 34 * 4.0 ** levels[r.zone, r.polygon] for r in areas)


def test_no_zones_and_points_of_zones(spark):
    none = spark.createDataFrame([], ZONES)
    points = spark.createDataFrame([(1, 0.0, 0.0)], "id long, x double, y double")
    assert geo.points_in_polygons(points, none, key="id", x="x", y="y").collect() == []
    flat = spark.createDataFrame([("point", [[[[1.0, 1.0], [1.0, 1.0]]]]), ("gone", None), ("empty", [])], ZONES)
    assert geo.points_in_polygons(points, flat, key="id", x="x", y="y").collect() == []
