"""The hierarchical cover against the band join and a search of all polygons."""

import math
import random

import pytest
from pyspark.sql import functions as F

from gridspark.operators import cover, regrid


def holds(ring, x, y):
    odd = False
    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
        if (ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay):
            odd = not odd
    return odd


def star(rng, n, cx, cy, r):
    return [(cx + r * rng.uniform(0.3, 1) * math.cos(2 * math.pi * k / n), cy + r * rng.uniform(0.3, 1) * math.sin(2 * math.pi * k / n)) for k in range(n)]


def rings(rng, kind):
    if kind == "stars":
        return {k: star(rng, 40 + 60 * k, rng.uniform(-3, 3), rng.uniform(-3, 3), 4) for k in range(4)}
    if kind == "whole":  # whole numbers: level and upright edges, vertices at heights of points
        return {0: [(0, 0), (6, 0), (6, 4), (4, 4), (4, 2), (2, 2), (2, 4), (0, 4)], 1: [(-5, -5), (5, -5), (5, 5), (-5, 5)], 2: [(1, 1), (8, 1), (1, 8)], 3: [(-2, 3), (3, 3), (3, -2), (7, -2), (7, 7), (-2, 7)]}
    return {0: [(x / 50, (x % 2) * 10 - 5) for x in range(-60, 60)] + [(4.0, 9.0), (-4.0, 9.0)]}  # a comb: all edges in every row


@pytest.mark.parametrize("kind", ["stars", "whole", "comb"])
@pytest.mark.parametrize("most", [3])
def test_cover_is_the_search(spark, kind, most):
    rng = random.Random(most)
    own = rings(rng, kind)
    vertices = spark.createDataFrame([(p, k, float(x), float(y)) for p, ring in own.items() for k, (x, y) in enumerate(ring)], "p int, k int, x double, y double")
    edges = regrid.polygon_edges(vertices, "p", "k", "x", "y", level=True)
    places = [(rng.uniform(-9, 9), rng.uniform(-9, 9)) for _ in range(600)] + [(float(a), float(b)) for a in range(-6, 10) for b in range(-6, 9)] + [(100.0, 100.0)]
    points = spark.createDataFrame([(k, *p) for k, p in enumerate(places)] + [(-1, None, 1.0)], "id int, a double, b double")
    got = {r.id: r.label for r in cover.points_by_cover(points, "a", "b", ["id"], edges, "p", most).collect()}
    for k, (x, y) in enumerate(places):
        assert got[k] == max((p for p, ring in own.items() if holds(ring, x, y)), default=None), (x, y)
    assert got[-1] is None and len(got) == len(places) + 1


def test_tests_per_point_are_bounded(spark):
    """600 edges in every row: cells of the cover have 8 at most, bands have all."""
    comb = [(x / 30, (x % 2) * 10.0 - 5) for x in range(-300, 300)]
    vertices = spark.createDataFrame([(0, k, x, y) for k, (x, y) in enumerate([*comb, (10.0, 9.0), (-10.0, 9.0)])], "p int, k int, x double, y double")
    edges = regrid.polygon_edges(vertices, "p", "k", "x", "y", level=True)
    cells, sizes = cover.cover(edges, "p")
    assert cells.agg(F.max(F.size("edges"))).first()[0] <= cover.MOST_EDGES
    assert cells.groupBy("p", "level", "cx", "cy").count().where("count > 1").isEmpty() and len(sizes) > 5


def test_no_polygons(spark):
    edges = spark.createDataFrame([], "p int, ax double, ay double, bx double, by double")
    points = spark.createDataFrame([(1, 0.0, 0.0)], "id int, a double, b double")
    assert [r.label for r in cover.points_by_cover(points, "a", "b", ["id"], edges, "p").collect()] == [None]
