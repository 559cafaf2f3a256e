"""The distance transform against a search of all sources."""

import random
import time

import pytest
from pyspark.sql import functions as F

from gridspark.operators import distance, fill, labels


def nearest(sources, i, j):
    return min(sources, key=lambda s: ((s[0] - i) ** 2 + (s[1] - j) ** 2, s[1], s[0]))


@pytest.mark.parametrize("seed", range(4))
def test_against_search(spark, seed):
    """Sparse and dense grids, negative cells, many ties, two keys of different extents."""
    rng = random.Random(seed)
    n = (6, 6, 30, 12)[seed]
    rows = []
    for key in ("a", "b", None):
        cells = [(i, j) for i in range(-n, n) for j in range(-3, n)]
        rows += [(key, i, j, rng.random() < (0.1, 0.5, 0.004, 0.02)[seed]) for i, j in rng.sample(cells, int(len(cells) * (1, 0.4, 1, 0.7)[seed]))]
    rows += [("no source", 1, 1, False)]
    df = spark.createDataFrame([r for r in rows if r[0] is not None], "key string, i int, j int, source boolean")
    got = {(r.key, r.i, r.j): (r.source_i, r.source_j, r.d2) for r in distance.nearest_sources(df.where("not source"), df.where("source"), ["key"]).collect()}
    for key in ("a", "b", "no source"):
        sources = [(i, j) for k, i, j, s in rows if k == key and s]
        for k, i, j, s in rows:
            if k == key and not s:
                want = nearest(sources, i, j) if sources else None
                assert got.get((key, i, j)) == (want and (*want, (want[0] - i) ** 2 + (want[1] - j) ** 2))


def test_envelope_on_a_line():
    rng = random.Random(9)
    for _ in range(500):
        place = sorted(rng.sample(range(-20, 20), rng.randint(1, 12)))
        height = [rng.randint(0, 9) for _ in place]
        rank = rng.sample(range(len(place)), len(place))
        low, start = distance.envelope(place, height, rank)
        for x in range(-30, 30):
            k = max([m for m in range(len(low)) if m == 0 or start[m] <= x])
            assert low[k] == min(range(len(place)), key=lambda p: ((x - place[p]) ** 2 + height[p] ** 2, rank[p]))


def test_hole_of_500(spark):
    """A ring of sources around 500 x 500 cells."""
    n = 500
    df = spark.range((n + 2) * (n + 2)).select((F.col("id") % (n + 2)).cast("int").alias("i"), F.floor(F.col("id") / (n + 2)).cast("int").alias("j"))
    edge = F.col("i").isin(0, n + 1) | F.col("j").isin(0, n + 1)
    df = df.select("i", "j", F.when(edge, F.col("i") * 1000 + F.col("j")).alias("v"), F.lit(True).alias("inside"))
    began = time.time()
    got = fill.fill_nearest(df, "v", "inside").where("i > 0 and j > 0").where(f"i <= {n} and j <= {n}")
    far = F.least(F.col("i"), F.col("j"), n + 1 - F.col("i"), n + 1 - F.col("j"))
    d = F.hypot(F.col("i") - F.floor(F.col("v") / 1000), F.col("j") - F.col("v") % 1000)
    assert got.agg(F.count("v"), F.max(F.abs(d - far))).first() == (n * n, 0.0)
    assert time.time() - began < 120


def test_fill_by_key_and_without_sources(spark):
    rows = [("a", 0, 0, 1.0, True), ("a", 5, 0, None, True), ("a", 6, 0, None, False), ("b", 0, 0, None, True), ("a", 5, 0, None, True)]
    df = spark.createDataFrame(rows, "k string, i int, j int, v double, inside boolean")
    got = sorted((r.k, r.i, r.v or -1) for r in fill.fill_nearest(df, "v", "inside", keys=["k"]).collect())
    assert got == [("a", 0, 1.0), ("a", 5, 1.0), ("a", 5, 1.0), ("a", 6, -1), ("b", 0, -1)]
    assert fill.fill_nearest(df.where("v is null"), "v", "inside").where("v is not null").count() == 0
    assert fill.fill_nearest(df.limit(0), "v", "inside").collect() == []


def test_linear_fill_takes_the_nearest_for_the_rest(spark):
    """Row 2 and column 2 have no value at all: (2, 2) takes the nearest of what
    is there and of what the lines gave."""
    rows = [(i, j, None if 2 in (i, j) else float(10 * i + j), True) for i in range(4) for j in range(4)]
    got = {(r.i, r.j): r.v for r in fill.fill_linear(spark.createDataFrame(rows, "i int, j int, v double, inside boolean"), "v", "inside").collect()}
    assert got[2, 2] == got[2, 1] and all(v is not None for v in got.values())


def test_triples_by_search(spark):
    rng = random.Random(3)
    t = [(rng.randint(-9, 9), rng.randint(-9, 9)) for _ in range(20)]
    b = [(rng.randint(-9, 9), rng.randint(-9, 9)) for _ in range(15)]
    triples = spark.createDataFrame([(*x, 1, 2) for x in dict.fromkeys(t)], "i int, j int, low int, high int")
    got = {(r.i, r.j): (r.break_i, r.break_j, round(r.distance, 9)) for r in labels.nearest_to_triples(triples, spark.createDataFrame(b, "i int, j int")).collect()}
    for i, j in t:
        want = nearest(b, i + 0.5, j + 0.5)
        assert got[i, j] == (*want, round(((want[0] - i - 0.5) ** 2 + (want[1] - j - 0.5) ** 2) ** 0.5, 9))


def test_rows_of_the_grid_share_and_span_batches(spark):
    """Batches of 7 rows, under keys of two columns; one with NaN, which is alike
    to itself. Python is called for batches, not for rows of the grid."""
    rng = random.Random(8)
    keys = [("a", 1.0), ("a", 2.0), ("b", 1.0), ("c", float("nan")), ("none", 0.0)]
    ask = [(k, x, i, j) for k, x in keys for j in range(6) for i in range(13)]
    have = [(k, x, rng.randrange(13), rng.randrange(6)) for k, x in keys[:-1] for _ in range(5)]
    kind = "k string, x double, i int, j int"
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        found = distance.nearest_sources(spark.createDataFrame(ask, kind), spark.createDataFrame(have, kind), ["k", "x"])
        plan = found._jdf.queryExecution().toString()
        got = {(r.k, str(r.x), r.i, r.j): (r.source_j, r.source_i, r.d2) for r in found.collect()}
    finally:
        spark.conf.set(key, was)
    want = {}
    for k, x, i, j in ask:
        if k != "none":
            d2, y, z = min(((i - p) ** 2 + (j - q) ** 2, q, p) for a, b, p, q in have if a == k and str(b) == str(x))
            want[k, str(x), i, j] = (y, z, d2)
    assert got == want and "MapInArrow" in plan and "FlatMapGroups" not in plan
