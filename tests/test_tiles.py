"""Regridding by tiles against the joined form, and what it exchanges."""

import random

import pytest
from pyspark.sql import functions as F

from gridspark.operators import regrid, tiles


def field(spark, seed, n=400):
    rng = random.Random(seed)
    cells = [(i, j) for i in range(-3, 12) for j in range(-4, 9)]
    rows = [(*rng.choice(cells), rng.randint(0, 5) * 50, rng.randint(1, 3), None if rng.random() < 0.2 else rng.uniform(-1, 1)) for _ in range(n)]
    weights = [(*rng.choice(cells), rng.randint(0, 6), rng.uniform(0, 1)) for _ in range(300)] + [(99, 99, 1, 1.0)]
    return spark.createDataFrame(rows, "i int, j int, t int, k int, v double"), spark.createDataFrame(weights, "i int, j int, d int, w double")


@pytest.mark.parametrize("size", [1, 4, 32])
@pytest.mark.parametrize("renormalize", [None, 0.4])
def test_tiles_are_the_join(spark, size, renormalize):
    df, weights = field(spark, size)
    cells = tiles.packed(tiles.by_tile(df, size=size), ["t", "k"], ["v"], "t", chunk=100)
    got = tiles.apply_blocks(cells, tiles.weight_blocks(weights, ["d"], size), ["d"], ["t", "k"], "v", renormalize, size=size)
    want = regrid.apply_weights(df, weights, ["i", "j"], ["d"], "v", ["t", "k"], renormalize)
    near = lambda d: {(r.t, r.k, r.d): None if r.v is None else round(r.v, 9) for r in d.collect()}
    assert near(got) == near(want) and len(near(got)) == got.count()


def test_places_are_one_each():
    seen = {((j // 4) * (1 << 31) + i // 4, (j % 4) * 4 + i % 4) for i in range(-9, 9) for j in range(-9, 9)}
    assert len(seen) == 18 * 18


def test_constants_stay(spark):
    """Weights that add up to 1 keep a constant field."""
    df = spark.range(900).select((F.col("id") % 30).cast("int").alias("i"), F.floor(F.col("id") / 30).cast("int").alias("j"), F.lit(1).alias("t"), F.lit(7.5).alias("v"))
    w = df.select("i", "j", F.floor(F.col("i") / 3).alias("a"), F.floor(F.col("j") / 3).alias("b"), F.lit(1 / 9).alias("w"))
    out = tiles.apply_blocks(tiles.packed(tiles.by_tile(df), ["t"], ["v"]), tiles.weight_blocks(w, ["a", "b"]), ["a", "b"], ["t"], "v")
    assert {round(r.v, 9) for r in out.collect()} == {7.5} and out.count() == 100


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.strip() for line in plan.splitlines() if "Exchange" in line]


def test_the_field_is_not_exchanged(spark):
    df, weights = field(spark, 3)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        lies = tiles.by_tile(df)
        cells = tiles.packed(lies, ["t", "k"], ["v"], "t")
        assert exchanges(cells) == []
        out = exchanges(tiles.apply_blocks(cells, tiles.weight_blocks(weights, ["d"]), ["d"], ["t", "k"], "v"))
        assert len(out) == 1 and "tile" not in out[0]  # of sums by destination
        again = lies.groupBy("tile", "i", "j", "k").agg(F.max("v"))
        assert exchanges(again) == []
    finally:
        spark.conf.set(key, before)


def test_empty_field(spark):
    df, weights = field(spark, 4)
    cells = tiles.packed(tiles.by_tile(df.limit(0)), ["t", "k"], ["v"], "t")
    assert tiles.apply_blocks(cells, tiles.weight_blocks(weights, ["d"]), ["d"], ["t", "k"], "v").collect() == []
