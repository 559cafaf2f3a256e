"""Distributed selection of percentiles: exact, and bounded whatever the values."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from gridspark.operators import distributions as D


def by_hand(rows, q):
    """rows: (key, value, weight)."""
    out = {}
    for key in {k for k, *_ in rows}:
        own = sorted((v, w) for k, v, w in rows if k == key and v is not None and w is not None and w > 0)
        total, c = sum(w for _, w in own), 0.0
        for v, w in own:
            c += w
            if c >= q * total * (1 - 1e-12):
                out[key] = v
                break
    return out


def outliers(seed):
    """One key with an outlier of 1e12, one of a single value, one with a few."""
    rng = random.Random(seed)
    rows = [("a", rng.random() * (1e-9 if rng.random() < 0.5 else 1.0), rng.choice([1.0, 2.0, 0.5, 0.0, None])) for _ in range(6000)] + [("a", 1e12, 1.0), ("a", -1e12, 1.0)]
    rows += [("b", 4.0, 1.0)] * 50 + [("c", float(rng.randint(-3, 3)), 1.0) for _ in range(40)] + [("c", None, 9.0), ("d", 1.0, 0.0)]
    return rows


@pytest.mark.parametrize("q", [0.0, 0.5, 0.99])
def test_percentile_with_outliers(spark, q):
    rows = outliers(1)
    df = spark.createDataFrame(rows, "k string, v double, w double").repartition(4)
    got = {r.k: r.p for r in D.weighted_percentile(df, ["k"], "v", "w", q, most=50).collect()}
    assert got == by_hand(rows, q)


def test_no_task_orders_more(spark):
    """Of 6,000 values of a key beside an outlier at most 50 are left, in two rounds."""
    df = spark.createDataFrame(outliers(2), "k string, v double, w double").where("w > 0 and v is not null")
    sums = df.groupBy("k", "v").agg(F.sum("w").alias("__w")).withColumn("__need", F.lit(700.0))
    left = D.narrowed(sums, ["k"], "v", 50)
    assert {r.k: r.n <= 50 for r in left.groupBy("k").agg(F.count("*").alias("n")).collect()} == {"a": True, "b": True, "c": True}
    # what is left says how much lies below it
    low = {r.k: (r.least, r.before) for r in left.groupBy("k").agg(F.min("v").alias("least"), F.min("__before").alias("before")).collect()}
    for r in sums.join(spark.createDataFrame([(k, *x) for k, x in low.items()], "k string, least double, before double"), "k").where("v < least").groupBy("k", "before").agg(F.sum("__w").alias("w")).collect():
        assert abs(r.w - r.before) < 1e-6


def test_medians(spark):
    rng = random.Random(3)
    rows = [(k, None if rng.random() < 0.1 else float(rng.randint(0, 40 * len(k)))) for k in ("a", "bb", "ccc") for _ in range(rng.randint(1, 300))] + [("one", 5.0), ("two", 1.0), ("two", 4.0), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    want = {k: statistics.median([v for x, v in rows if x == k and v is not None]) for k in {x for x, v in rows if v is not None}}
    for most in (7, 1000):
        assert {r.k: r.median for r in D.medians(df, ["k"], "v", most=most).collect()} == want


def test_nothing_to_select(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("a", 1.0, 0.0), (None, 2.0, 1.0)], "k string, v double, w double")
    assert D.weighted_percentile(df, ["k"], "v", "w", 0.5).collect() == []
    assert D.weighted_percentile(df.limit(0), ["k"], "v", "w", 0.5).collect() == [] == D.medians(df.limit(0), ["k"], "v").collect()
