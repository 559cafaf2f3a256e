"""The packed objective against the long one and against a version by hand."""

import random
import statistics

from pyspark.sql import functions as F

from gridspark.operators import calibrate as C


def tables(spark, seed, n_keys=4, n_params=6):
    rng = random.Random(seed)
    predicted, keys = [], []
    for term in (1, 2, 3):
        for k in range(n_keys):
            keys.append((term, f"{term}:{k}", rng.uniform(-2, 2), rng.uniform(0, 1), rng.choice([None, 0.0, 1.0])))
            for p in range(n_params):
                if not (term == 3 and p == 5) and rng.random() < 0.95:  # a parameter that lacks a term, rows that lack
                    predicted.append((term, f"{term}:{k}", p, p % 2, None if rng.random() < 0.06 else rng.uniform(-3, 3)))
    predicted.append((3, "no such key", 0, 0, 1.0))
    return (
        spark.createDataFrame(predicted, "term int, key string, p1 int, p2 int, x double"),
        spark.createDataFrame(keys, "term int, key string, mean double, sigma double, fixed double"),
    )


def long_form(predicted, keys, samples):
    drawn = C.draws(keys, samples, "mean", "sigma").withColumn("weight", F.coalesce("fixed", "weight"))
    return C.objective(predicted, drawn, ["p1", "p2"])


def test_packed_is_the_long_objective(spark):
    for seed in range(3):
        predicted, keys = tables(spark, seed)
        want = {(r.sample, r.p1, r.p2): r.objective for r in long_form(predicted, keys, 7).collect()}
        rows = C.objectives_in_rows(C.matrices(predicted, keys, ["p1", "p2"]), 7)
        got = {(r["sample"], *p): o for r in rows.collect() for p, o in zip(r.ps, r.objectives) if o is not None}
        assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)
        assert not any(k[1] == 5 for k in got)
        for most in (10**6, 3):  # packed, and the long way
            best = {r["sample"]: (r.p1, r.p2, r.objective) for r in C.best_of_samples(predicted, keys, 7, ["p1", "p2"], most=most).collect()}
            for s in {k[0] for k in want}:
                assert best[s] == min((round(o, 9), p1, p2) for (t, p1, p2), o in want.items() if t == s)[1:] + best[s][2:]


def test_packed_by_hand(spark):
    """One strict term of two keys and one that skips, weights and draws given."""
    predicted = spark.createDataFrame([(1, "a", 0, 1.0), (1, "b", 0, 3.0), (1, "a", 1, 2.0), (1, "b", 1, None), (1, "a", 2, 5.0), (1, "b", 2, 5.0), (3, "c", 0, None), (3, "d", 0, 2.0), (3, "c", 2, 4.0), (3, "d", 2, 4.0)], "term int, key string, p int, x double")
    keys = spark.createDataFrame([(1, "a", 0.0, 0.0, 1.0), (1, "b", 1.0, 0.0, 1.0), (3, "c", 0.0, 0.0, 1.0), (3, "d", 0.0, 0.0, 1.0)], "term int, key string, mean double, sigma double, fixed double")
    rows = C.objectives_in_rows(C.matrices(predicted, keys, ["p"]), 3).collect()
    share = {(r["sample"], r["term"]): r["u"] for r in spark.range(1, 4).withColumnRenamed("id", "sample").crossJoin(spark.createDataFrame([("1",), ("3",)], "key string")).select("sample", F.col("key").cast("int").alias("term"), C.uniform("draw", "t").alias("u")).collect()}
    e = {1: {0: 1.5, 2: 4.5}, 3: {0: 2.0, 2: 4.0}}
    for r in rows:
        want = {p: sum(share[r["sample"], t] * e[t][p] / (statistics.median(e[t].values()) + 1e-6) for t in e) for p in (0, 2)}
        got = dict(zip([p["p"] for p in r.ps], r.objectives))
        assert got[1] is None and all(abs(got[p] - want[p]) < 1e-12 for p in want)


def test_many_samples_shuffle_nothing(spark):
    """120 parameters; each sample is one row that meets one packed row."""
    predicted = spark.range(120).select(F.lit(1).alias("term"), F.explode(F.array(*map(F.lit, "abcd"))).alias("key"), F.col("id").alias("p")).withColumn("x", F.sin(F.col("p") * 0.1 + F.ascii("key")))
    keys = predicted.groupBy("term", "key").agg(F.avg("x").alias("mean"), F.lit(0.3).alias("sigma"), F.lit(None).cast("double").alias("fixed"))
    best = C.best_of_samples(predicted, keys, 5_000, ["p"])
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Sort" not in plan
    assert best.count() == 5_000


def test_no_predictions(spark):
    predicted, keys = tables(spark, 1)
    assert C.best_of_samples(predicted.limit(0), keys, 3, ["p1", "p2"]).collect() == []


def test_a_term_without_keys_voids_all(spark):
    predicted, keys = tables(spark, 1)
    more = predicted.unionByName(spark.createDataFrame([(7, "7:0", 0, 0, None)], predicted.schema))
    assert long_form(more, keys, 2).count() == 0
    assert C.best_of_samples(more, keys, 2, ["p1", "p2"]).count() == 0
