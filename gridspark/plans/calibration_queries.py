"""Calibration against targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.operators import align, masks
from gridspark.operators import calibrate as C
from gridspark.operators.distributions import percentiles
from gridspark.plans.registry import query
from gridspark.plans.views import ensemble, sql, table
from gridspark.sources.staging import written

SUMS = ", s AS (SELECT p1, p2 * 0.5::DOUBLE AS o, zone, sum(melt_rate) AS v FROM ensemble GROUP BY 1, 2, 3), t AS (SELECT zone, avg(v) AS target FROM s GROUP BY 1)"
BEST = SUMS + ", b AS (SELECT p1, zone, o AS \"offset\", residual FROM (SELECT p1, zone, o, abs(v - target) AS residual, row_number() OVER (PARTITION BY p1, zone ORDER BY round(abs(v - target), 9), o) AS n FROM s JOIN t USING (zone)) WHERE n = 1)"


def _sums(spark, d):
    return ensemble(spark, d).groupBy("p1", (F.col("p2") * 0.5).alias("o"), "zone").agg(F.sum("melt_rate").alias("v"))


def _optima(spark, d):
    s = _sums(spark, d)
    return C.optimal_offset(s, s.groupBy("zone").agg(F.avg("v").alias("target")), ["p1"], "zone", "o", "v", "target")


@query("a24_optimal_offset", sql("ensemble", BEST + " SELECT p1, zone, \"offset\", round(residual, 5) AS residual FROM b"))
def a24(spark, d):
    return _optima(spark, d).withColumn("residual", F.round("residual", 5))


@query("a25_physical_constraint", sql("ensemble", ", q AS (SELECT p1, coalesce(sum(melt_rate) FILTER (p2 = 1), 0) AS box1, coalesce(sum(melt_rate) FILTER (p2 = 2), 0) AS box2 FROM ensemble GROUP BY 1) SELECT p1, round(box1, 4) AS box1, round(box2, 4) AS box2 FROM q WHERE box1 > 0 AND box1 > box2"))
def a25(spark, d):
    return C.constrained(ensemble(spark, d), ["p1"], "p2", "melt_rate").select("p1", F.round("box1", 4).alias("box1"), F.round("box2", 4).alias("box2"))


@query("a26_sensitivity", sql("ensemble", BEST + ", m AS (SELECT max(o) AS top FROM s), u AS (SELECT p1, zone, \"offset\", \"offset\" + 1 <= top + 1e-9 AS up FROM b, m) SELECT u.p1, u.zone, u.\"offset\", round(CASE WHEN up THEN y.v - x.v ELSE (x.v - y.v) / 0.5 END, 5) AS sensitivity FROM u JOIN s x ON x.p1 = u.p1 AND x.zone = u.zone AND x.o = u.\"offset\" JOIN s y ON y.p1 = u.p1 AND y.zone = u.zone AND y.o = CASE WHEN up THEN u.\"offset\" + 1 ELSE u.\"offset\" - 0.5 END"))
def a26(spark, d):
    out = C.sensitivity(_sums(spark, d), _optima(spark, d).select("p1", "zone", "offset"), ["p1", "zone"], "o", "v")
    return out.withColumn("sensitivity", F.round("sensitivity", 5))


@query("a27_median_normaliser", sql("ensemble", ", q AS (SELECT p1, p2, sum(melt_rate) AS v FROM ensemble GROUP BY 1, 2), m AS (SELECT median(v) AS m FROM q) SELECT p1, p2, round(v / (m + 1e-6), 9) AS v FROM q, m"))
def a27(spark, d):
    q = ensemble(spark, d).groupBy("p1", "p2").agg(F.sum("melt_rate").alias("v"))
    m = percentiles(q, "v", [0.5]).select(F.get("p", F.lit(0)).alias("m"))
    return q.crossJoin(F.broadcast(m)).select("p1", "p2", F.round(F.col("v") / (F.col("m") + 1e-6), 9).alias("v"))  # one row


@query("a28_mean_absolute_error", sql("ensemble", ", o AS (SELECT zone, avg(melt_rate) AS o FROM ensemble GROUP BY 1) SELECT p1, p2, round(avg(abs((melt_rate - o) * (zone + 1))), 5) AS mae, CASE WHEN count(CASE WHEN melt_rate < 1800 THEN 1 END) = count(*) THEN round(avg(abs(melt_rate - o)), 5) END AS strict FROM ensemble JOIN o USING (zone) GROUP BY 1, 2"))
def a28(spark, d):
    e = ensemble(spark, d)
    j = e.join(e.groupBy("zone").agg(F.avg("melt_rate").alias("o")), "zone")
    mae = C.mean_absolute_error(F.col("melt_rate"), F.col("o"), F.col("zone") + 1)
    strict = C.mean_absolute_error(F.when(F.col("melt_rate") < 1800, F.col("melt_rate")), F.col("o"), skipna=False)
    return j.groupBy("p1", "p2").agg(F.round(mae, 5).alias("mae"), F.round(strict, 5).alias("strict"))


DRAWS = """, k AS (SELECT zone, CAST(zone AS VARCHAR) AS key, avg(melt_rate) AS mean, 50.0::DOUBLE AS sigma FROM ensemble GROUP BY 1),
u AS (SELECT k.*, CAST(x AS INT) AS sample,
  (CAST(CAST('0x' || substr(md5('draw:a:' || x || ':' || key), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496 AS ua,
  (CAST(CAST('0x' || substr(md5('draw:b:' || x || ':' || key), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496 AS ub,
  (CAST(CAST('0x' || substr(md5('draw:w:' || x || ':' || key), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496 AS weight FROM k, range(1, 41) t(x)),
dr AS (SELECT sample, key, weight, mean + sigma * (sqrt(-2 * ln(ua)) * cos(ub * 6.283185307179586)) AS drawn FROM u)"""


def _drawn(spark, d, samples=40):
    e = ensemble(spark, d)
    k = e.groupBy("zone").agg(F.avg("melt_rate").alias("mean")).select(F.col("zone").cast("string").alias("key"), "mean", F.lit(50.0).alias("sigma"))
    return C.draws(k, samples, "mean", "sigma")


@query("r1_r2_draws", sql("ensemble", DRAWS + " SELECT sample, key, round(weight, 9) AS weight, round(drawn, 6) AS drawn FROM dr"))
def r1(spark, d):
    return _drawn(spark, d).select("sample", "key", F.round("weight", 9).alias("weight"), F.round("drawn", 6).alias("drawn"))


#: Four terms: totals by zone, totals by bin, warm minus cold by model,
#: totals by region and year (zero is missing).
PREDICTED = """, en AS (SELECT CAST(p1 // 10 AS INT) AS p1, p2, zone, melt_rate FROM ensemble), pr AS (SELECT 1 AS term, '1:' || zone AS key, CASE WHEN zone < 12 THEN 1.0::DOUBLE ELSE 0 END AS fixed, p1, p2, sum(melt_rate) AS x FROM en GROUP BY zone, p1, p2
UNION ALL SELECT 2, '2:' || zone % 10, 1.0::DOUBLE, p1, p2, sum(melt_rate) FROM en GROUP BY zone % 10, p1, p2
UNION ALL SELECT 3, '3:' || zone % 3, NULL, p1, p2, avg(CASE WHEN melt_rate > 950 THEN melt_rate END) - avg(CASE WHEN melt_rate <= 950 THEN melt_rate END) FROM en GROUP BY zone % 3, p1, p2
UNION ALL SELECT 4, '4:' || zone % 2 || ':' || zone // 2, NULL, p1, p2, nullif(sum(CASE WHEN melt_rate > 930 THEN melt_rate ELSE 0 END), 0) FROM en GROUP BY zone, p1, p2)"""
OBJ = PREDICTED + """, k AS (SELECT term, key, max(fixed) AS fixed, avg(x) AS mean FROM pr GROUP BY 1, 2 HAVING avg(x) IS NOT NULL),
u AS (SELECT k.*, CAST(x AS INT) AS sample, (CAST(CAST('0x' || substr(md5('draw:a:' || x || ':' || key), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496 AS ua,
  (CAST(CAST('0x' || substr(md5('draw:b:' || x || ':' || key), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496 AS ub,
  (CAST(CAST('0x' || substr(md5('draw:w:' || x || ':' || key), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496 AS uw FROM k, range(1, 41) t(x)),
e AS (SELECT sample, pr.term, p1, p2, CASE WHEN pr.term >= 3 OR count(x) = count(*) THEN avg(abs((x - (mean + 50.0 * (sqrt(-2 * ln(ua)) * cos(ub * 6.283185307179586)))) * coalesce(u.fixed, uw))) END AS e
  FROM pr JOIN u ON u.term = pr.term AND u.key = pr.key GROUP BY sample, pr.term, p1, p2),
n AS (SELECT sample, p1, p2, (CAST(CAST('0x' || substr(md5('draw:t:' || sample || ':' || term), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496 * e / (median(e) OVER (PARTITION BY sample, term) + 1e-6) AS e FROM e),
o AS (SELECT sample, p1, p2, round(sum(e), 9) AS objective FROM n GROUP BY 1, 2, 3 HAVING count(e) = (SELECT count(DISTINCT term) FROM pr)),
b AS (SELECT sample, p1, p2, objective FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY objective, p1, p2) AS k FROM o) WHERE k = 1)"""


def _members(spark, d) -> DataFrame:
    return ensemble(spark, d).withColumn("p1", F.floor(F.col("p1") / 10).cast("int"))


def _chosen(spark, d, samples=40):
    e = _members(spark, d)
    keys, rate = ["p1", "p2"], F.col("melt_rate")

    def term(number: int, key, x, fixed=None) -> DataFrame:
        key = F.concat_ws(":", F.lit(str(number)), *key)
        rows = e.groupBy(key.alias("key"), F.lit(None).cast("double").alias("fixed") if fixed is None else fixed.alias("fixed"), *keys).agg(x.alias("x"))
        return rows.select(F.lit(number).alias("term"), "key", "fixed", *keys, "x")

    zone = F.col("zone")
    warm, cold = (F.avg(F.when(c, rate)) for c in (rate > 950, rate <= 950))
    pr = term(1, [zone], F.sum("melt_rate"), F.when(zone < 12, 1.0).otherwise(0.0))
    pr = pr.unionByName(term(2, [zone % 10], F.sum("melt_rate"), F.lit(1.0)))
    pr = pr.unionByName(term(3, [zone % 3], warm - cold))
    pr = pr.unionByName(term(4, [zone % 2, F.floor(zone / 2)], masks.zero_is_missing(F.sum(F.when(rate > 930, rate).otherwise(0.0)))))
    pr = written(pr, "objective-terms")
    k = pr.groupBy("term", "key").agg(F.max("fixed").alias("fixed"), F.avg("x").alias("mean"), F.lit(50.0).alias("sigma")).where("mean is not null")
    return C.best_of_samples(pr, k, samples, keys)


@query("r3_objective", sql("ensemble", OBJ + " SELECT sample, p1, p2, round(objective, 6) AS objective FROM b"))
def r3(spark, d):
    return _chosen(spark, d).withColumn("objective", F.round("objective", 6))


@query("a29_argmin_per_sample", sql("ensemble", OBJ + " SELECT p1, p2, count(*) AS n FROM b GROUP BY 1, 2"))
def a29(spark, d):
    return _chosen(spark, d).groupBy("p1", "p2").agg(F.count("*").alias("n"))


@query("a30_parameter_summary", sql("ensemble", OBJ + ", c AS (SELECT p1, row_number() OVER (ORDER BY count(*) DESC, p1) AS k FROM b GROUP BY 1) SELECT round(quantile_cont(p1, 0.05), 9) AS p5, round(quantile_cont(p1, 0.5), 9) AS p50, round(quantile_cont(p1, 0.95), 9) AS p95, (SELECT p1 FROM c WHERE k = 1) AS mode FROM b"))
def a30(spark, d):
    s = C.summary(_chosen(spark, d), "p1")
    return s.select(*[F.round(c, 9).alias(c) for c in ("p5", "p50", "p95")], "mode")


@query("a30_edge_histogram", sql("ensemble", OBJ + ", a AS (SELECT DISTINCT p1 FROM en), g AS (SELECT coalesce(lag(p1) OVER (ORDER BY p1) + 1e-7, p1 * 0.5::DOUBLE) AS low, p1 + 1e-7 AS high FROM a) SELECT round(low, 9) AS low, round(high, 9) AS high, count(p1) AS n FROM g LEFT JOIN b ON p1 >= low AND p1 < high GROUP BY 1, 2"))
def a30_edges(spark, d):
    out = C.edge_histogram(_chosen(spark, d), _members(spark, d).select("p1").distinct(), "p1")
    return out.select(F.round("low", 9).alias("low"), F.round("high", 9).alias("high"), "n")


@query("a30_slice_percentile", sql("ensemble", ", c AS (SELECT p1, p2, count(*) AS n FROM ensemble GROUP BY 1, 2), w AS (SELECT *, sum(n) OVER (PARTITION BY p1 ORDER BY p2) AS u, sum(n) OVER (PARTITION BY p1) AS t FROM c) SELECT p1, min(p2) AS p2 FROM w WHERE u >= t * 0.5::DOUBLE GROUP BY 1"))
def a30_slice(spark, d):
    return C.slice_percentile(ensemble(spark, d), "p1", "p2", 0.5)


@query("a31_incomplete_members", sql("ensemble", ", p AS (SELECT p1, zone, sum(melt_rate) AS v FROM ensemble GROUP BY 1, 2), g AS (SELECT a.p1, b.zone, v FROM (SELECT DISTINCT p1 FROM p) a CROSS JOIN (SELECT DISTINCT zone FROM p) b LEFT JOIN p ON p.p1 = a.p1 AND p.zone = b.zone) SELECT p1, bool_or(v IS NULL) AS invalid FROM g GROUP BY 1"))
def a31(spark, d):
    p = ensemble(spark, d).groupBy("p1", "zone").agg(F.sum("melt_rate").alias("v"))
    zones = spark.range(16).select(F.col("id").cast("int").alias("zone"))
    grid = p.select("p1").distinct().crossJoin(F.broadcast(zones))  # 16 zones by construction
    return C.incomplete_members(grid.join(p, ["p1", "zone"], "left"), ["p1"], "v")


@query("r4_member_weights", sql("ensemble", "SELECT zone, round(median(melt_rate) / (SELECT median(melt_rate) FROM ensemble), 9) AS weight FROM ensemble GROUP BY 1"))
def r4(spark, d):
    return C.member_weights(ensemble(spark, d), "zone", "melt_rate").withColumn("weight", F.round("weight", 9))


@query("r4_region_weights", sql("ensemble", "SELECT zone, max(CASE WHEN zone IN (9, 14) THEN 1.0::DOUBLE ELSE 0 END) AS weight FROM ensemble GROUP BY 1"))
def r4_regions(spark, d):
    return C.region_weights(ensemble(spark, d), ["zone"], F.col("zone").isin(9, 14))


@query("r5_parameter_sweep", sql("ensemble", "SELECT zone, round(k * 0.25e-5, 9) AS k, round(sum((k * 0.25e-5) * (melt_rate / 1000 - 1) * abs(melt_rate / 1000 - 1)), 12) AS melt FROM ensemble, (SELECT 1 + x AS k FROM range(0, 120) t(x)) GROUP BY zone, k"))
def r5(spark, d):
    """Melt is linear in k: the sums are taken once, then multiplied."""
    one = ensemble(spark, d).groupBy("zone").agg(F.sum(C.quadratic_melt(F.lit(1.0), F.col("melt_rate") / 1000 - 1)).alias("melt"))
    e = C.sweep(one, "k", 0.25e-5, 0.25e-5, 120)
    return e.select("zone", F.round("k", 9).alias("k"), F.round(F.col("k") * F.col("melt"), 12).alias("melt"))


@query("r5_offset_sweep", sql("ensemble", "SELECT zone, round(-2 + 0.04::DOUBLE * x, 9) AS \"offset\", round(sum(1e-4::DOUBLE * (melt_rate / 1000 - 1 + (-2 + 0.04::DOUBLE * x)) * abs(melt_rate / 1000 - 1 + (-2 + 0.04::DOUBLE * x))), 9) AS melt FROM ensemble, range(0, 101) t(x) GROUP BY zone, x"))
def r5_offsets(spark, d):
    """101 temperature offsets, summed within tasks before the shuffle."""
    e = C.sweep(ensemble(spark, d), "offset", -2.0, 0.04, 101)
    melt = C.quadratic_melt(F.lit(1e-4), F.col("melt_rate") / 1000 - 1 + F.col("offset"))
    return e.groupBy("zone", F.round("offset", 9).alias("offset")).agg(F.round(F.sum(melt), 9).alias("melt"))


@query("f5_quadratic_melt", sql("ensemble", "SELECT p1, p2, zone, melt_rate, 2.5e-5::DOUBLE * 1.5 * (melt_rate / 1000 - 1) * abs(melt_rate / 1000 - 1) AS melt FROM ensemble"))
def f5(spark, d):
    e = ensemble(spark, d)
    return e.withColumn("melt", C.quadratic_melt(F.lit(2.5e-5), F.col("melt_rate") / 1000 - 1, 1.5))


@query("j15_pick_optimum", sql("ensemble", BEST + " SELECT s.p1, s.zone, s.o AS \"offset\", round(s.v, 4) AS v FROM s JOIN b ON s.p1 = b.p1 AND s.zone = b.zone AND s.o = b.\"offset\""))
def j15(spark, d):
    s = _sums(spark, d).withColumnRenamed("o", "offset")
    return align.pick(s, _optima(spark, d).select("p1", "zone", "offset"), ["p1", "zone", "offset"]).select("p1", "zone", "offset", F.round("v", 4).alias("v"))


@query("s10_members_by_hash", "SELECT p_size AS p1, count(*) AS n, round(sum(p_retailprice), 4) AS total FROM part GROUP BY 1")
def s10(spark, d):
    """Results keyed by a member's hash, joined to the member table."""
    p = table(spark, d, "part")
    members = p.select(F.md5(F.col("p_size").cast("string")).alias("id"), F.col("p_size").alias("p1")).distinct()
    results = p.select(F.md5(F.col("p_size").cast("string")).alias("id"), F.col("p_retailprice").alias("melt_rate"))
    return results.join(members, "id").groupBy("p1").agg(F.count("*").alias("n"), F.round(F.sum("melt_rate"), 4).alias("total"))


@query("t3_argmax", sql("ensemble", "SELECT zone, p1, p2 FROM (SELECT *, row_number() OVER (PARTITION BY zone ORDER BY melt_rate DESC, p1, p2) AS n FROM ensemble) WHERE n = 1"))
def t3(spark, d):
    best = ensemble(spark, d).groupBy("zone").agg(F.min(F.struct((-F.col("melt_rate")).alias("m"), "p1", "p2")).alias("s"))
    return best.select("zone", "s.p1", "s.p2")
