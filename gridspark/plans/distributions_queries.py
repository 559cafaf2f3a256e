"""Percentiles, histograms, state-space deltas, gap fills."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridspark.operators import distributions as D
from gridspark.operators import fill
from gridspark.plans.registry import query
from gridspark.plans.views import cells, sql, states, table

EDGES = [-1000.0, 0.0, 2000.0, 4000.0, 6000.0, 8000.0, 10000.0]
WITH_W = ", c AS (SELECT zone, v, (i + 1)::DOUBLE AS w FROM cells)"


def _weighted(spark, d):
    return cells(spark, d).select("zone", "v", (F.col("i") + 1).cast("double").alias("w"), "v_holes")


def _p(name, src, val, q):
    return f"{name} AS (SELECT zone, min({val}) AS p FROM (SELECT zone, {val}, sum(w) OVER (PARTITION BY zone ORDER BY {val}) AS c, sum(w) OVER (PARTITION BY zone) AS t FROM (SELECT zone, {val}, sum(w) AS w FROM {src} WHERE {val} IS NOT NULL GROUP BY 1, 2)) WHERE c >= t * {q}::DOUBLE GROUP BY 1)"


@query("a16_weighted_percentile", sql("cells", WITH_W + ", " + _p("r", "c", "v", 0.99) + " SELECT zone, p FROM r"))
def a16(spark, d):
    return D.weighted_percentile(_weighted(spark, d), ["zone"], "v", "w", 0.99)


@query("a17_weighted_histogram", sql("cells", WITH_W + " SELECT zone, CAST(CASE WHEN v < 0 THEN 0 WHEN v = 10000 THEN 5 ELSE 1 + floor(v / 2000) END AS INT) AS bin, sum(w) AS weight FROM c WHERE v BETWEEN -1000 AND 10000 GROUP BY 1, 2"))
def a17(spark, d):
    return D.weighted_histogram(_weighted(spark, d), ["zone"], "v", "w", EDGES)


RANGE = ", r AS (SELECT zone, min(s) AS s_lo, max(s) AS s_hi, min(t) AS t_lo, max(t) AS t_hi FROM states GROUP BY 1)"
BIN = "CAST(least(4, floor(5 * CASE WHEN {v}_hi > {v}_lo THEN ({v} - {v}_lo) / ({v}_hi - {v}_lo) ELSE 0 END)) AS INT) AS {v}_bin"
LOOK = "CAST(least(4, greatest(0, trunc(4 * CASE WHEN {v}_hi > {v}_lo THEN ({v} - {v}_lo) / ({v}_hi - {v}_lo) ELSE 0 END))) AS INT) AS {v}_bin"
BINNED = RANGE + f", b AS (SELECT *, {BIN.format(v='s')}, {BIN.format(v='t')} FROM states JOIN r USING (zone))"
DELTA = BINNED + ", dl AS (SELECT zone, s_bin, t_bin, CASE WHEN count(*) = count(delta) THEN sum(volume * delta) / nullif(sum(volume), 0) END AS delta FROM b GROUP BY 1, 2, 3)"


@query("a18_histogram_2d", sql("states", BINNED + " SELECT zone, s_bin, t_bin, sum(volume) AS weight FROM b GROUP BY 1, 2, 3"))
def a18(spark, d):
    return D.histogram_2d(states(spark, d), "zone", "s", "t", "volume", 5)


@query("a18_histogram_edges", sql("states", RANGE + " SELECT zone, CAST(k AS INT) AS k, round(s_lo + (s_hi - s_lo) * k / 5, 9) AS s_edge, round(t_lo + (t_hi - t_lo) * k / 5, 9) AS t_edge FROM r, range(0, 6) q(k)"))
def a18_edges(spark, d):
    out = D.histogram_edges(states(spark, d), "zone", "s", "t", 5)
    return out.select("zone", "k", F.round("s_edge", 9).alias("s_edge"), F.round("t_edge", 9).alias("t_edge"))


@query("a19_state_delta", sql("states", DELTA + " SELECT zone, s_bin, t_bin, round(delta, 6) AS delta FROM dl"))
def a19(spark, d):
    return D.state_delta(states(spark, d), "zone", "s", "t", "volume", "delta", 5).withColumn("delta", F.round("delta", 6))


@query("b3_apply_delta", sql("states", DELTA + f", q AS (SELECT i, j, zone, t, {LOOK.format(v='s')}, {LOOK.format(v='t')} FROM states JOIN r USING (zone)) SELECT i, j, round(t + delta, 6) AS changed FROM q LEFT JOIN dl USING (zone, s_bin, t_bin)"))
def b3(spark, d):
    s = states(spark, d)
    deltas = D.state_delta(s, "zone", "s", "t", "volume", "delta", 5)
    out = D.apply_delta(s.select("i", "j", "zone", "s", "t"), deltas, "zone", "s", "t", 5)
    return out.select("i", "j", F.round("changed", 6).alias("changed"))


SCALE = ", m AS (SELECT zone, v, w FROM c), g0 AS (SELECT zone, v_holes AS v, w FROM (SELECT zone, v_holes, (i + 1)::DOUBLE AS w FROM cells) WHERE v_holes IS NOT NULL), " + _p("pm", "m", "v", 0.99) + ", " + _p("pr", "g0", "v", 0.99)
HIST = "CAST(CASE WHEN x < 0 THEN 0 WHEN x = 10000 THEN 5 ELSE 1 + floor(x / 2000) END AS INT)"


@query("a21_salinity_scale", sql("cells", WITH_W + SCALE + f""", sc AS (SELECT k / 10.0::DOUBLE AS scale FROM range(5, 15) t(k)),
t AS (SELECT m.zone, scale, scale * (v - pm.p) + pr.p AS x, w FROM m JOIN pm USING (zone) JOIN pr ON pr.zone = m.zone, sc),
h AS (SELECT zone, scale, {HIST} AS bin, sum(w) AS w FROM t WHERE x BETWEEN -1000 AND 10000 GROUP BY 1, 2, 3),
hs AS (SELECT zone, scale, bin, w / sum(w) OVER (PARTITION BY zone, scale) AS h FROM h),
g AS (SELECT zone, {HIST} AS bin, sum(w) AS w FROM (SELECT zone, v AS x, w FROM g0) WHERE x BETWEEN -1000 AND 10000 GROUP BY 1, 2),
gs AS (SELECT zone, bin, w / sum(w) OVER (PARTITION BY zone) AS g FROM g),
dist AS (SELECT pm.zone, sc.scale, round(sqrt(sum(pow(coalesce(h, 0) - coalesce(g, 0), 2))), 9) AS distance FROM pm JOIN pr USING (zone), sc, range(0, 6) b(bin)
  LEFT JOIN hs ON hs.zone = pm.zone AND hs.scale = sc.scale AND hs.bin = b.bin LEFT JOIN gs ON gs.zone = pm.zone AND gs.bin = b.bin GROUP BY 1, 2)
SELECT zone, scale, round(distance, 6) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY zone ORDER BY distance, scale) AS n FROM dist) WHERE n = 1"""))
def a21(spark, d):
    c = _weighted(spark, d)
    ref = c.where("v_holes is not null").select("zone", F.col("v_holes").alias("v"), "w")
    return D.salinity_scale(c.select("zone", "v", "w"), ref, "zone", "v", "w", EDGES).select("zone", "scale", F.round("distance", 6).alias("distance"))


@query("a22_temperature_scale", sql("cells", WITH_W + SCALE + ", lo AS (SELECT zone, min(v) AS m FROM m GROUP BY 1), lr AS (SELECT zone, min(v) AS r FROM g0 GROUP BY 1) SELECT zone, round((pr.p - lr.r) / nullif(pm.p - lo.m, 0), 9) AS scale FROM pm JOIN pr USING (zone) JOIN lo USING (zone) JOIN lr USING (zone)"))
def a22(spark, d):
    c = _weighted(spark, d)
    ref = c.where("v_holes is not null").select("zone", F.col("v_holes").alias("v"), "w")
    return D.temperature_scale(c, ref, "zone", "v", "w").select("zone", F.round("scale", 9).alias("scale"))




@query("a23_quantile_bins", f"WITH e AS (SELECT quantile_cont(p_retailprice, [{', '.join(repr(k / 9) for k in range(1, 9))}]) AS e FROM part WHERE p_retailprice > 0), b AS (SELECT p_retailprice AS v, 1 + (SELECT count(*) FROM (SELECT unnest(e) AS x) WHERE x < p_retailprice) AS bin FROM part, e WHERE p_retailprice > 0) SELECT CAST(bin AS INT) AS bin, count(*) AS n, round(median(v), 6) AS median FROM b GROUP BY 1")
def a23(spark, d):
    p = D.quantile_bins(table(spark, d, "part").select(F.col("p_retailprice").alias("v")), "v", 9)
    n = p.groupBy("bin").agg(F.count("*").alias("n"))
    return n.join(D.medians(p, ["bin"], "v"), "bin").select("bin", "n", F.round("median", 6).alias("median"))


#: Rounds of means over the filled bins among the eight neighbours.
FILLED = DELTA + """,
ff(n, zone, s_bin, t_bin, delta) AS (SELECT 0, * FROM (SELECT z.zone, CAST(a AS INT), CAST(b AS INT), dl.delta FROM (SELECT DISTINCT zone FROM dl) z CROSS JOIN range(0, 5) s(a) CROSS JOIN range(0, 5) t(b) LEFT JOIN dl ON dl.zone = z.zone AND dl.s_bin = a AND dl.t_bin = b)
  UNION ALL SELECT x.n + 1, x.zone, x.s_bin, x.t_bin, coalesce(max(x.delta), avg(y.delta)) FROM ff x LEFT JOIN ff y ON x.delta IS NULL AND y.zone = x.zone AND abs(x.s_bin - y.s_bin) <= 1 AND abs(x.t_bin - y.t_bin) <= 1 WHERE x.n < 6 GROUP BY 1, 2, 3, 4)"""


@query("i10_fill_bins", sql("states", FILLED + " SELECT zone, s_bin, t_bin, round(delta, 6) AS delta FROM ff WHERE n = 6"))
def i10(spark, d):
    deltas = D.state_delta(states(spark, d), "zone", "s", "t", "volume", "delta", 5)
    return fill.fill_bins(deltas, "zone", "s_bin", "t_bin", "delta", 5).withColumn("delta", F.round("delta", 6))


@query("b2_state_space_correction")
def b2(spark, d):
    """By zone and year: deltas of the reference states, filled, applied to every
    cell on the bins of a model whose state space is off, corrected for that."""
    s = states(spark, d).withColumn("zone", F.col("zone").cast("string"))
    reference = s.select("i", "j", "zone", "s", "t", "volume")
    model = reference.withColumns({"s": 0.8 * F.col("s") + 3, "t": 1.2 * F.col("t") - 1})
    bounds = D.corrected_bounds(model, reference, "zone", "s", "t", "volume", [5.0 * k for k in range(9)])
    years = F.explode(F.sequence(F.lit(2000), F.lit(2002)))
    by_year = s.withColumn("year", years).withColumn("delta", F.col("delta") * (F.col("year") - 1999)).withColumn("key", F.concat_ws(":", "zone", "year"))
    deltas = fill.fill_bins(D.state_delta(by_year, "key", "s", "t", "volume", "delta", 5), "key", "s_bin", "t_bin", "delta", 5)
    bounds = bounds.withColumn("year", years).select(F.concat_ws(":", "zone", "year").alias("key"), "s_lo", "s_hi", "t_lo", "t_hi")
    return D.apply_delta(by_year.select("i", "j", "year", "key", "s", "t"), deltas, "key", "s", "t", 5, bounds=bounds).select("i", "j", "year", "changed")


ROUNDS = {"zone_rounds": (fill.FIRST_ROUNDS, fill.SECOND_ROUNDS), "level": "k", "level_rounds": fill.LAST_ROUNDS}


def _slabs(spark, d):
    c = cells(spark, d)
    time = F.floor(F.col("j") / 40).cast("int").alias("time")
    return c.select(F.lit("ct").alias("variable"), time, (F.col("nation") % 2 + 1).cast("int").alias("k"), (F.col("j") % 40).alias("j"), "i", "zone", F.col("v_holes").alias("value"), (F.col("v_holes") / 10).alias("spread"), (F.col("ice_frac") < 0.5).alias("inside"), (F.col("v") > 0).alias("open"))


@query("i1_horizontal_fill")
def i1(spark, d):
    """Slabs by time and level, with the rounds that zones and levels call for."""
    return fill.fill_horizontal(_slabs(spark, d), ["variable", "time", "k"], ["value"], **ROUNDS)


@query("i2_horizontal_fill_with_spread")
def i2(spark, d):
    return fill.fill_horizontal(_slabs(spark, d), ["variable", "time", "k"], ["value", "spread"], missing_above=9500.0, **ROUNDS)


@query("i11_nearest_fill", sql("cells", ", h AS (SELECT i, j, v_holes AS x FROM cells WHERE v_holes IS NOT NULL), r AS (SELECT c.i, c.j, h.x, row_number() OVER (PARTITION BY c.i, c.j ORDER BY pow(c.i - h.i, 2) + pow(c.j - h.j, 2), h.j, h.i) AS n FROM cells c, h WHERE c.v_holes IS NULL AND c.ice_frac < 0.5) SELECT c.i, c.j, coalesce(c.v_holes, r.x) AS v FROM cells c LEFT JOIN r ON r.i = c.i AND r.j = c.j AND r.n = 1"))
def i11(spark, d):
    c = cells(spark, d).select("i", "j", F.col("v_holes").alias("v"), (F.col("ice_frac") < 0.5).alias("inside"))
    return fill.fill_nearest(c, "v", "inside").select("i", "j", "v")


@query("i12_linear_fill", sql("cells", """, w AS (SELECT *, last_value(CASE WHEN v_holes IS NOT NULL THEN {'v': v_holes, 'a': i} END IGNORE NULLS) OVER (PARTITION BY j ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l,
  last_value(CASE WHEN v_holes IS NOT NULL THEN {'v': v_holes, 'a': i} END IGNORE NULLS) OVER (PARTITION BY j ORDER BY i DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r,
  last_value(CASE WHEN v_holes IS NOT NULL THEN {'v': v_holes, 'a': j} END IGNORE NULLS) OVER (PARTITION BY i ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS u,
  last_value(CASE WHEN v_holes IS NOT NULL THEN {'v': v_holes, 'a': j} END IGNORE NULLS) OVER (PARTITION BY i ORDER BY j DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS o FROM cells),
x AS (SELECT i, j, v_holes, ice_frac, coalesce(l.v / abs(i - l.a), 0) + coalesce(r.v / abs(i - r.a), 0) + coalesce(u.v / abs(j - u.a), 0) + coalesce(o.v / abs(j - o.a), 0) AS num,
  coalesce(1.0::DOUBLE / abs(i - l.a), 0) + coalesce(1.0::DOUBLE / abs(i - r.a), 0) + coalesce(1.0::DOUBLE / abs(j - u.a), 0) + coalesce(1.0::DOUBLE / abs(j - o.a), 0) AS den FROM w),
f AS (SELECT i, j, ice_frac, CASE WHEN v_holes IS NULL AND ice_frac < 0.5 AND den > 0 THEN num / den ELSE v_holes END AS v FROM x),
r AS (SELECT a.i, a.j, b.v, row_number() OVER (PARTITION BY a.i, a.j ORDER BY pow(a.i - b.i, 2) + pow(a.j - b.j, 2), b.j, b.i) AS n FROM f a, f b WHERE a.v IS NULL AND a.ice_frac < 0.5 AND b.v IS NOT NULL)
SELECT f.i, f.j, round(coalesce(f.v, r.v), 4) AS v FROM f LEFT JOIN r ON r.i = f.i AND r.j = f.j AND r.n = 1"""))
def i12(spark, d):
    c = cells(spark, d).select("i", "j", F.col("v_holes").alias("v"), (F.col("ice_frac") < 0.5).alias("inside"))
    return fill.fill_linear(c, "v", "inside").select("i", "j", F.round("v", 4).alias("v"))
