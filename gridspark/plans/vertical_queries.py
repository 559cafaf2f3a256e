"""Along the level axis: fills, interpolation, resampling, lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridspark.operators import vertical as V
from gridspark.plans.registry import query
from gridspark.plans.views import profiles, sql, table

SOURCE = [-10.0 * k for k in range(1, 8)]
TARGET = [-15.0 * k for k in range(1, 5)]
BOUNDS = [(z - 5, z + 5) for z in SOURCE]
COARSE = [(-25.0, -5.0), (-55.0, -25.0), (-75.0, -55.0)]


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"{x!r}::DOUBLE" if isinstance(x, float) else str(x) for x in r) + ")" for r in rows)


INTERP = V.interpolation_weights(SOURCE, TARGET)
OVERLAP = V.overlap_weights(BOUNDS, COARSE)
W_SQL = f"w(dst, src, w) AS (VALUES {_values(INTERP)})"
O_SQL = f"w(dst, src, w) AS (VALUES {_values(OVERLAP)}), dz(dst, dz) AS (VALUES {_values([(k, b - a) for k, (a, b) in enumerate(COARSE, 1)])})"


@query("w1_fill_down", sql("profiles", ", f AS (SELECT *, CASE WHEN row_number() OVER o = 1 THEN coalesce(v, lead(v) OVER o) ELSE v END AS x FROM profiles WINDOW o AS (PARTITION BY cell ORDER BY k)) SELECT cell, k, last_value(x IGNORE NULLS) OVER (PARTITION BY cell ORDER BY k) AS v FROM f"))
def w1(spark, d):
    return V.fill_down(profiles(spark, d), ["cell"], "k", ["v"]).select("cell", "k", "v")


@query("w2_fill_down_from_third", sql("profiles", ", n AS (SELECT *, v * 2 AS s, row_number() OVER (PARTITION BY cell ORDER BY k) AS r FROM profiles), f AS (SELECT *, CASE WHEN r >= 3 THEN last_value(v IGNORE NULLS) OVER (PARTITION BY cell ORDER BY k) ELSE v END AS x, CASE WHEN r >= 3 THEN last_value(s IGNORE NULLS) OVER (PARTITION BY cell ORDER BY k) ELSE s END AS y FROM n) SELECT cell, k, x AS v, y AS s FROM f"))
def w2(spark, d):
    p = profiles(spark, d).withColumn("s", F.col("v") * 2)
    return V.fill_down(p, ["cell"], "k", ["v", "s"], first_from_second=False, start=3).select("cell", "k", "v", "s")


@query("w3_fill_both_ways", sql("profiles", "SELECT cell, k, coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY cell ORDER BY k), first_value(v IGNORE NULLS) OVER (PARTITION BY cell ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS v FROM profiles"))
def w3(spark, d):
    return V.fill_both(profiles(spark, d), ["cell"], "k", "v").select("cell", "k", "v")


@query("w4_interpolate_levels", sql("profiles", f", {W_SQL}, n AS (SELECT *, count(*) OVER (PARTITION BY dst) AS n FROM w WHERE w <> 0) SELECT cell, dst AS k, CASE WHEN count(v) = max(n) THEN round(sum(v * w), 6) END AS v FROM profiles JOIN n ON k = src GROUP BY 1, 2"))
def w4(spark, d):
    w = V.weights_table(spark, INTERP)
    return V.interpolate(profiles(spark, d), w, ["cell"], "k", "v").withColumn("v", F.round("v", 6))


@query("w5_interpolate_valid", sql("profiles", f", {W_SQL}, s AS (SELECT cell, dst AS k, sum(coalesce(v, 0) * w) AS x, sum(CASE WHEN v IS NOT NULL THEN w ELSE 0 END) AS f FROM profiles JOIN w ON k = src GROUP BY 1, 2) SELECT cell, k, CASE WHEN f > 0.001 THEN round(x / f, 6) END AS v FROM s"))
def w5(spark, d):
    w = V.weights_table(spark, INTERP)
    return V.interpolate_valid(profiles(spark, d), w, ["cell"], "k", "v").withColumn("v", F.round("v", 6))


@query("w6_first_time_valid", "SELECT l_suppkey AS cell, arg_min(ok, (l_shipdate, l_orderkey, l_linenumber, l_partkey)) AS valid FROM (SELECT *, l_discount <= 0.07 AND l_tax <= 0.07 AS ok FROM lineitem) GROUP BY 1")
def w6(spark, d):
    rows = table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("cell"), F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey").alias("at"),
        F.when(F.col("l_discount") <= 0.07, 1).alias("a"), F.when(F.col("l_tax") <= 0.07, 1).alias("b"),
    )
    return V.first_time_valid(rows, ["cell"], "at", ["a", "b"])


RESAMPLED = sql("profiles", f", {O_SQL}, s AS (SELECT cell, dst, sum(v * w) AS x, sum(CASE WHEN v IS NOT NULL THEN w END) AS c FROM profiles JOIN w ON k = src GROUP BY 1, 2) SELECT cell, dst AS k, CASE WHEN c / dz > 0.4 THEN round(x / c, 6) END AS v FROM s JOIN dz USING (dst)")


@query("w7_conservative_resample", RESAMPLED)
def w7(spark, d):
    dz = spark.createDataFrame([(k, b - a) for k, (a, b) in enumerate(COARSE, 1)], "k int, dz double")
    out = V.resample(profiles(spark, d), V.weights_table(spark, OVERLAP), ["cell"], "k", "v", dz, 0.4)
    return out.select("cell", "k", F.round("v", 6).alias("v"))


@query("w7_profile_resample", sql("profiles", f", {O_SQL}, c AS (SELECT DISTINCT cell FROM profiles), s AS (SELECT cell, dst, sum(v * w) AS x, coalesce(sum(CASE WHEN v IS NOT NULL THEN w END), 0) AS c FROM profiles JOIN w ON k = src GROUP BY 1, 2) SELECT cell, dst AS k, CASE WHEN coalesce(s.c, 0) / dz > 0.4 THEN round(x / s.c, 6) END AS v FROM c CROSS JOIN dz LEFT JOIN s USING (cell, dst)"))
def w7_profile(spark, d):
    p = V.to_profiles(profiles(spark, d), ["cell"], "k", "v", 7)
    out = p.select("cell", V.profile_resample(F.col("v"), OVERLAP, [b - a for a, b in COARSE], 0.4).alias("v"))
    return out.select("cell", F.posexplode_outer("v").alias("k", "v")).select("cell", (F.col("k") + 1).alias("k"), F.round("v", 6).alias("v"))


@query("w3_profile_fill", sql("profiles", ", g AS (SELECT cell, k::INT AS k FROM (SELECT DISTINCT cell FROM profiles), range(1, 8) r(k)), a AS (SELECT g.cell, g.k, v FROM g LEFT JOIN profiles p ON p.cell = g.cell AND p.k = g.k) SELECT cell, k, coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY cell ORDER BY k), first_value(v IGNORE NULLS) OVER (PARTITION BY cell ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS v FROM a"))
def w3_profile(spark, d):
    p = V.to_profiles(profiles(spark, d), ["cell"], "k", "v", 7)
    out = p.select("cell", V.profile_fill_both(F.col("v")).alias("v"))
    return out.select("cell", F.posexplode_outer("v").alias("k", "v")).select("cell", (F.col("k") + 1).alias("k"), "v")


@query("w8_level_bounds", sql("profiles", ", n AS (SELECT *, lag(z) OVER o AS a, lead(z) OVER o AS b FROM profiles WINDOW o AS (PARTITION BY cell ORDER BY k)) SELECT cell, k, (coalesce(a, 2 * z - b) + z) / 2 AS z_lo, (coalesce(b, 2 * z - a) + z) / 2 AS z_hi FROM n"))
def w8(spark, d):
    return V.level_bounds(profiles(spark, d), ["cell"], "z", "k").select("cell", "k", "z_lo", "z_hi")


@query("w9_positive_up", sql("profiles", "SELECT cell, k, z FROM profiles"))
def w9(spark, d):
    p = profiles(spark, d).withColumn("z", F.when(F.col("cell") % 2 == 0, F.col("z") * 100).otherwise(F.col("z") * -100))
    return V.positive_up(p, ["cell"], "z", "k", "cm").select("cell", "k", "z")


SHIFT = ", n AS (SELECT cell, k, z, v, row_number() OVER (PARTITION BY cell ORDER BY k) AS r, count(*) OVER (PARTITION BY cell) AS n FROM profiles), t AS (SELECT *, least(greatest(r + {dz} / 10, 1), n) AS pos FROM n)"


@query("w10_shift_profile", sql("profiles", SHIFT.format(dz="15.0::DOUBLE") + " SELECT t.cell, t.k, round(CASE WHEN pos = floor(pos) THEN a.v ELSE a.v + (b.v - a.v) * (pos - floor(pos)) END, 6) AS v FROM t JOIN n a ON a.cell = t.cell AND a.r = floor(pos) LEFT JOIN n b ON b.cell = t.cell AND b.r = least(floor(pos) + 1, t.n)"))
def w10(spark, d):
    return V.shift(profiles(spark, d), ["cell"], "k", "z", "v", F.lit(15.0), 10.0).select("cell", "k", F.round("shifted", 6).alias("v"))


@query("w11_cosine_shift", "SELECT s_suppkey AS region, CAST(y AS INT) AS yr, round(s_nationkey * 10 * cos(2 * pi() * (y - 2008) / 16), 6) + 0.0::DOUBLE AS dz FROM supplier, range(2000, 2026) r(y)")
def w11(spark, d):
    s = table(spark, d, "supplier").withColumn("yr", F.explode(F.sequence(F.lit(2000), F.lit(2025))))
    dz = F.round(V.cosine_shift(F.col("yr"), F.col("s_nationkey") * 10), 6) + F.lit(0.0)
    return s.select(F.col("s_suppkey").alias("region"), "yr", dz.alias("dz"))


@query("w12_ramp_before_pivot", sql("series", ", p AS (SELECT cell, flag, mon, v AS pv FROM series WHERE yr = 1998) SELECT cell, flag, yr, mon, CASE WHEN yr < 1998 THEN pv + 0.17 * (1998 - yr) * (cell % 2) ELSE v END AS v FROM series JOIN p USING (cell, flag, mon)"))
def w12(spark, d):
    from gridspark.plans.views import series

    s = series(spark, d)
    p = s.where("yr = 1998").select("cell", "flag", "mon", F.col("v").alias("pv"))
    ramp = V.ramp_before(F.col("yr"), F.col("pv"), F.lit(0.17), F.col("cell") % 2, 1998)
    return s.join(p, ["cell", "flag", "mon"]).select("cell", "flag", "yr", "mon", F.when(F.col("yr") < 1998, ramp).otherwise(F.col("v")).alias("v"))


@query("w13_blend_to_pivot", sql("profiles", ", t AS (SELECT cell, avg(v) FILTER (k < 4) AS top, max(v) AS pv FROM profiles GROUP BY 1) SELECT cell, CAST(y AS INT) AS yr, round(top + (pv - top) * least(greatest((y - 1950) / 50.0, 0), 1), 6) AS v FROM t, (VALUES (1940), (1950), (1975), (2000), (2010)) q(y)"))
def w13(spark, d):
    t = profiles(spark, d).groupBy("cell").agg(F.avg(F.when(F.col("k") < 4, F.col("v"))).alias("top"), F.max("v").alias("pv"))
    t = t.withColumn("yr", F.explode(F.array(*map(F.lit, (1940, 1950, 1975, 2000, 2010)))))
    return t.select("cell", "yr", F.round(V.blend_to_pivot(F.col("yr"), F.col("top"), F.col("pv"), 1950, 2000), 6).alias("v"))


DEPTH = ", d AS (SELECT o_orderkey AS cell, -(o_custkey % 75)::DOUBLE AS draft FROM orders)"


def _depth(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("cell"), (-(F.col("o_custkey") % 75)).cast("double").alias("draft"))


@query("j7_nearest_level", sql("profiles", DEPTH + ", r AS (SELECT cell, v, row_number() OVER (PARTITION BY cell ORDER BY abs(z - draft), -z) AS n FROM profiles JOIN d USING (cell)) SELECT cell, v FROM r WHERE n = 1"))
def j7(spark, d):
    return V.nearest_level(profiles(spark, d), _depth(spark, d), ["cell"], "z", "v", "draft")


@query("j8_value_at_depth", sql("profiles", DEPTH + ", p AS (SELECT *, lead(z) OVER o AS z2, lead(v) OVER o AS v2 FROM profiles WINDOW o AS (PARTITION BY cell ORDER BY k)), f AS (SELECT cell, CASE WHEN draft = z THEN v ELSE v + (v2 - v) * (draft - z) / (z2 - z) END AS v FROM p JOIN d USING (cell) WHERE (z2 IS NULL AND draft = z) OR (draft <= z AND draft > z2)) SELECT d.cell, round(f.v, 6) AS v FROM d LEFT JOIN f USING (cell)"))
def j8(spark, d):
    return V.at_depth(profiles(spark, d), _depth(spark, d), ["cell"], "k", "z", "v", "draft").withColumn("v", F.round("v", 6))
