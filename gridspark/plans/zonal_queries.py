"""Zonal sums and means, combined estimates, coarsening."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridspark.operators import zonal
from gridspark.plans.registry import query
from gridspark.plans.views import cells, ensemble, series, sql, zones

DX = 8000.0


@query("a7_zonal_sum", sql("ensemble", "SELECT p1, p2, zone, round(nullif(sum(melt_rate * (8000.0::DOUBLE * 8000 / 1e12)), 0), 9) AS total FROM ensemble GROUP BY 1, 2, 3"))
def a7(spark, d):
    return zonal.zonal_sum(ensemble(spark, d), ["p1", "p2", "zone"], "melt_rate", DX).withColumn("total", F.round("total", 9))


@query("a8_bin_sum", sql("ensemble", "SELECT p1, p2, CAST(floor(melt_rate / 200) AS INT) AS bin, round(nullif(sum(melt_rate * (8000.0::DOUBLE * 8000 / 1e12)), 0), 9) AS total FROM ensemble GROUP BY 1, 2, 3"))
def a8(spark, d):
    e = ensemble(spark, d).withColumn("bin", F.floor(F.col("melt_rate") / 200).cast("int"))
    return zonal.zonal_sum(e, ["p1", "p2", "bin"], "melt_rate", DX).withColumn("total", F.round("total", 9))


@query("a9_warm_minus_cold", sql("cells", ", w AS (SELECT zone, avg(v) AS m, sqrt(avg(pow(i, 2))) AS s FROM cells WHERE ice_frac = 0 GROUP BY 1), c AS (SELECT zone, avg(v) AS m, sqrt(avg(pow(i, 2))) AS s FROM cells WHERE ice_frac > 0 GROUP BY 1) SELECT zone, round(w.m - c.m, 6) AS difference, round(sqrt(w.s * w.s + c.s * c.s), 6) AS sigma FROM w JOIN c USING (zone)"))
def a9(spark, d):
    c = cells(spark, d)
    out = zonal.zonal_difference(c.where("ice_frac = 0"), c.where("ice_frac > 0"), ["zone"], "v", "i")
    return out.select("zone", F.round("difference", 6).alias("difference"), F.round("sigma", 6).alias("sigma"))


@query("a10_region_year_sum", sql("series", "SELECT flag, yr, round(sum(v), 4) AS total FROM series WHERE (flag, yr) IN (('A', 1996), ('A', 1998), ('R', 1997)) GROUP BY 1, 2"))
def a10(spark, d):
    seen = spark.createDataFrame([("A", 1996), ("A", 1998), ("R", 1997)], "flag string, yr int")
    return series(spark, d).groupBy("flag", "yr").agg(F.round(F.sum("v"), 4).alias("total")).join(seen, ["flag", "yr"])


@query("a11_mean_and_rms", sql("cells", "SELECT zone, round(avg(v), 6) AS mean, round(sqrt(avg(v_holes * v_holes)), 6) AS error FROM cells GROUP BY 1"))
def a11(spark, d):
    out = zonal.mean_and_rms(cells(spark, d), ["zone"], "v", "v_holes")
    return out.select("zone", F.round("mean", 6).alias("mean"), F.round("error", 6).alias("error"))


@query("a12_masked_mean_series", sql("series", "SELECT flag, yr, round(sum(v * (cell % 3)) / sum(CASE WHEN v IS NOT NULL THEN cell % 3 ELSE cell % 3 END), 6) AS mean FROM series GROUP BY 1, 2"))
def a12(spark, d):
    return series(spark, d).groupBy("flag", "yr").agg(F.round(zonal.masked_mean(F.col("v"), F.col("cell") % 3), 6).alias("mean"))


EST = """, e AS (SELECT zone, avg(v) AS a, stddev_pop(v) AS ea, avg(v_holes) AS b, stddev_pop(v_holes) AS eb, CASE WHEN zone % 4 <> 0 THEN avg(ice_frac) * 5000 END AS c, CASE WHEN zone % 4 <> 0 THEN CAST(100 AS DOUBLE) END AS ec FROM cells GROUP BY 1)"""


def _estimates(spark, d):
    some = F.col("zone") % 4 != 0
    return cells(spark, d).groupBy("zone").agg(
        F.avg("v").alias("a"), F.stddev_pop("v").alias("ea"), F.avg("v_holes").alias("b"), F.stddev_pop("v_holes").alias("eb"),
        (F.avg("ice_frac") * 5000).alias("c"),
    ).withColumns({"c": F.when(some, F.col("c")), "ec": F.when(some, 100.0)})


def _combined(spark, d, skipna):
    mean, half = zonal.combine_estimates([("a", "ea"), ("b", "eb"), ("c", "ec")], skipna)
    return _estimates(spark, d).select("zone", F.round(mean, 5).alias("mean"), F.round(half, 5).alias("half_range"))


@query("a13_combined_estimates", sql("cells", EST + " SELECT zone, round((a + b + coalesce(c, 0)) / (2 + (c IS NOT NULL)::INT), 5) AS mean, round((greatest(a + ea, b + eb, c + ec) - least(a - ea, b - eb, c - ec)) / 2, 5) AS half_range FROM e"))
def a13(spark, d):
    return _combined(spark, d, True)


@query("a13_combined_estimates_strict", sql("cells", EST + " SELECT zone, round((a + b + c) / 3, 5) AS mean, CASE WHEN c IS NOT NULL THEN round((greatest(a + ea, b + eb, c + ec) - least(a - ea, b - eb, c - ec)) / 2, 5) END AS half_range FROM e"))
def a13_strict(spark, d):
    return _combined(spark, d, False)


@query("a14_error_sums", sql("cells", "SELECT zone, round(sum(v_holes), 4) AS correlated, round(sqrt(sum(v_holes * v_holes)), 4) AS independent FROM cells GROUP BY 1"))
def a14(spark, d):
    a, b = zonal.error_sums("v_holes")
    return cells(spark, d).groupBy("zone").agg(F.round(a, 4).alias("correlated"), F.round(b, 4).alias("independent"))


@query("a15_basin_totals", sql("cells", "SELECT nation, round(sum(v), 4) AS total, round(sqrt(sum(v * v)) / count(*), 6) AS error FROM cells WHERE nation NOT IN (7) AND nation < 20 GROUP BY 1"))
def a15(spark, d):
    c = cells(spark, d).withColumn("name", F.col("nation").cast("string"))
    out = zonal.basin_totals(c, "nation", "v", "v", "name", ["7"], 20)
    return out.select("nation", F.round("total", 4).alias("total"), F.round("error", 6).alias("error"))


@query("a15_basin_totals_plain", sql("cells", "SELECT nation, round(sum(v), 4) AS total, round(sum(i), 4) AS error FROM cells WHERE nation NOT IN (7) AND nation < 20 GROUP BY 1"))
def a15_plain(spark, d):
    c = cells(spark, d).withColumns({"name": F.col("nation").cast("string"), "i": F.col("i").cast("double")})
    out = zonal.basin_totals(c, "nation", "v", "i", "name", ["7"], 20, by_count=False)
    return out.select("nation", F.round("total", 4).alias("total"), F.round("error", 4).alias("error"))


@query("a20_cell_volume", sql("cells", "SELECT i, j, CASE WHEN v_holes IS NULL THEN 0 ELSE 60.0::DOUBLE * 8000 * 8000 END AS volume FROM cells"))
def a20(spark, d):
    from gridspark.operators.distributions import cell_volume

    return cells(spark, d).select("i", "j", cell_volume(F.col("v_holes"), 60.0, DX, DX).alias("volume"))


@query("a33_coarsen", sql("cells", "SELECT CAST(i // 2 AS INT) AS i, CAST(j // 2 AS INT) AS j, round(avg(v), 6) AS v FROM cells GROUP BY 1, 2 HAVING count(*) = 4"))
def a33(spark, d):
    return zonal.coarsen(cells(spark, d), "v").withColumn("v", F.round("v", 6))


@query("a34_long_run_mean", sql("series", "SELECT cell, round(avg(v), 6) AS mean FROM (SELECT cell, yr, sum(v) AS v FROM series WHERE yr BETWEEN 1996 AND 1999 GROUP BY 1, 2) GROUP BY 1"))
def a34(spark, d):
    years = [1996, 1997, 1998, 1999]
    wide = series(spark, d).groupBy("cell").pivot("yr", years).agg(F.sum("v"))
    return zonal.long_run_mean(wide, "cell", [str(y) for y in years]).withColumn("mean", F.round("mean", 6))


@query("a35_time_to_offset", sql("series", ", m AS (SELECT yr, round(avg(v) - 20, 2) AS o FROM series WHERE cell % 16 = 14 GROUP BY 1) SELECT o AS \"offset\", count(*) AS n FROM series JOIN m USING (yr) GROUP BY 1"))
def a35(spark, d):
    s = series(spark, d).withColumn("zone", F.col("cell") % 16)
    return zonal.time_to_offset(s, "zone", 14, "yr", "v", 20.0).groupBy("offset").agg(F.count("*").alias("n"))


@query("s11_zone_names", sql("cells zones", "SELECT name, count(*) AS n FROM cells JOIN zones USING (zone) GROUP BY 1"))
def zone_names(spark, d):
    return cells(spark, d).join(zones(spark, d), "zone").groupBy("name").agg(F.count("*").alias("n"))
