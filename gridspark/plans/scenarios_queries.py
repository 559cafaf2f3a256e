"""Scenarios, pipelines, incremental append."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from gridspark.operators import fill, freezing, scenarios, vertical
from gridspark.plans.registry import query
from gridspark.plans.views import cells, profiles, series, sql, table
from gridspark.sources import incremental, tables
from gridspark.sources.staging import new_path
from gridspark.streaming import annual


@query("b5_uniform_offsets", sql("cells", "SELECT i, j, o AS scenario, v_holes + o AS v FROM cells, (VALUES (0.5::DOUBLE), (1), (2), (4)) t(o)"))
def b5(spark, d):
    return scenarios.uniform_offsets(cells(spark, d).select("i", "j", F.col("v_holes").alias("v")), "v")


#: A climatology of a few levels by supplier, and the pathways over 1950 to 2025.
CONTEMPORARY = """WITH c AS (SELECT l_suppkey AS cell, l_suppkey % 16 AS zone, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_linenumber) - 1 AS k, count(*) OVER (PARTITION BY l_suppkey) AS n,
  avg(l_quantity) / 10 - 2 AS t, 33 + 20 * avg(l_discount) AS s FROM lineitem GROUP BY l_suppkey, l_linenumber),
y AS (SELECT CAST(x AS INT) AS year FROM range(1950, 2026) t(x)),
p AS (SELECT * FROM (VALUES ('main', 0.0::DOUBLE, -0.0014::DOUBLE), ('cold', -0.17, -0.0062), ('warm', 0.17, 0.0019), ('vary', 0.0, 0.0)) q(scenario, o, fac)),
top AS (SELECT cell, avg(s) AS mean FROM c WHERE k < 13 GROUP BY 1),
g AS (SELECT c.*, y.year, p.scenario, top.mean, t + o + CASE WHEN year < 1995 THEN fac * (1995 - year) * (CASE zone WHEN 9 THEN 1.0 WHEN 8 THEN 0.5 ELSE 0 END) ELSE 0 END AS warm,
  least(greatest(k + (CASE zone WHEN 9 THEN 120.0::DOUBLE WHEN 8 THEN 100 WHEN 4 THEN 100 ELSE 0 END) * cos(2 * pi() * (year - 2008) / 16) / 60, 0), n - 1) AS pos FROM c JOIN top USING (cell), y, p)
SELECT g.cell, g.year, g.scenario, CAST(g.k AS INT) AS k,
  round(CASE WHEN scenario = 'vary' THEN a.t + (b.t - a.t) * (pos - floor(pos)) WHEN scenario = 'cold' AND g.zone = 4 AND year < 2015 THEN -1.9 + (warm + 1.9) * (year - 1950) / 65 ELSE warm END, 6) AS t,
  round(CASE WHEN scenario = 'vary' THEN a.s + (b.s - a.s) * (pos - floor(pos)) WHEN scenario = 'cold' AND g.zone = 4 AND year < 2015 THEN mean + (g.s - mean) * (year - 1950) / 65 ELSE g.s END, 6) AS s
FROM g JOIN c a ON a.cell = g.cell AND a.k = floor(pos) JOIN c b ON b.cell = g.cell AND b.k = least(floor(pos) + 1, g.n - 1)"""


@query("b6_contemporary_scenarios", CONTEMPORARY)
def b6(spark, d):
    rows = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("cell"), "l_linenumber")
    rows = rows.agg((F.avg("l_quantity") / 10 - 2).alias("t"), (33 + 20 * F.avg("l_discount")).alias("s"))
    p = rows.groupBy("cell").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "t", "s"))).alias("a"))
    p = p.select("cell", (F.col("cell") % 16).alias("zone"), F.col("a.t").alias("t"), F.col("a.s").alias("s"))
    out = scenarios.contemporary(p, "t", "s", "zone")
    out = out.select("cell", "year", "scenario", F.posexplode(F.arrays_zip("t", "s")).alias("k", "x"))
    return out.select("cell", "year", "scenario", "k", F.round("x.t", 6).alias("t"), F.round("x.s", 6).alias("s"))


@query("b7_observed_profiles", """WITH f AS (SELECT l_suppkey AS cell, l_suppkey % 5 AS region, CAST(year(l_shipdate) AS INT) AS yr, CAST(l_linenumber AS INT) AS k, avg(l_quantity) AS v FROM lineitem GROUP BY ALL),
o AS (SELECT region, yr, k, avg(v) AS v FROM f WHERE region < 2 AND k % 2 = 1 GROUP BY ALL),
r AS (SELECT DISTINCT region, yr FROM o),
m AS (SELECT r.region, r.yr, CAST(x AS INT) AS k, CASE WHEN x % 2 = 1 THEN a.v ELSE (a.v + b.v) / 2 END AS v FROM r CROSS JOIN range(1, 8) t(x)
  LEFT JOIN o a ON a.region = r.region AND a.yr = r.yr AND a.k = x - (x + 1) % 2 LEFT JOIN o b ON b.region = r.region AND b.yr = r.yr AND b.k = x + (x + 1) % 2),
g AS (SELECT region, yr, k, coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY region, yr ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(v IGNORE NULLS) OVER (PARTITION BY region, yr ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS v FROM m)
SELECT f.cell, f.yr, f.k, round(coalesce(g.v, f.v), 6) AS v FROM f LEFT JOIN g USING (region, yr, k)""")
def b7(spark, d):
    """Profiles observed at every other level, by region and year, brought to all
    levels, replace the field of their region in that year."""
    t = table(spark, d, "lineitem")
    f = t.groupBy(F.col("l_suppkey").alias("cell"), F.year("l_shipdate").alias("yr"), F.col("l_linenumber").cast("int").alias("k")).agg(F.avg("l_quantity").alias("v"))
    f = f.withColumn("region", F.col("cell") % 5)
    obs = f.where("region < 2 and k % 2 = 1").groupBy("region", "yr", "k").agg(F.avg("v").alias("v"))
    levels = spark.range(1, 8, 2).select(F.col("id").cast("int").alias("k"))
    obs = obs.select("region", "yr").distinct().crossJoin(F.broadcast(levels)).join(obs, ["region", "yr", "k"], "left")  # four levels by construction
    weights = vertical.weights_table(spark, vertical.interpolation_weights([1, 3, 5, 7], range(1, 8), extrapolate=False))
    obs = vertical.interpolate(obs.withColumn("k", ((F.col("k") + 1) / 2).cast("int")), weights, ["region", "yr"], "k", "v")
    obs = vertical.fill_both(obs, ["region", "yr"], "k", "v")
    return scenarios.replace_region(f, obs, ["k", "yr"], "region", "v").select("cell", "yr", "k", F.round("v", 6).alias("v"))


@query("b8_thermal_forcing", sql("profiles", ", f AS (SELECT cell, k, v / 10 - 2 AS ct, 30.0::DOUBLE + k AS sa, -0.0572 * (30.0::DOUBLE + k) + 0.0788 + (-7.77e-8) * (1028.0 * 9.81 * (-z)) AS cf FROM profiles WHERE v IS NOT NULL) SELECT cell, k, sa, round(greatest(0, ct - cf), 6) AS tf, round(CASE WHEN ct < cf THEN cf ELSE ct END, 6) AS ct FROM f"))
def b8(spark, d):
    p = profiles(spark, d).where("v is not null").select("cell", "k", "z", (F.col("v") / 10 - 2).alias("ct"), (F.lit(30.0) + F.col("k")).alias("sa"))
    out = freezing.thermal_forcing(p, "ct", "sa", "z")
    return out.select("cell", "k", "sa", F.round("tf", 6).alias("tf"), F.round("ct", 6).alias("ct"))


@query("b10_climatology_preparation", sql("profiles", ", q AS (SELECT cell, k, z, CASE WHEN v < 40 THEN v END AS v FROM profiles), n AS (SELECT *, lag(z) OVER o AS a, lead(z) OVER o AS b FROM q WINDOW o AS (PARTITION BY cell ORDER BY k)) SELECT cell, k, v, (coalesce(a, 2 * z - b) + z) / 2 AS z_lo, (coalesce(b, 2 * z - a) + z) / 2 AS z_hi FROM n"))
def b10(spark, d):
    from gridspark.operators.masks import quality_mask

    p = profiles(spark, d).withColumn("mse", F.col("v"))
    return vertical.level_bounds(quality_mask(p, "v", ["mse"], 40.0), ["cell"], "z", "k").select("cell", "k", "v", "z_lo", "z_hi")


FILL = {"zone_rounds": (fill.FIRST_ROUNDS, fill.SECOND_ROUNDS), "level_rounds": fill.LAST_ROUNDS}
FINE, COARSE = [(0.0, 20.0), (20.0, 40.0), (40.0, 60.0)], [(0.0, 30.0), (30.0, 60.0)]


def _levels(spark, d):
    """Three levels of the field with holes, the lowest one empty."""
    c = cells(spark, d).select("i", "j", "zone", "ice_frac", "v_holes", (F.col("ice_frac") < 0.5).alias("inside"), (F.col("v") > 0).alias("open"))
    return c.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(3)))).withColumn("value", F.when(F.col("k") < 3, F.col("v_holes") / F.col("k")))


@query("b11_extrapolation")
def b11(spark, d):
    rows = _levels(spark, d).withColumns({"time": F.floor(F.col("j") / 40).cast("int"), "j": F.col("j") % 40})
    out = scenarios.extrapolate(rows, ["time"], "k", "value", "ice_frac", 0.5, (20, 120, 5), FINE, COARSE, **FILL)
    return out.select("time", "i", "j", "k", "value")


@query("b11_climatology_fill")
def b11_climatology(spark, d):
    """Without time: one slab a level, as large as the table, filled by tiles."""
    out = scenarios.extrapolate(_levels(spark, d), [], "k", "value", "ice_frac", 0.5, (20, 120, 5), FINE, COARSE, size=128, **FILL)
    return out.select("i", "j", "k", "value")


@query("s6_incremental_append", "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def s6(spark, d):
    """Two overlapping batches of days; the second adds only what is new."""
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    path = new_path(spark, "events")
    incremental.append_new(e.where("day < date'2024-01-20'"), path, ["day"])
    incremental.append_new(e.where("day >= date'2024-01-10'"), path, ["day"])
    out = spark.read.parquet(path)
    return out.groupBy(F.col("day").cast("string").alias("day")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("s2_files_by_year", "SELECT CAST(year(o_orderdate) AS INT) AS yr, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE year(o_orderdate) >= 1996 GROUP BY 1")
def s2(spark, d):
    """Written by year, read back with the years pruned by their folders."""
    path = new_path(spark, "orders")
    o = table(spark, d, "orders").withColumn("yr", F.year("o_orderdate"))
    o.repartition("yr").write.partitionBy("yr").parquet(path)
    return spark.read.parquet(path).where("yr >= 1996").groupBy("yr").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("s2_combined_by_time", "SELECT o_orderkey, CAST(date_diff('day', DATE '1850-01-01', CAST(o_orderdate AS DATE)) AS INT) AS time, o_totalprice AS value FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1994-03-01' AND DATE '1996-10-31'")
def s2_combined(spark, d):
    """Files a year long, which must follow each other by a month at most; those
    outside the range are not opened."""
    path = new_path(spark, "orders-time")
    time = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1850-01-01").cast("date"))
    o = table(spark, d, "orders").select("o_orderkey", time.alias("time"), F.col("o_totalprice").alias("value"), F.year("o_orderdate").alias("yr"))
    o.repartition("yr").write.partitionBy("yr").parquet(path)
    files = [r.file for r in tables.with_lineage(spark.read.parquet(path)).select("file").distinct().collect()]  # a file a year
    first, last = ((date(y, m, day) - date(1850, 1, 1)).days for y, m, day in ((1994, 3, 1), (1996, 10, 31)))
    return tables.combine(spark, files, "time", 31, first, last, f"{path}-manifest").select("o_orderkey", "time", "value")


@query("s6_years_from_a_stream", sql("series", "SELECT cell, flag, yr, round(sum(coalesce(v, 0) * dim) / sum(dim), 9) AS mean FROM series GROUP BY 1, 2, 3 HAVING count(DISTINCT mon) = 12"))
def s6_years(spark, d):
    """Months come in files of a month of all years, the last file twice; each
    year is written by the batch that completes it."""
    source, target, state = (new_path(spark, f"months-{n}") for n in ("in", "out", "state"))
    months = series(spark, d)
    months.repartition("mon").write.partitionBy("mon").parquet(source)
    months.where("mon = 12").withColumn("mon", F.lit(12)).coalesce(1).write.mode("append").partitionBy("mon").parquet(source)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in months.schema)
    annual.annual_stream(spark, source, schema, target, state, ["cell", "flag"], "v", "dim", "yr", "mon", files=5).awaitTermination()
    return spark.read.parquet(target).select("cell", "flag", "yr", F.round("mean", 9).alias("mean"))
