"""Time means, windows, blocks, alignment and the classic bias correction."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridspark.functions import calendars
from gridspark.operators import align, biascorr, timeagg
from gridspark.plans.registry import query
from gridspark.plans.views import series, sql, table

MEAN = "sum(coalesce(v, 0) * dim) / sum(dim)"


@query("a3_annual_mean", sql("series", f"SELECT cell, flag, yr, {MEAN} AS mean, count(DISTINCT mon) AS n_months FROM series GROUP BY 1, 2, 3"))
def a3(spark, d):
    return timeagg.annual_mean(series(spark, d), ["cell", "flag"], "v", "dim", "yr", "mon")


@query("a1_window_mean", sql("series", f"SELECT cell, flag, {MEAN} AS mean FROM series WHERE yr BETWEEN 1996 AND 1998 GROUP BY 1, 2"))
def a1(spark, d):
    return timeagg.window_mean(series(spark, d), ["cell", "flag"], "v", "dim", "yr", 1996, 1998)


@query("a1_window_mean_skipna", sql("series", "SELECT cell, flag, sum(v * dim) / sum(CASE WHEN v IS NOT NULL THEN dim END) AS mean FROM series WHERE yr BETWEEN 1996 AND 1998 GROUP BY 1, 2"))
def a1_skipna(spark, d):
    return timeagg.window_mean(series(spark, d), ["cell", "flag"], "v", "dim", "yr", 1996, 1998, skipna=True)


CLIM = f"""clim AS (SELECT cell, flag, {MEAN} AS mean FROM series WHERE yr BETWEEN 1996 AND 1998 GROUP BY 1, 2),
bias AS (SELECT cell, m.mean - o.mean AS bias FROM (SELECT * FROM clim WHERE flag = 'A') m JOIN (SELECT * FROM clim WHERE flag = 'R') o USING (cell))"""


@query("a2_bias", sql("series", f", {CLIM} SELECT cell, bias FROM bias"))
def a2(spark, d):
    s = series(spark, d)
    model, obs = (timeagg.window_mean(s.where(F.col("flag") == f), ["cell"], "v", "dim", "yr", 1996, 1998) for f in "AR")
    return biascorr.bias(model, obs, ["cell"], "mean")


@query("b1_classic_correction", sql("series", f", {CLIM} SELECT cell, yr, mon, v - bias AS corrected FROM series JOIN bias USING (cell) WHERE flag = 'A'"))
def b1(spark, d):
    s = series(spark, d)
    model = s.where("flag = 'A'")
    obs = timeagg.window_mean(s.where("flag = 'R'"), ["cell"], "v", "dim", "yr", 1996, 1998)
    return biascorr.classic(model, obs, ["cell"], "v", "dim", "yr", 1996, 1998).select("cell", "yr", "mon", "corrected")


@query("a4_missing_years", sql("series", "SELECT s.cell, s.flag, CAST(y AS INT) AS yr FROM (SELECT DISTINCT cell, flag FROM series) s, range(1995, 2003) r(y) WHERE NOT EXISTS (SELECT 1 FROM series t WHERE t.cell = s.cell AND t.flag = s.flag AND t.yr = r.y)"))
def a4(spark, d):
    return timeagg.missing_years(series(spark, d), ["cell", "flag"], "yr", 1995, 2002)


@query("a5_mean_standard_error", sql("series", "SELECT cell, flag, round(avg(v), 9) AS mean, round(stddev_pop(v) / sqrt(count(v)), 9) AS error FROM series GROUP BY 1, 2"))
def a5(spark, d):
    return timeagg.mean_and_error(series(spark, d), ["cell", "flag"], "v").select("cell", "flag", F.round("mean", 9).alias("mean"), F.round("error", 9).alias("error"))


@query("a6_member_spread", sql("series", "SELECT cell, yr, round(avg(v), 9) AS mean, round(stddev_pop(v), 9) AS spread FROM series GROUP BY 1, 2"))
def a6(spark, d):
    return timeagg.mean_and_spread(series(spark, d), ["cell", "yr"], "v").select("cell", "yr", F.round("mean", 9).alias("mean"), F.round("spread", 9).alias("spread"))


@query("p1_time_range", "SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity FROM lineitem WHERE l_shipdate BETWEEN DATE '1996-01-01' AND DATE '1998-01-01'")
def p1(spark, d):
    return timeagg.time_slice(table(spark, d, "lineitem"), "l_shipdate", 1996, 1997).select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")


@query("p2_year_window_mean", sql("series", "SELECT cell, round(avg(v), 9) AS mean FROM series WHERE yr BETWEEN 1997 AND 1999 GROUP BY 1"))
def p2(spark, d):
    s = series(spark, d).withColumn("one", F.when(F.col("v").isNotNull(), 1))
    return timeagg.window_mean(s, ["cell"], "v", "one", "yr", 1997, 1999, skipna=True).select("cell", F.round("mean", 9).alias("mean"))


@query("p3_last_twenty", sql("series", "SELECT cell, flag, yr, mon, v FROM (SELECT *, row_number() OVER (PARTITION BY cell, flag ORDER BY yr DESC, mon DESC) AS k FROM series) WHERE k BETWEEN 2 AND 21"))
def p3(spark, d):
    return timeagg.last_steps_but_one(series(spark, d), ["cell", "flag"], ["yr", "mon"]).select("cell", "flag", "yr", "mon", "v")


@query("w15_time_blocks", sql("series", "SELECT cell, flag, yr, mon, CAST((dense_rank() OVER (PARTITION BY cell, flag ORDER BY yr, mon) - 1) // 12 AS INT) AS block FROM series"))
def w15(spark, d):
    return timeagg.time_blocks(series(spark, d), ["cell", "flag"], ["yr", "mon"], 12).select("cell", "flag", "yr", "mon", "block")


@query("s5_split_blocks", sql("series", ", b AS (SELECT *, CAST((dense_rank() OVER (PARTITION BY flag ORDER BY yr, mon) - 1) // 24 AS INT) AS block FROM series) SELECT flag, block, min(yr) AS first_year, max(yr) AS last_year, count(*) AS n FROM b GROUP BY 1, 2"))
def s5(spark, d):
    b = timeagg.time_blocks(series(spark, d), ["flag"], ["yr", "mon"], 24)
    return b.groupBy("flag", "block").agg(F.min("yr").alias("first_year"), F.max("yr").alias("last_year"), F.count("*").alias("n"))


@query("p15_point_series", sql("series", "SELECT cell, flag, yr, mon, v FROM series WHERE cell IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000)"))
def p15(spark, d):
    points = table(spark, d, "supplier").where("s_acctbal > 5000").select(F.col("s_suppkey").alias("cell"))
    return timeagg.at_points(series(spark, d), points, ["cell"]).select("cell", "flag", "yr", "mon", "v")


@query("p18_two_variables_at_a_year", sql("series", "SELECT cell, mon, a.v AS t, r.v AS s FROM (SELECT * FROM series WHERE flag = 'A' AND yr = 1997) a JOIN (SELECT * FROM series WHERE flag = 'R' AND yr = 1997) r USING (cell, mon)"))
def p18(spark, d):
    s = series(spark, d).where("yr = 1997")
    t, r = (s.where(F.col("flag") == f).select("cell", "mon", F.col("v").alias(n)) for f, n in (("A", "t"), ("R", "s")))
    return t.join(r, ["cell", "mon"])


@query("f8_calendar_fields", "SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS yr, CAST(month(o_orderdate) AS INT) AS mon, CAST(day(last_day(o_orderdate)) AS INT) AS days_gregorian, CAST(CASE WHEN month(o_orderdate) = 2 THEN 28 ELSE day(last_day(o_orderdate)) END AS INT) AS days_noleap, 30 AS days_360, CAST(date_diff('day', DATE '1850-01-01', CAST(date_trunc('year', o_orderdate) AS DATE)) AS INT) AS year_start FROM orders")
def f8(spark, d):
    o = table(spark, d, "orders")
    y, m = F.year("o_orderdate"), F.month("o_orderdate")
    return o.select(
        "o_orderkey", y.alias("yr"), m.alias("mon"),
        *[calendars.days_in_month(y, m, F.lit(c)).alias(n) for c, n in (("gregorian", "days_gregorian"), ("noleap", "days_noleap"), ("360_day", "days_360"))],
        calendars.year_start(y, F.lit("gregorian")).alias("year_start"),
    )


@query("j1_unmatched_keys", sql("series", ", a AS (SELECT DISTINCT cell, yr, mon FROM series WHERE flag = 'A'), r AS (SELECT DISTINCT cell, yr, mon FROM series WHERE flag = 'R') SELECT cell, yr, mon, 'left' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM r) UNION ALL SELECT cell, yr, mon, 'right' FROM (SELECT * FROM r EXCEPT SELECT * FROM a)"))
def j1(spark, d):
    s = series(spark, d)
    return align.unmatched(s.where("flag = 'A'"), s.where("flag = 'R'"), ["cell", "yr", "mon"])


@query("j2_time_axis_difference", sql("series", "SELECT yr, mon FROM series WHERE flag = 'A' EXCEPT ALL SELECT yr, mon FROM series WHERE flag = 'R'"))
def j2(spark, d):
    s = series(spark, d)
    a, r = (s.where(F.col("flag") == f).select("yr", "mon") for f in "AR")
    return a.exceptAll(r)


@query("j3_subtract_field", sql("series", f", {CLIM} SELECT cell, flag, yr, mon, v - mean AS anomaly FROM series JOIN (SELECT cell, mean FROM clim WHERE flag = 'R') USING (cell)"))
def j3(spark, d):
    s = series(spark, d)
    clim = timeagg.window_mean(s.where("flag = 'R'"), ["cell"], "v", "dim", "yr", 1996, 1998)
    return align.subtract(s, clim, ["cell"], "v", "mean", "anomaly").select("cell", "flag", "yr", "mon", "anomaly")


@query("t1_ordered_concatenation", sql("series", "SELECT row_number() OVER (ORDER BY yr, mon, cell, flag) AS at, cell, flag, yr, mon FROM series"))
def t1(spark, d):
    from gridspark.operators import ordering

    s = series(spark, d)
    parts = s.where("yr < 1998").unionByName(s.where("yr >= 1998"))
    return ordering.global_rank(parts.select("cell", "flag", "yr", "mon"), ["yr", "mon", "cell", "flag"], "at")


@query("t2_inconsistent_levels", sql("series", ", l AS (SELECT cell || ':' || flag || ':' || yr AS chunk, list_sort(list(DISTINCT mon)) AS levels FROM series GROUP BY 1), c AS (SELECT levels FROM l GROUP BY 1 ORDER BY count(*) DESC, levels LIMIT 1) SELECT chunk, CAST(len(levels) AS INT) AS n_levels FROM l WHERE levels <> (SELECT levels FROM c)"))
def t2(spark, d):
    s = series(spark, d).withColumn("chunk", F.concat_ws(":", "cell", "flag", "yr"))
    return align.consistent_levels(s, "chunk", "mon")


@query("t4_concatenated_members", sql("series", "SELECT 'hist' AS member, cell, yr, mon, v FROM series WHERE flag = 'A' UNION ALL SELECT 'future', cell, yr, mon, v FROM series WHERE flag = 'R'"))
def t4(spark, d):
    s = series(spark, d)
    return align.stack({n: s.where(F.col("flag") == f).select("cell", "yr", "mon", "v") for n, f in (("hist", "A"), ("future", "R"))}, "member")
