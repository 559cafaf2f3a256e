"""Masks, checks, lookups, scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridspark.functions import convert
from gridspark.operators import align, freezing, masks
from gridspark.plans.registry import query
from gridspark.plans.views import cells, ensemble, sql, table, zones


@query("p4_rename", "SELECT c_custkey AS cell, c_acctbal AS thetao FROM customer")
def p4(spark, d):
    return convert.renamed(table(spark, d, "customer"), {"c_custkey": "cell", "c_acctbal": "thetao"}).select("cell", "thetao")


@query("p5_keep_variable", sql("cells", "SELECT i, j, v FROM cells"))
def p5(spark, d):
    return masks.keep_variable(cells(spark, d), "v", ["i", "j"])


@query("p6_quality_mask", "SELECT l_orderkey, l_linenumber, CASE WHEN l_discount < 0.05 AND l_tax < 0.05 THEN l_quantity END AS l_quantity FROM lineitem")
def p6(spark, d):
    return masks.quality_mask(table(spark, d, "lineitem"), "l_quantity", ["l_discount", "l_tax"], 0.05).select("l_orderkey", "l_linenumber", "l_quantity")


@query("p7_under_ice", sql("cells", "SELECT i, j, CASE WHEN ice_frac > 0.5 THEN NULL ELSE v END AS v FROM cells"))
def p7(spark, d):
    return cells(spark, d).select("i", "j", masks.under_ice(F.col("v"), F.col("ice_frac"), 0.5).alias("v"))


@query("p8_open_ocean", sql("cells", "SELECT i, j, v FROM cells WHERE ice_frac = 0 AND zone <> 3"))
def p8(spark, d):
    c = cells(spark, d).withColumn("grounded", F.when(F.col("zone") == 3, 1.0).otherwise(0.0))
    return masks.open_ocean(c, "ice_frac", "grounded").select("i", "j", "v")


@query("p9_range_checks", sql("cells", "SELECT i, j, CASE WHEN v BETWEEN 0 AND 5000 AND ice_frac <= 0.5 THEN v END AS s, CASE WHEN abs(v_holes) <= 4000 THEN v_holes ELSE 0 END AS melt FROM cells"))
def p9(spark, d):
    return cells(spark, d).select("i", "j", masks.in_range(F.col("v"), 0, 5000, F.col("ice_frac")).alias("s"), masks.melt_or_zero(F.col("v_holes"), 4000).alias("melt"))


@query("p10_topography_codes", sql("cells", "SELECT i, j, CASE WHEN zone % 5 IN (0, 3) THEN 1.0::DOUBLE ELSE 0 END AS ocean_frac, CASE WHEN zone % 5 = 1 THEN 1.0::DOUBLE ELSE 0 END AS rock_frac, CASE WHEN zone % 5 IN (2, 4) THEN 1.0::DOUBLE ELSE 0 END AS grounded_frac, CASE WHEN zone % 5 = 3 THEN 1.0::DOUBLE ELSE 0 END AS floating_frac, v - i AS draft FROM cells"))
def p10(spark, d):
    c = cells(spark, d)
    parts = masks.topography_fractions(F.col("zone") % 5, masks.CODES_A)
    return c.select("i", "j", *[x.alias(n) for n, x in parts.items()], masks.draft(F.col("v"), F.col("i")).alias("draft"))


@query("p11_freezing_clip", sql("cells", ", f AS (SELECT i, j, v / 1000 - 3 AS ct, -0.0573 * (v % 35) + 0.0832 + (-7.53e-8) * (1028.0 * 9.81 * i * 20) AS cf FROM cells) SELECT i, j, round(greatest(0, ct - cf), 6) AS tf, round(CASE WHEN ct < cf THEN cf ELSE ct END, 6) AS ct FROM f"))
def p11(spark, d):
    ct, p = F.col("v") / 1000 - 3, freezing.hydrostatic_pressure(F.col("i") * -20)
    tf, clipped = freezing.clip_to_freezing(ct, freezing.freezing_point(F.col("v") % 35, p, "contemporary"))
    return cells(spark, d).select("i", "j", F.round(tf, 6).alias("tf"), F.round(clipped, 6).alias("ct"))


@query("p12_restrict_member", sql("ensemble", "SELECT p1, p2, zone, CASE WHEN p2 <> 3 OR zone IN (9, 14) THEN melt_rate END AS melt_rate FROM ensemble"))
def p12(spark, d):
    e = ensemble(spark, d)
    return e.withColumn("melt_rate", masks.restrict_member(F.col("melt_rate"), F.col("p2").cast("string"), F.col("zone"), "3", [9, 14]))


@query("p13_region_labels", sql("cells", "SELECT i, j, CASE WHEN zone = 14 AND i > 20 THEN 'pig' WHEN zone = 14 THEN 'dotson' WHEN j > i THEN 'above' ELSE 'below' END AS region FROM cells"))
def p13(spark, d):
    z, i, j = F.col("zone"), F.col("i"), F.col("j")
    return cells(spark, d).select("i", "j", F.when((z == 14) & (i > 20), "pig").when(z == 14, "dotson").when(j > i, "above").otherwise("below").alias("region"))


@query("p14_zero_is_missing", sql("cells", "SELECT zone, nullif(sum(ice_frac), 0) AS total FROM cells GROUP BY 1"))
def p14(spark, d):
    return cells(spark, d).groupBy("zone").agg(masks.zero_is_missing(F.sum("ice_frac")).alias("total"))


@query("p16_attach_coordinates", sql("cells", "SELECT i, j, v, i * 8000.0::DOUBLE - 160000 AS x, j * 8000.0::DOUBLE - 160000 AS y FROM cells"))
def p16(spark, d):
    c = cells(spark, d)
    grid = c.select("i", "j").distinct().select("i", "j", (F.col("i") * 8000.0 - 160000).alias("x"), (F.col("j") * 8000.0 - 160000).alias("y"))
    return masks.attach_coords(c.select("i", "j", "v"), grid)


@query("p17_required_columns", sql("cells", "SELECT i, j, ice_frac FROM cells"))
def p17(spark, d):
    return masks.require_columns(cells(spark, d), ["i", "j", "ice_frac"]).select("i", "j", "ice_frac")


@query("b4_zone_masks", sql("cells", "SELECT i, j, zone, zone < 12 AS in_zone, zone < 12 AND v > 1500 AS on_shelf FROM cells"))
def b4(spark, d):
    c = cells(spark, d).select("i", "j", "zone", "v", F.when(F.col("zone") < 12, F.col("zone")).otherwise(-1).alias("z"))
    return masks.zone_masks(c, "z", "v", 1500.0).select("i", "j", "zone", "in_zone", "on_shelf")


@query("j4_broadcast_mask", "SELECT l_orderkey, l_linenumber, l_quantity * (CASE WHEN s_acctbal > 0 THEN 1 ELSE 0 END) AS v FROM lineitem JOIN supplier ON l_suppkey = s_suppkey")
def j4(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", F.when(F.col("s_acctbal") > 0, 1).otherwise(0).alias("m"))
    return table(spark, d, "lineitem").join(s, F.col("l_suppkey") == F.col("s_suppkey")).select("l_orderkey", "l_linenumber", (F.col("l_quantity") * F.col("m")).alias("v"))


@query("j12_name_lookup", sql("zones", "SELECT s_suppkey, zone FROM (SELECT s_suppkey, CASE WHEN n = 'NATION_99' THEN 'NATION_1' ELSE n END AS n FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 10 = 0 THEN 'NATION_99' WHEN s_suppkey % 10 = 1 THEN 'NOWHERE' ELSE 'NATION_' || s_nationkey END AS n FROM supplier)) s LEFT JOIN zones ON n = name"))
def j12(spark, d):
    k = F.col("s_suppkey") % 10
    s = table(spark, d, "supplier").select("s_suppkey", F.when(k == 0, "NATION_99").when(k == 1, "NOWHERE").otherwise(F.concat(F.lit("NATION_"), F.col("s_nationkey"))).alias("n"))
    return align.with_alias(s, {"NATION_99": "NATION_1"}, "n", zones(spark, d), "name").select("s_suppkey", "zone")


@query("j14_blend_by_zone", sql("cells", "SELECT i, j, CASE WHEN zone >= 12 THEN v WHEN zone BETWEEN 8 AND 10 THEN v_holes ELSE ice_frac END AS v FROM cells"))
def j14(spark, d):
    rule = align.blend("zone", [(12, 99, F.col("v")), (8, 10, F.col("v_holes"))], F.col("ice_frac"))
    return cells(spark, d).select("i", "j", rule.alias("v"))


@query("j16_replace_rows", sql("zones", ", a AS (SELECT zone, sum(c_acctbal) AS v FROM (SELECT c_nationkey % 16 AS zone, c_acctbal FROM customer) GROUP BY 1), b AS (SELECT s_nationkey % 16 AS zone, sum(s_acctbal) AS v FROM supplier GROUP BY 1) SELECT a.zone, round(CASE WHEN a.zone IN (3, 13) THEN b.v ELSE a.v END, 4) AS v FROM a LEFT JOIN b USING (zone)"))
def j16(spark, d):
    a = cells(spark, d).groupBy("zone").agg(F.sum("v").alias("v"))
    b = table(spark, d, "supplier").groupBy((F.col("s_nationkey") % 16).alias("zone")).agg(F.sum("s_acctbal").alias("v"))
    return align.replace_rows(a, b, "zone", [3, 13], "v").select("zone", F.round("v", 4).alias("v"))


@query("t5_sum_zero_missing", sql("cells", "SELECT i, j, nullif(coalesce(v_holes, 0) + coalesce(CASE WHEN ice_frac > 0 THEN v END, 0), 0) AS v FROM cells"))
def t5(spark, d):
    other = F.when(F.col("ice_frac") > 0, F.col("v"))
    return cells(spark, d).select("i", "j", masks.zero_is_missing(F.coalesce("v_holes", F.lit(0.0)) + F.coalesce(other, F.lit(0.0))).alias("v"))


@query("t6_pivot_members", sql("ensemble", "SELECT p1, round(sum(melt_rate) FILTER (p2 = 1), 4) AS p2_1, round(sum(melt_rate) FILTER (p2 = 2), 4) AS p2_2, round(sum(melt_rate) FILTER (p2 = 3), 4) AS p2_3, round(sum(melt_rate) FILTER (p2 = 4), 4) AS p2_4, round(sum(melt_rate) FILTER (p2 = 5), 4) AS p2_5 FROM ensemble GROUP BY 1"))
def t6(spark, d):
    out = ensemble(spark, d).groupBy("p1").pivot("p2", [1, 2, 3, 4, 5]).agg(F.round(F.sum("melt_rate"), 4))
    return out.toDF("p1", *[f"p2_{k}" for k in range(1, 6)])


@query("t8_observation_table", "SELECT s_suppkey AS region, y AS year, CASE WHEN y = 2010 THEN s_acctbal * 920.0::DOUBLE / 1000 END AS gt FROM supplier, (VALUES (2009), (2010)) AS t(y)")
def t8(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("region"), "s_acctbal")
    seen = s.select("region", F.lit(2010).alias("year"), convert.km3_to_gt(F.col("s_acctbal"), 920.0).alias("gt"))
    return seen.unionByName(s.select("region", F.lit(2009).alias("year"), F.lit(None).cast("double").alias("gt")))


@query("f1_wrap_coordinates", sql("cells", "SELECT i, j, round(((v % 360) + 360) % 360, 6) AS lon360, round((((v + 180) % 360) + 360) % 360 - 180, 6) AS lon180, greatest(-85, least(90, v / 50)) AS lat FROM cells"))
def f1(spark, d):
    v = F.col("v")
    return cells(spark, d).select("i", "j", F.round(convert.lon_360(v), 6).alias("lon360"), F.round(convert.lon_180(v), 6).alias("lon180"), convert.clip_lat(v / 50).alias("lat"))


@query("f2_hydrostatic_pressure", sql("cells", "SELECT i, j, 1028.0 * 9.81 * (j * 20.0::DOUBLE) AS p FROM cells"))
def f2(spark, d):
    return cells(spark, d).select("i", "j", freezing.hydrostatic_pressure(F.col("j") * -20.0).alias("p"))


@query("f3_freezing_points", sql("cells", "SELECT i, j, round(-0.0572 * (v % 35) + 0.0788 - 7.77e-8 * (i * 1000.0::DOUBLE), 8) AS a, round(-0.0573 * (v % 35) + 0.0832 + (-7.53e-8) * (i * 1000.0::DOUBLE), 8) AS b FROM cells"))
def f3(spark, d):
    s, p = F.col("v") % 35, F.col("i") * 1000.0
    return cells(spark, d).select("i", "j", F.round(freezing.freezing_point(s, p, "modelling"), 8).alias("a"), F.round(freezing.freezing_point(s, p, "contemporary"), 8).alias("b"))


@query("f4_unit_conversions", sql("cells", "SELECT i, j, v * (8000.0::DOUBLE * 8000 / 1e12) AS gt, v / 917.0::DOUBLE AS m_ice, -v AS down, v / 100 AS m FROM cells"))
def f4(spark, d):
    v = F.col("v")
    return cells(spark, d).select("i", "j", convert.rate_to_gt(v, 8000.0).alias("gt"), convert.mass_to_metres(v, 917.0).alias("m_ice"), (-v).alias("down"), convert.cm_to_m(v).alias("m"))


@query("f6_parse_names", "SELECT doc_id, CAST(regexp_extract(f, '_(\\d{4})\\d{0,2}-(\\d{4})\\d{0,2}\\.', 1) AS INT) AS first_year, CAST(regexp_extract(f, '_(\\d{4})\\d{0,2}-(\\d{4})\\d{0,2}\\.', 2) AS INT) AS last_year, replace(f, 'Omon_', 'Oyr_') AS annual FROM (SELECT doc_id, 'thetao_Omon_' || upper(source) || '_' || (1850 + doc_id % 100) || '01-' || (1950 + doc_id % 100) || '12.nc' AS f FROM documents)")
def f6(spark, d):
    k = F.col("doc_id") % 100
    f = F.concat(F.lit("thetao_Omon_"), F.upper("source"), F.lit("_"), (1850 + k).cast("string"), F.lit("01-"), (1950 + k).cast("string"), F.lit("12.nc"))
    first, last = convert.year_range(f)
    return table(spark, d, "documents").select("doc_id", first.alias("first_year"), last.alias("last_year"), convert.annual_name(f).alias("annual"))


@query("f7_value_and_error", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN -1 ELSE 1 END * (1000 + doc_id % 77) / 10 AS value, (doc_id % 9)::DOUBLE AS error FROM documents")
def f7(spark, d):
    k = F.col("doc_id")
    n = 1000 + k % 77
    # a text as papers print it: Unicode minus, a space in the thousands, one decimal
    whole = F.concat(F.floor(n / 1000).cast("string"), F.lit(" "), F.lpad((n % 1000).cast("string"), 3, "0"))
    text = F.concat(F.when(k % 3 == 0, "−").otherwise(""), whole, F.lit(" ± "), (k % 9).cast("string"))
    value, error = convert.value_and_error(text)
    return table(spark, d, "documents").select("doc_id", (value / 10).alias("value"), error.alias("error"))


@query("f9_null_handling", sql("cells", "SELECT i, j, coalesce(v_holes, 0) AS filled, v_holes + v AS kept FROM cells"))
def f9(spark, d):
    return cells(spark, d).select("i", "j", convert.fill(F.col("v_holes"), 0.0).alias("filled"), (convert.finite(F.col("v_holes")) + F.col("v")).alias("kept"))
