"""Regridding, nearest lookups, polygons, the polar grid."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from gridspark.operators import regrid as R
from gridspark.operators import cover, scenarios, tiles
from gridspark.plans.registry import query
from gridspark.plans.views import cells, sql, table

WEIGHTS = ", w AS (SELECT i, j, CAST(i // 3 AS INT) AS di, CAST(j // 3 AS INT) AS dj, (1 + (i + j) % 3) / 9.0::DOUBLE AS w FROM cells)"


def _weights(c):
    return c.select("i", "j", F.floor(F.col("i") / 3).cast("int").alias("di"), F.floor(F.col("j") / 3).cast("int").alias("dj"), ((1 + (F.col("i") + F.col("j")) % 3) / 9.0).alias("w"))


@query("j5_sparse_weights", sql("cells", WEIGHTS + " SELECT di, dj, round(sum(v_holes * w), 6) AS v FROM cells JOIN w USING (i, j) GROUP BY 1, 2"))
def j5(spark, d):
    c = cells(spark, d)
    return R.apply_weights(c.select("i", "j", F.col("v_holes").alias("v")), _weights(c), ["i", "j"], ["di", "dj"], "v").withColumn("v", F.round("v", 6))


@query("j5_renormalized", sql("cells", WEIGHTS + " SELECT di, dj, CASE WHEN sum(CASE WHEN v_holes IS NOT NULL THEN w ELSE 0 END) > 1.2 THEN round(sum(v_holes * w) / sum(CASE WHEN v_holes IS NOT NULL THEN w ELSE 0 END), 6) END AS v FROM cells JOIN w USING (i, j) GROUP BY 1, 2"))
def j5_renormalized(spark, d):
    c = cells(spark, d)
    return R.apply_weights(c.select("i", "j", F.col("v_holes").alias("v")), _weights(c), ["i", "j"], ["di", "dj"], "v", renormalize=1.2).withColumn("v", F.round("v", 6))


FIELD = "f AS (SELECT CAST(l_suppkey % 40 AS INT) AS i, CAST(l_suppkey // 40 AS INT) AS j, CAST(year(l_shipdate) AS INT) AS yr, CAST(l_linenumber AS INT) AS k, CASE WHEN max(l_discount) <= 0.09 THEN avg(l_quantity) END AS v FROM lineitem GROUP BY ALL)"


def _field(spark, d):
    t = table(spark, d, "lineitem")
    f = t.groupBy((F.col("l_suppkey") % 40).cast("int").alias("i"), F.floor(F.col("l_suppkey") / 40).cast("int").alias("j"), F.year("l_shipdate").alias("yr"), F.col("l_linenumber").cast("int").alias("k"))
    return f.agg(F.when(F.max("l_discount") <= 0.09, F.avg("l_quantity")).alias("v"))


@query("j5_tiled_weights", "WITH " + FIELD + """, g AS (SELECT *, (1 + (i + j) % 3) / 9.0::DOUBLE AS w, CAST(i // 3 AS INT) AS di, CAST(j // 3 AS INT) AS dj FROM f
UNION ALL SELECT *, 0.25::DOUBLE, CAST((i + 1) // 3 AS INT), CAST(j // 3 AS INT) FROM f)
SELECT yr, k, di, dj, CASE WHEN sum(CASE WHEN v IS NOT NULL THEN w ELSE 0 END) > 0.3 THEN round(sum(v * w) / sum(CASE WHEN v IS NOT NULL THEN w ELSE 0 END), 6) END AS v, round(sum(CASE WHEN v IS NOT NULL THEN w ELSE 0 END), 6) AS covered FROM g GROUP BY yr, k, di, dj""")
def j5_tiled(spark, d):
    """Many times and levels by weights that overlap: cells packed by tile."""
    f = tiles.by_tile(_field(spark, d))
    places = f.select("i", "j").distinct()
    more = places.select("i", "j", F.floor((F.col("i") + 1) / 3).cast("int").alias("di"), F.floor(F.col("j") / 3).cast("int").alias("dj"), F.lit(0.25).alias("w"))
    blocks = tiles.weight_blocks(_weights(places).unionByName(more), ["di", "dj"])
    out = tiles.apply_blocks(tiles.packed(f, ["yr", "k"], ["v"], "yr"), blocks, ["di", "dj"], ["yr", "k"], "v", 0.3, "covered")
    return out.select("yr", "k", "di", "dj", F.round("v", 6).alias("v"), F.round("covered", 6).alias("covered"))


@query("j6_renormalize_by_fraction", sql("cells", ", a AS (SELECT zone, avg(v * ice_frac) AS x, avg(ice_frac) AS f FROM cells GROUP BY 1) SELECT zone, CASE WHEN f > 0.18 THEN round(x / f, 5) END AS x FROM a"))
def j6(spark, d):
    a = cells(spark, d).groupBy("zone").agg(F.avg(F.col("v") * F.col("ice_frac")).alias("x"), F.avg("ice_frac").alias("f"))
    return R.renormalize_by(a, {"x": "f"}, 0.18).select("zone", F.round("x", 5).alias("x"))


@query("j9_nearest_regrid", "WITH p AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings) SELECT vec_id, CASE WHEN k BETWEEN 0 AND 20 THEN k END AS k FROM (SELECT vec_id, CAST(round((x - (-1)) / 0.1) AS INT) AS k FROM p)")
def j9(spark, d):
    e = table(spark, d, "embeddings")
    return e.select("vec_id", R.nearest_regular(F.element_at("embedding", 1).cast("double"), -1.0, 0.1, 21).alias("k"))


@query("j10_linear_mask", sql("cells", """, p AS (SELECT vec_id, 20 + 40 * embedding[1]::DOUBLE AS fx, 18 + 30 * embedding[2]::DOUBLE AS fy FROM embeddings),
q AS (SELECT *, least(floor(fx), 38) AS i0, least(floor(fy), 35) AS j0 FROM p WHERE fx BETWEEN 0 AND 39 AND fy BETWEEN 0 AND 36),
c4 AS (SELECT vec_id, CAST(i0 + a AS INT) AS i, CAST(j0 + b AS INT) AS j, (CASE a WHEN 1 THEN fx - i0 ELSE 1 - (fx - i0) END) * (CASE b WHEN 1 THEN fy - j0 ELSE 1 - (fy - j0) END) AS w FROM q, (VALUES (0), (1)) s(a), (VALUES (0), (1)) t(b))
SELECT vec_id, CASE WHEN round(sum(ice_frac * w), 9) > 0.5 THEN 1 ELSE 0 END AS m FROM c4 JOIN cells USING (i, j) GROUP BY 1"""))
def j10(spark, d):
    p = table(spark, d, "embeddings").select("vec_id", (20 + 40 * F.element_at("embedding", 1).cast("double")).alias("x"), (18 + 30 * F.element_at("embedding", 2).cast("double")).alias("y"))
    w = R.bilinear_weights(p, "x", "y", 0.0, 0.0, 1.0, 1.0, 40, 37, ["vec_id"])
    out = R.apply_weights(cells(spark, d).select("i", "j", "ice_frac"), w, ["i", "j"], ["vec_id"], "ice_frac")
    return out.select("vec_id", F.when(F.round("ice_frac", 9) > 0.5, 1).otherwise(0).alias("m"))


@query("j11_nearest_cell", sql("cells", ", s AS (SELECT s_suppkey, (s_acctbal % 37)::DOUBLE AS lat, (s_suppkey * 7 % 40)::DOUBLE AS lon FROM supplier) SELECT s_suppkey, zone FROM (SELECT s_suppkey, zone, row_number() OVER (PARTITION BY s_suppkey ORDER BY abs(j - lat) + abs(i - lon), j, i) AS n FROM s, cells) WHERE n = 1"))
def j11(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", (F.col("s_acctbal") % 37).alias("lat"), (F.col("s_suppkey") * 7 % 40).cast("double").alias("lon"))
    c = cells(spark, d).select(F.col("j").alias("lat"), F.col("i").alias("lon"), "i", "j", "zone")
    c = c.withColumns({"la": F.col("lat"), "lo": F.col("lon")}).select("i", "j", "zone", "la", "lo")
    points = s.withColumnsRenamed({"lat": "la", "lon": "lo"})
    return R.nearest_point(c, points, "s_suppkey", "la", "lo", "zone", ["j", "i"])


POLYGONS = [(1, [(-0.3, -0.3), (0.2, -0.3), (0.2, 0.1), (-0.3, 0.1)]), (2, [(0.0, -0.1), (0.4, 0.1), (0.1, 0.4)])]


def _inside(ring) -> str:
    out = []
    for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]], strict=True):
        if ay != by:
            out.append(f"CASE WHEN ({ay}::DOUBLE > y) <> ({by}::DOUBLE > y) AND x < {ax}::DOUBLE + (y - {ay}::DOUBLE) * {(bx - ax) / (by - ay)!r}::DOUBLE THEN 1 ELSE 0 END")
    return "(" + " + ".join(out) + ") % 2 = 1"


@query("j13_point_in_polygon", f"WITH p AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings) SELECT vec_id, CASE WHEN {_inside(POLYGONS[1][1])} THEN 2 WHEN {_inside(POLYGONS[0][1])} THEN 1 END AS label FROM p")
def j13(spark, d):
    p = table(spark, d, "embeddings").select("vec_id", F.element_at("embedding", 1).cast("double").alias("x"), F.element_at("embedding", 2).cast("double").alias("y"))
    return R.point_in_polygon(p, "x", "y", ["vec_id"], POLYGONS, band=0.05)


#: Rings of 24 vertices about points, one polygon per nation: the later one wins.
RINGS = """WITH v AS (SELECT n_nationkey AS poly, CAST(k AS INT) AS k, round((n_nationkey % 5) / 5.0 - 0.4 + (0.1 + 0.01 * n_nationkey) * cos(2 * pi() * k / 24), 9) AS x, round((n_nationkey // 5) / 5.0 - 0.4 + (0.1 + 0.01 * n_nationkey) * sin(2 * pi() * k / 24), 9) AS y FROM nation, range(0, 24) t(k)),
e AS (SELECT a.poly, a.x AS ax, a.y AS ay, b.x AS cx, b.y AS cy FROM v a JOIN v b ON b.poly = a.poly AND b.k = (a.k + 1) % 24),
p AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings),
c AS (SELECT vec_id, poly FROM p, e WHERE ay <> cy AND (ay > y) <> (cy > y) AND x < ax + (y - ay) * (cx - ax) / (cy - ay) GROUP BY 1, 2 HAVING count(*) % 2 = 1)
SELECT p.vec_id, max(poly) AS label FROM p LEFT JOIN c USING (vec_id) GROUP BY 1"""


def _rings(spark, d):
    n, turn = F.col("n_nationkey"), F.col("k") * (2 * math.pi / 24)
    v = table(spark, d, "nation").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(23))))
    far = 0.1 + 0.01 * n
    v = v.select(n.alias("poly"), "k", F.round(n % 5 / 5.0 - 0.4 + far * F.cos(turn), 9).alias("x"), F.round(F.floor(n / 5) / 5.0 - 0.4 + far * F.sin(turn), 9).alias("y"))
    return v


@query("j13_polygon_table", RINGS)
def j13_table(spark, d):
    v = _rings(spark, d)
    p = table(spark, d, "embeddings").select("vec_id", F.element_at("embedding", 1).cast("double").alias("x"), F.element_at("embedding", 2).cast("double").alias("y"))
    return R.points_in_polygons(p, "x", "y", ["vec_id"], R.polygon_edges(v, "poly", "k", "x", "y"), "poly", 0.05)


@query("j13_hierarchical_cover", RINGS)
def j13_cover(spark, d):
    """The same by cells that hold few edges each."""
    p = table(spark, d, "embeddings").select("vec_id", F.element_at("embedding", 1).cast("double").alias("x"), F.element_at("embedding", 2).cast("double").alias("y"))
    return cover.points_by_cover(p, "x", "y", ["vec_id"], R.polygon_edges(_rings(spark, d), "poly", "k", "x", "y", level=True), "poly")


@query("j17_periodic_wrap", sql("cells", "SELECT i, j, i * 9.0::DOUBLE AS lon, v FROM cells UNION ALL SELECT 40, j, 360, v FROM cells WHERE i = 0"))
def j17(spark, d):
    c = cells(spark, d).select("i", "j", (F.col("i") * 9.0).alias("lon"), "v")
    return R.periodic_wrap(c, "i", "lon", 40)


#: All customers on a square grid of the polar extent, as fine as they are many.
SQUARE = """n AS (SELECT CAST(ceil(sqrt(max(c_custkey) + 1)) AS INT) AS n FROM customer),
g AS (SELECT CAST(c_custkey % n AS INT) AS i, CAST(c_custkey // n AS INT) AS j, c_acctbal AS v, 6080000.0::DOUBLE / (n - 1) AS dx FROM customer, n)"""


def _square(spark, d):
    c = table(spark, d, "customer")
    n = math.ceil(math.sqrt(c.agg(F.max("c_custkey")).first()[0] + 1))
    key = F.col("c_custkey")
    return c.select((key % n).cast("int").alias("i"), F.floor(key / n).cast("int").alias("j"), F.col("c_acctbal").alias("v")), 6080000.0 / (n - 1)


@query("s11_grid_cells", "WITH " + SQUARE + " SELECT i, j, round(i * dx - 3040000, 6) AS x, round(j * dx - 3040000, 6) AS y, v FROM g")
def s11(spark, d):
    c, dx = _square(spark, d)
    g = R.grid_cells(spark, dx)
    return c.join(g.select("i", "j", F.round("x", 6).alias("x"), F.round("y", 6).alias("y")), ["i", "j"])


#: The closed form with WGS 84 and the standard parallel -71.
LAT_LON = "WITH " + SQUARE + """, q AS (SELECT 6378137.0::DOUBLE AS a, sqrt(2 / 298.257223563::DOUBLE - pow(1 / 298.257223563::DOUBLE, 2)) AS e, radians(71.0::DOUBLE) AS p),
z AS (SELECT e, a * cos(p) / sqrt(1 - pow(e * sin(p), 2)) / (tan(pi() / 4 - p / 2) / pow((1 - e * sin(p)) / (1 + e * sin(p)), e / 2)) AS scale FROM q),
x AS (SELECT i, j, v, e, i * dx - 3040000 AS x, j * dx - 3040000 AS y, scale FROM g, z),
h AS (SELECT *, pi() / 2 - 2 * atan(sqrt(x * x + y * y) / scale) AS chi FROM x)
SELECT i, j, v, round(-degrees(chi + (pow(e, 2) / 2 + 5 * pow(e, 4) / 24 + pow(e, 6) / 12 + 13 * pow(e, 8) / 360) * sin(2 * chi) + (7 * pow(e, 4) / 48 + 29 * pow(e, 6) / 240 + 811 * pow(e, 8) / 11520) * sin(4 * chi)
  + (7 * pow(e, 6) / 120 + 81 * pow(e, 8) / 1120) * sin(6 * chi) + 4279 * pow(e, 8) / 161280 * sin(8 * chi)), 8) AS lat, round(CASE WHEN degrees(atan2(x, y)) >= 180 THEN degrees(atan2(x, y)) - 360 ELSE degrees(atan2(x, y)) END, 8) AS lon FROM h"""


@query("s12_lat_lon", LAT_LON)
def s12(spark, d):
    c, dx = _square(spark, d)
    g = R.with_lat_lon(R.grid_cells(spark, dx))
    g = g.select("i", "j", F.round("lat", 8).alias("lat"), F.round("lon", 8).alias("lon"))
    return c.join(g, ["i", "j"])


@query("b9_remap_pipeline", """WITH """ + FIELD + """,
u AS (SELECT i, j, k, arg_min(v IS NOT NULL, yr) AS ok FROM f GROUP BY ALL),
m AS (SELECT f.i, f.j, f.yr, f.k, CASE WHEN ok THEN v END AS v FROM f JOIN u USING (i, j, k)),
w AS (SELECT * FROM (VALUES (1, 1, 0.5::DOUBLE), (1, 2, 0.5), (2, 3, 1.0), (3, 5, 0.5), (3, 6, 0.5)) t(dst, k, w)),
z AS (SELECT i, j, yr, dst AS k, CASE WHEN sum(CASE WHEN v IS NOT NULL THEN w ELSE 0 END) > 1e-3 THEN sum(coalesce(v, 0) * w) / sum(CASE WHEN v IS NOT NULL THEN w ELSE 0 END) END AS v FROM m JOIN w USING (k) GROUP BY i, j, yr, dst),
p AS (SELECT i, j, yr, k, v FROM z UNION ALL SELECT 40, j, yr, k, v FROM z WHERE i = 0 AND EXISTS (SELECT 1 FROM z WHERE i = 39)),
h AS (SELECT *, (1 + (i + j) % 3) / 9.0::DOUBLE AS w FROM p)
SELECT yr, k, CAST(i // 3 AS INT) AS i, CAST(j // 3 AS INT) AS j, (i // 3) * 24000.0::DOUBLE AS x, (j // 3) * 24000.0::DOUBLE AS y,
  CASE WHEN sum(CASE WHEN v IS NOT NULL THEN w ELSE 0 END) > 1e-3 THEN round(sum(v * w) / sum(CASE WHEN v IS NOT NULL THEN w ELSE 0 END), 6) END AS v, round(sum(CASE WHEN v IS NOT NULL THEN w ELSE 0 END), 6) AS valid FROM h GROUP BY yr, k, i // 3, j // 3""")
def b9(spark, d):
    f = _field(spark, d).withColumn("lon", F.col("i") * 9.0)
    places = f.select("i", "j").distinct()
    weights = _weights(places.unionByName(places.where("i = 0").withColumn("i", F.lit(40))))
    grid = weights.select(F.col("di").alias("i"), F.col("dj").alias("j")).distinct().withColumns({"x": F.col("i") * 24000.0, "y": F.col("j") * 24000.0})
    out = scenarios.remap(f, "yr", "k", "v", [10.0 * k for k in range(1, 8)], [15.0, 30.0, 55.0], weights, ["di", "dj"], 40, grid)
    return out.select("yr", "k", "i", "j", "x", "y", F.round("v", 6).alias("v"), F.round("valid", 6).alias("valid"))
