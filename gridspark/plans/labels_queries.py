"""Label maps and neighbourhoods."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridspark.operators import labels as L
from gridspark.plans.registry import query
from gridspark.plans.views import cells, ensemble, label_grid, sql

#: Components by the least cell number reached, as recursion over neighbours.
COMP = """, g AS (SELECT i, j, label, j * 1048576 + i AS id FROM label_grid WHERE label >= 0),
e AS (SELECT a.id AS a, b.id AS b FROM g a JOIN g b ON a.label = b.label AND abs(a.i - b.i) + abs(a.j - b.j) = 1),
r(id, root) AS (SELECT id, id FROM g UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id AND r.root < e.b),
c AS (SELECT g.i, g.j, g.label, CAST(min(r.root) AS BIGINT) AS component FROM r JOIN g USING (id) GROUP BY 1, 2, 3)"""


def _labelled(spark, d):
    return label_grid(spark, d).where("label >= 0")


@query("w16_label_runs", sql("label_grid", ", g AS (SELECT *, i - row_number() OVER (PARTITION BY j, label ORDER BY i) AS k FROM label_grid) SELECT j, label, min(i) AS i_first, max(i) AS i_last FROM g GROUP BY j, label, k"))
def w16(spark, d):
    return L.runs(label_grid(spark, d), "label")


@query("w17_uniform_spacing", sql("cells", ", x AS (SELECT DISTINCT i FROM cells), s AS (SELECT lead(i) OVER (ORDER BY i) - i AS s FROM x) SELECT count(s) AS n_steps, avg(s) AS step, max(s) - avg(s) <= 1e-6 AND avg(s) - min(s) <= 1e-6 AS uniform FROM s"))
def w17(spark, d):
    return L.uniform_spacing(cells(spark, d), "i")


@query("w18_wrap_autocorrelation", sql("cells", "SELECT CAST(lag AS INT) AS lag, round(sum(a.v * b.v), 2) AS correlation FROM cells a, range(0, 11) l(lag), cells b WHERE b.j = a.j AND b.i = (a.i + lag) % 40 GROUP BY 1"))
def w18(spark, d):
    return L.autocorrelation(cells(spark, d), "v", 40, 10).select("lag", F.round("correlation", 2).alias("correlation"))


@query("w14_slopes", sql("cells", ", n AS (SELECT i, j, v, lag(v) OVER x AS a, lead(v) OVER x AS b, lag(v) OVER y AS c, lead(v) OVER y AS d FROM cells WINDOW x AS (PARTITION BY j ORDER BY i), y AS (PARTITION BY i ORDER BY j)), s AS (SELECT i, j, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN (b - a) / 16000 WHEN b IS NOT NULL THEN (b - v) / 8000 ELSE (v - a) / 8000 END AS x, CASE WHEN c IS NOT NULL AND d IS NOT NULL THEN (d - c) / 16000 WHEN d IS NOT NULL THEN (d - v) / 8000 ELSE (v - c) / 8000 END AS y FROM n) SELECT i, j, round(atan(sqrt(x * x + y * y)), 9) AS slope FROM s"))
def w14(spark, d):
    return L.slopes(cells(spark, d), "v", 8000.0).select("i", "j", F.round("slope", 9).alias("slope"))


@query("i3_components", sql("label_grid", COMP + " SELECT i, j, label, component FROM c"))
def i3(spark, d):
    return L.components(_labelled(spark, d), "label").select("i", "j", "label", "component")


@query("i3_largest_component", sql("label_grid", COMP + ", n AS (SELECT label, component, row_number() OVER (PARTITION BY label ORDER BY count(*) DESC, component) AS k FROM c GROUP BY 1, 2) SELECT i, j, label, component FROM c JOIN n USING (label, component) WHERE k = 1"))
def i3_largest(spark, d):
    return L.largest_component(_labelled(spark, d), "label").select("i", "j", "label", "component")


@query("a32_component_stats", sql("label_grid", COMP + ", n AS (SELECT label, component, count(*) AS n FROM c GROUP BY 1, 2) SELECT label, count(*) AS n_components, max(n) AS largest, CAST(sum(n) - max(n) AS BIGINT) AS islands FROM n GROUP BY 1"))
def a32(spark, d):
    return L.component_stats(_labelled(spark, d), "label")


@query("i4_contiguity_repair")
def i4(spark, d):
    """Blocks of labels with strewn cells of the next block's label."""
    g = cells(spark, d)
    block = F.floor(F.col("i") / 10).cast("int") + 4 * F.floor(F.col("j") / 10).cast("int")
    g = g.select("i", "j", F.when(F.col("v") < -500, block + 1).otherwise(block).alias("label"))
    return L.make_contiguous(g, "label")


NEAREST = ", s AS (SELECT i, j, label FROM label_grid WHERE label >= 0), q AS (SELECT a.i, a.j, s.label, row_number() OVER (PARTITION BY a.i, a.j ORDER BY pow(a.i - s.i, 2) + pow(a.j - s.j, 2), s.j, s.i) AS n FROM label_grid a, s WHERE a.label < 0)"


@query("i5_extend_nearest", sql("label_grid", NEAREST + " SELECT a.i, a.j, CASE WHEN a.label >= 0 THEN a.label ELSE coalesce(q.label, -1) END AS label FROM label_grid a LEFT JOIN q ON q.i = a.i AND q.j = a.j AND q.n = 1"))
def i5(spark, d):
    return L.extend_nearest(label_grid(spark, d), "label")


#: Components by recursion over four neighbours of the cells of a table `m`.
PARTS = """, m AS ({cells}), g AS (SELECT i, j, j * 1048576 + i AS id FROM m),
e AS (SELECT a.id AS a, b.id AS b FROM g a JOIN g b ON abs(a.i - b.i) + abs(a.j - b.j) = 1),
r(id, root) AS (SELECT id, id FROM g UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id AND r.root < e.b),
c AS (SELECT g.i, g.j, min(r.root) AS component FROM r JOIN g USING (id) GROUP BY 1, 2)"""


@query("i6_shelf_selection", sql("cells", PARTS.format(cells="SELECT i, j FROM cells WHERE v > 2000") + " SELECT i, j FROM c WHERE component IN (SELECT component FROM c a JOIN cells s ON s.zone = 3 AND s.v > 9000 AND abs(a.i - s.i) <= 3 AND abs(a.j - s.j) <= 3)"))
def i6(spark, d):
    c = cells(spark, d)
    return L.select_shelf(c.withColumn("shelf", F.col("v") > 2000), c.where("zone = 3 and v > 9000"), "shelf", reach=3)


@query("i7_shelf_break", sql("cells", "SELECT DISTINCT a.i, a.j FROM cells a JOIN cells b ON abs(a.i - b.i) <= 1 AND abs(a.j - b.j) <= 1 WHERE a.v <= 5000 AND b.v > 9000"))
def i7(spark, d):
    c = cells(spark, d)
    return L.shelf_break(c.where("v <= 5000"), c.where("v > 9000"))


@query("i8_extrude_labels", sql("cells", ", s AS (SELECT i, j, zone AS label FROM cells WHERE v > 8000), q AS (SELECT a.i, a.j, s.label, row_number() OVER (PARTITION BY a.i, a.j ORDER BY pow(a.i - s.i, 2) + pow(a.j - s.j, 2), s.j, s.i) AS n FROM cells a, s) SELECT i, j, label FROM q WHERE n = 1"))
def i8(spark, d):
    c = cells(spark, d)
    return L.extrude_labels(c, c.where("v > 8000").select("i", "j", F.col("zone").alias("label")), "label")


@query("i9_fill_between_walls", sql("label_grid", PARTS.format(cells="SELECT i, j FROM label_grid WHERE label < 0 AND i % 7 <> 3") + """,
q AS (SELECT component, n.label, row_number() OVER (PARTITION BY component ORDER BY count(*) DESC, n.label) AS k FROM c JOIN label_grid n ON n.label >= 0 AND abs(c.i - n.i) + abs(c.j - n.j) = 1 GROUP BY 1, 2)
SELECT l.i, l.j, coalesce(q.label, l.label) AS label FROM label_grid l LEFT JOIN c USING (i, j) LEFT JOIN q ON q.component = c.component AND q.k = 1"""))
def i9(spark, d):
    g = label_grid(spark, d)
    return L.fill_bounded(g.withColumn("wall", (F.col("i") % 7 == 3) & (F.col("label") < 0)), "label", "wall")


@query("i13_triple_points", sql("label_grid", ", b AS (SELECT a.i, a.j, count(*) AS n, count(DISTINCT CASE WHEN b.label >= 0 THEN b.label END) AS l, min(CASE WHEN b.label >= 0 THEN b.label END) AS low, max(CASE WHEN b.label >= 0 THEN b.label END) AS high, count(*) FILTER (b.label < 0) AS f FROM (SELECT i, j FROM label_grid UNION SELECT i - 1, j FROM label_grid UNION SELECT i, j - 1 FROM label_grid) a JOIN label_grid b ON b.i - a.i IN (0, 1) AND b.j - a.j IN (0, 1) GROUP BY 1, 2) SELECT i, j, low, high FROM b WHERE n = 4 AND l = 2 AND f >= 1"))
def i13(spark, d):
    return L.triple_points(label_grid(spark, d), "label")


TRIPLES = ", b AS (SELECT a.i, a.j, count(*) AS n, count(DISTINCT CASE WHEN b.label >= 0 THEN b.label END) AS l, min(CASE WHEN b.label >= 0 THEN b.label END) AS low, max(CASE WHEN b.label >= 0 THEN b.label END) AS high, count(*) FILTER (b.label < 0) AS f FROM (SELECT i, j FROM label_grid UNION SELECT i - 1, j FROM label_grid UNION SELECT i, j - 1 FROM label_grid) a JOIN label_grid b ON b.i - a.i IN (0, 1) AND b.j - a.j IN (0, 1) GROUP BY 1, 2), t AS (SELECT i, j, low, high FROM b WHERE n = 4 AND l = 2 AND f >= 1), d AS (SELECT t.*, c.i AS break_i, c.j AS break_j, sqrt(pow(c.i - t.i - 0.5, 2) + pow(c.j - t.j - 0.5, 2)) AS distance FROM t, cells c WHERE c.v > 8000), x AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY i, j ORDER BY distance, break_j, break_i) AS k FROM d) WHERE k = 1)"


def _triples(spark, d):
    return L.nearest_to_triples(L.triple_points(label_grid(spark, d), "label"), cells(spark, d).where("v > 8000").select("i", "j"))


@query("i13_nearest_break", sql("label_grid cells", TRIPLES + " SELECT i, j, low, high, break_i, break_j, round(distance, 9) AS distance FROM x"))
def i13_nearest(spark, d):
    return _triples(spark, d).withColumn("distance", F.round("distance", 9))


@query("i13_best_per_pair", sql("label_grid cells", TRIPLES + " SELECT low, high, i, j, break_i, break_j, round(distance, 9) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY low, high ORDER BY round(distance, 9), j, i) AS q FROM x) WHERE q = 1"))
def i13_best(spark, d):
    return L.best_per_pair(_triples(spark, d))


@query("i14_label_validation", sql("label_grid", COMP + ", n AS (SELECT label, count(DISTINCT component) AS n FROM c GROUP BY 1) SELECT CAST(x AS INT) AS label, coalesce(n, 0) AS n_components FROM range(0, 20) t(x) LEFT JOIN n ON label = x WHERE coalesce(n, 0) <> 1"))
def i14(spark, d):
    return L.validate_labels(label_grid(spark, d), "label", list(range(20)))


@query("t7_local_maxima", sql("ensemble", ", h AS (SELECT p1 AS i, zone AS j, count(*) AS n FROM ensemble GROUP BY 1, 2) SELECT a.i, a.j, a.n FROM h a WHERE a.n >= 2 AND NOT EXISTS (SELECT 1 FROM h b WHERE abs(a.i - b.i) <= 1 AND abs(a.j - b.j) <= 1 AND b.n > a.n)"))
def t7(spark, d):
    h = ensemble(spark, d).groupBy(F.col("p1").alias("i"), F.col("zone").alias("j")).agg(F.count("*").alias("n"))
    return L.local_maxima(h, "n", 2)


@query("t7_peaks", sql("ensemble", ", h AS (SELECT p1 AS i, count(*) AS n FROM ensemble GROUP BY 1) SELECT a.i, a.n FROM h a WHERE a.n >= 2 AND NOT EXISTS (SELECT 1 FROM h b WHERE abs(a.i - b.i) <= 1 AND b.n > a.n)"))
def t7_peaks(spark, d):
    """The same along one axis."""
    h = ensemble(spark, d).groupBy(F.col("p1").alias("i"), F.lit(0).alias("j")).agg(F.count("*").alias("n"))
    return L.local_maxima(h, "n", 2).select("i", "n")


@query("b12_label_pipeline")
def b12(spark, d):
    """From polygons to a label map that covers the grid, one component a label."""
    c = cells(spark, d).withColumns({"x": F.col("i").cast("double"), "y": F.col("j").cast("double")})
    rings = [(k, [(10.2 * k, -0.5), (10.2 * k + 7.5, -0.5), (10.2 * k + 5.5, 9.3), (10.2 * k + 1.5, 7.3)]) for k in range(4)]
    return L.label_cells(c, rings, "x", "y", "v", 6000.0, 3, c.where("i % 9 = 4").select("i", "j"))
