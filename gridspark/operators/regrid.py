"""Sparse-weight regridding, nearest and bilinear lookups, point in polygon,
the polar grid itself."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridspark.sources.bounded import join_bounded
from gridspark.sources.staging import written


def apply_weights(df: DataFrame, weights: DataFrame, src: Sequence[str], dst: Sequence[str], value: str, keys: Sequence[str] = (), renormalize: float | None = None) -> DataFrame:
    """Sum of weight * value by destination; nulls add nothing. renormalize:
    divide by the covered weight where it exceeds this, else null."""
    j = df.join(weights, list(src))
    v = F.col(value)
    out = j.groupBy(*keys, *dst).agg(F.sum(v * F.col("w")).alias("__x"), F.sum(F.when(v.isNotNull(), F.col("w")).otherwise(0.0)).alias("__w"))
    if renormalize is None:
        return out.select(*keys, *dst, F.col("__x").alias(value))
    return out.select(*keys, *dst, F.when(F.col("__w") > renormalize, F.col("__x") / F.col("__w")).alias(value))


def renormalize_by(df: DataFrame, pairs: dict[str, str], threshold: float) -> DataFrame:
    """Divide area-weighted fields by their fractions where these exceed a
    threshold, else null."""
    return df.withColumns({v: F.when(F.col(f) > threshold, F.col(v) / F.col(f)) for v, f in pairs.items()})


def nearest_regular(x: Column, x0: float, dx: float, n: int) -> Column:
    """Index of the nearest point of a regular axis, null beyond its ends."""
    k = F.round((x - x0) / dx).cast("int")
    return F.when(k.between(0, n - 1), k)


def bilinear_weights(target: DataFrame, x: str, y: str, x0: float, y0: float, dx: float, dy: float, nx: int, ny: int, dst: Sequence[str]) -> DataFrame:
    """(dst, i, j, w): four corners for each target point inside a regular grid."""
    fx, fy = (F.col(x) - x0) / dx, (F.col(y) - y0) / dy
    i0, j0 = F.least(F.floor(fx), F.lit(nx - 2)).cast("int"), F.least(F.floor(fy), F.lit(ny - 2)).cast("int")
    inside = target.where((fx >= 0) & (fx <= nx - 1) & (fy >= 0) & (fy <= ny - 1))
    a, b = fx - i0, fy - j0
    corners = [F.struct((i0 + p).alias("i"), (j0 + q).alias("j"), ((a if p else 1 - a) * (b if q else 1 - b)).alias("w")) for p in (0, 1) for q in (0, 1)]
    return inside.select(*dst, F.explode(F.array(*corners)).alias("c")).select(*dst, "c.i", "c.j", "c.w")


def nearest_point(cells: DataFrame, points: DataFrame, point: str, lat: str, lon: str, label: str, order: Sequence[str], width: float = 4.0, metric: str = "sum", distance: str | None = None) -> DataFrame:
    """For each point the label of the cell that is nearest by abs(dlat) +
    abs(dlon) (metric "sum") or in a straight line ("line"), and that distance
    if a name is given; ties by cell order. Points look into the tile they are in and the
    eight around, which is exact within one tile's width; those without a cell
    so near go on with tiles four times as wide, until none is left or a tile is
    wider than all there is."""
    p = points.select(point, F.col(lat).cast("double").alias("__lat"), F.col(lon).cast("double").alias("__lon"))
    c = cells.select(F.col(lat).cast("double").alias(lat), F.col(lon).cast("double").alias(lon), *order, label)
    places = c.select(lat, lon).union(p.select("__lat", "__lon"))
    ends = places.agg(*[f(x).alias(f"{n}{x}") for x in (lat, lon) for n, f in (("a", F.min), ("b", F.max))]).first()
    across = sum((ends[f"b{x}"] or 0.0) - (ends[f"a{x}"] or 0.0) for x in (lat, lon))
    around = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)]))
    dlat, dlon = F.col(lat) - F.col("__lat"), F.col(lon) - F.col("__lon")
    d = F.abs(dlat) + F.abs(dlon) if metric == "sum" else F.sqrt(dlat * dlat + dlon * dlon)
    own = [F.col("s.d").alias(distance)] if distance else []
    found, left = None, p
    while True:
        ask = left.withColumn("__n", around)
        ask = ask.withColumns({f"__{n}": F.floor(F.col(x) / width) + F.col(f"__n.{n}") for n, x in (("a", "__lat"), ("b", "__lon"))})
        source = c.withColumns({f"__{n}": F.floor(F.col(x) / width) for n, x in (("a", lat), ("b", lon))})
        # the least distance alone is summed up without sorting all pairs; only ties are sorted
        least = written(ask.join(source, ["__a", "__b"]).groupBy(point).agg(F.min(d).alias("__d")).where(F.col("__d") <= width), "nearest-least")
        least = least.withColumnRenamed(point, "__p")
        ties = ask.join(least, F.col(point).eqNullSafe(F.col("__p"))).join(source, ["__a", "__b"]).where(d == F.col("__d"))
        got = ties.groupBy(point).agg(F.min(F.struct(d.alias("d"), *order, label)).alias("s"))
        got = written(got.select(point, F.col(f"s.{label}").alias(label), *own), "nearest-found")
        found = got if found is None else found.unionByName(got)
        if width >= across:
            return found
        left = written(left.join(least, F.col(point).eqNullSafe(F.col("__p")), "left_anti"), "nearest-left")
        if left.isEmpty():
            return found
        width *= 4


def polygon_edges(rings: DataFrame, polygon: str, at: str, x: str, y: str, level: bool = False) -> DataFrame:
    """(polygon, ax, ay, bx, by): the edges of closed rings given as one row per
    vertex, in the order of `at`; level edges, which no ray crosses, are left out
    unless asked for."""
    w = Window.partitionBy(polygon).orderBy(at)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    b = [F.coalesce(F.lead(c).over(w), F.first(c).over(whole)).alias(f"b{n}") for n, c in (("x", x), ("y", y))]
    out = rings.select(polygon, F.col(x).alias("ax"), F.col(y).alias("ay"), *b)
    return out if level else out.where("ay <> by")


def points_in_polygons(points: DataFrame, x: str, y: str, key: Sequence[str], edges: DataFrame, polygon: str, band: float) -> DataFrame:
    """Label (polygon) of the last polygon in order that holds each point, null
    if none: parity of the edges to the right. Points and edges, however many,
    meet in bands of y that are `band` high; an edge is in all bands it spans."""
    low, high = F.least("ay", "by"), F.greatest("ay", "by")
    e = edges.withColumn("__band", F.explode(F.sequence(F.floor(low / band), F.floor(high / band))))
    p = points.select(*key, F.col(x).alias("__x"), F.col(y).alias("__y")).withColumn("__band", F.floor(F.col("__y") / band))
    spans = (F.col("ay") > F.col("__y")) != (F.col("by") > F.col("__y"))
    at = F.col("ax") + (F.col("__y") - F.col("ay")) * (F.col("bx") - F.col("ax")) / (F.col("by") - F.col("ay"))
    hit = join_bounded(p, e, "__band").where(spans & (F.col("__x") < at)).groupBy(*key, polygon).agg(F.count("*").alias("__n"))
    inside = hit.where("__n % 2 = 1").groupBy(*key).agg(F.max(polygon).alias("label"))
    return points.select(*key).join(inside, list(key), "left")


def point_in_polygon(points: DataFrame, x: str, y: str, key: Sequence[str], polygons: Sequence[tuple[int, Sequence[tuple[float, float]]]], band: float = 1.0) -> DataFrame:
    """points_in_polygons with rings given as (label, vertices), the last of the
    list that holds a point winning."""
    rows = [(n, label, k, float(a), float(b)) for n, (label, ring) in enumerate(polygons) for k, (a, b) in enumerate(ring)]
    rings = points.sparkSession.createDataFrame(rows, "n int, label int, k int, x double, y double")
    edges = polygon_edges(rings, "n", "k", "x", "y")
    found = points_in_polygons(points, x, y, key, edges, "n", band).withColumnRenamed("label", "n")
    return join_bounded(found, rings.select("n", "label").distinct(), "n", "left").select(*key, "label")


def has_seam(df: DataFrame, i: str, lon: str, n: int, radians: bool = False, threshold: float = 1e-10) -> bool:
    """Whether both ends of the n longitude columns are there and a turn from the
    first is not the last."""
    turn = 2 * math.pi if radians else 360.0
    ends = df.where(F.col(i).isin(0, n - 1)).agg(F.max(F.when(F.col(i) == 0, F.col(lon))).alias("a"), F.max(F.when(F.col(i) == n - 1, F.col(lon))).alias("b")).first()
    return ends.a is not None and ends.b is not None and abs(ends.a + turn - ends.b) > threshold


def periodic_wrap(df: DataFrame, i: str, lon: str, n: int, radians: bool = False, threshold: float = 1e-10, two_d: bool = False) -> DataFrame:
    """Append the first longitude column once more if the seam has a gap."""
    if not has_seam(df, i, lon, n, radians, threshold):
        return df
    more = df.where(F.col(i) == 0).withColumn(i, F.lit(n).cast(df.schema[i].dataType))
    return df.unionByName(more if two_d else more.withColumn(lon, F.col(lon) + (2 * math.pi if radians else 360.0)))


def grid_cells(spark: SparkSession, dx: float = 8000.0, extent: float = 6080000.0) -> DataFrame:
    """The square polar grid: i, j, x, y and bounds, centred on the pole."""
    n = int(extent / dx + 1e-6) + 1
    g = spark.range(n * n).select((F.col("id") % n).cast("int").alias("i"), F.floor(F.col("id") / n).cast("int").alias("j"))
    x, y = (F.col(c) * dx - extent / 2 for c in "ij")
    return g.select("i", "j", x.alias("x"), y.alias("y"), (x - dx / 2).alias("x_lo"), (x + dx / 2).alias("x_hi"), (y - dx / 2).alias("y_lo"), (y + dx / 2).alias("y_hi"))


def grid_levels(spark: SparkSession, dz: float = 60.0, depth: float = 1800.0) -> DataFrame:
    n = math.ceil(depth / dz)
    k = F.col("id").cast("int")
    return spark.range(n).select(k.alias("k"), (-(k + 0.5) * dz).alias("z"), (-k * dz).cast("double").alias("z_lo"), (-(k + 1) * dz).cast("double").alias("z_hi"))


#: WGS 84 and the standard parallel of the south polar stereographic projection.
A, FLATTENING, PARALLEL = 6378137.0, 1 / 298.257223563, -71.0


def _scale() -> tuple[float, float]:
    e = math.sqrt(2 * FLATTENING - FLATTENING**2)
    p = math.radians(-PARALLEL)
    t = math.tan(math.pi / 4 - p / 2) / ((1 - e * math.sin(p)) / (1 + e * math.sin(p))) ** (e / 2)
    m = math.cos(p) / math.sqrt(1 - (e * math.sin(p)) ** 2)
    return e, A * m / t


def to_lat_lon(x: Column, y: Column) -> tuple[Column, Column]:
    """Inverse south polar stereographic; lon in [-180, 180). The series for the
    latitude is good to 1e-9 degrees."""
    e, scale = _scale()
    t = F.hypot(x, y) / scale
    chi = math.pi / 2 - 2 * F.atan(t)
    e2 = e * e
    c = (
        e2 / 2 + 5 * e2**2 / 24 + e2**3 / 12 + 13 * e2**4 / 360,
        7 * e2**2 / 48 + 29 * e2**3 / 240 + 811 * e2**4 / 11520,
        7 * e2**3 / 120 + 81 * e2**4 / 1120,
        4279 * e2**4 / 161280,
    )
    phi = chi
    for k, v in enumerate(c, 1):
        phi = phi + v * F.sin(chi * (2 * k))
    lon = F.degrees(F.atan2(x, y))
    return -F.degrees(phi), F.pmod(lon + 180, F.lit(360.0)) - 180


def from_lat_lon(lat: Column, lon: Column) -> tuple[Column, Column]:
    """South polar stereographic x and y."""
    e, scale = _scale()
    p = F.radians(-lat)
    s = F.sin(p) * e
    t = F.tan(math.pi / 4 - p / 2) / F.pow((1 - s) / (1 + s), F.lit(e / 2))
    return scale * t * F.sin(F.radians(lon)), scale * t * F.cos(F.radians(lon))


def with_lat_lon(cells: DataFrame) -> DataFrame:
    """Latitude and longitude of centres and of the four corners."""
    lat, lon = to_lat_lon(F.col("x"), F.col("y"))
    corners = []
    for a, b in (("x_lo", "y_lo"), ("x_hi", "y_lo"), ("x_hi", "y_hi"), ("x_lo", "y_hi")):
        p, q = to_lat_lon(F.col(a), F.col(b))
        corners.append(F.struct(p.alias("lat"), q.alias("lon")))
    return cells.withColumns({"lat": lat, "lon": lon, "corners": F.array(*corners)})
