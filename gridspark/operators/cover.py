"""Points in polygons by a hierarchical cover of the plane.

Each polygon is covered by square cells, split in four where many of its edges
meet, until a cell holds few edges or none. A cell keeps the edges that touch it
and whether its centre is inside. A point is inside if its cell's centre is,
but for what the cell's own edges change between the two: for each edge the
difference of the ray tests, and of the heights of its ends to the right of the
cell. Edges that don't touch the cell cancel out, as polygons are closed. So a
point meets the few edges of one cell per polygon, however many edges lie in its
row and however crowded the row is with points.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.sources.bounded import join_bounded
from gridspark.sources.staging import written

EDGE = ("ax", "ay", "bx", "by")
#: Edges of a cell beyond which it is split, and how often at most: more edges
#: than that meet in a point.
MOST_EDGES, DEPTH = 8, 24


def right_of(x: Column, y: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Whether a ray to the right from (x, y) meets the edge."""
    spans = (ay > y) != (by > y)
    return F.when(spans, x < ax + (y - ay) * (bx - ax) / (by - ay)).otherwise(False)


def _changes(x: Column, y: Column, rx: Column, ry: Column, side: Column, e: Column) -> Column:
    """0 or 1: what an edge changes between (rx, ry) and (x, y), both in a cell
    whose right side is at `side`."""
    ax, ay, bx, by = (e[c] for c in EDGE)
    ends = [F.when(v > side, (h > y) != (h > ry)).otherwise(False) for v, h in ((ax, ay), (bx, by))]
    rays = right_of(x, y, ax, ay, bx, by) != right_of(rx, ry, ax, ay, bx, by)
    return ((rays != ends[0]) != ends[1]).cast("int")


def _touches(size: float) -> Column:
    """Whether an edge may touch its closed cell (cx, cy): boxes overlap, and not
    all corners are clearly on one side of it."""
    x0, y0 = F.col("cx") * size, F.col("cy") * size
    box = (F.greatest("ax", "bx") >= x0) & (F.least("ax", "bx") <= x0 + size) & (F.greatest("ay", "by") >= y0) & (F.least("ay", "by") <= y0 + size)
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    turns = [dx * (y0 + b - F.col("ay")) - dy * (x0 + a - F.col("ax")) for a in (0.0, size) for b in (0.0, size)]
    near = 1e-9 * (F.abs(dx) + F.abs(dy)) * (F.abs(x0) + F.abs(y0) + F.abs("ax") + F.abs("ay") + size)
    return box & (F.least(*turns) <= near) & (F.greatest(*turns) >= -near)


def cover(edges: DataFrame, polygon: str, most: int = MOST_EDGES, depth: int = DEPTH) -> tuple[DataFrame, list[float]]:
    """(polygon, level, cx, cy, inside, edges): cells that have edges or lie
    inside, and the size of each level's cells, powers of two, so that which cell
    a point is in is exact. edges: (polygon, ax, ay, bx, by) of closed rings,
    level ones too. Edges are rows until their cell is done, so that no row holds
    a polygon. Each level is written; the driver sees whether a cell is left to
    split."""
    ends = edges.agg(*[f(F.expr(f"{g}({c}x, {d}x)")).alias("x" + n) for n, f, g, c, d in (("a", F.min, "least", "a", "b"), ("b", F.max, "greatest", "a", "b"))], *[f(F.expr(f"{g}(ay, by)")).alias("y" + n) for n, f, g in (("a", F.min, "least"), ("b", F.max, "greatest"))]).first()
    spark = edges.sparkSession
    kind = dict(edges.dtypes)[polygon]
    if ends.xa is None:
        return spark.createDataFrame([], f"{polygon} {kind}, level int, cx long, cy long, inside int, edges array<struct<ax: double, ay: double, bx: double, by: double>>"), []
    size = 2.0 ** math.ceil(math.log2(max(ends.xb - ends.xa, ends.yb - ends.ya, 1e-300)))
    sizes, parts = [size], []
    e = F.struct(*[F.col(c).alias(c) for c in EDGE])
    cell = [polygon, "cx", "cy"]
    # an edge that begins at a cell's side touches the cell before, too
    corner = [F.explode(F.sequence(F.ceil(F.least(f"a{c}", f"b{c}") / size) - 1, F.floor(F.greatest(f"a{c}", f"b{c}") / size))).alias(f"c{c}") for c in "xy"]
    plain = edges.select(polygon, *[F.col(c).cast("double").alias(c) for c in EDGE])
    rows = written(plain.select("*", corner[0]).select("*", corner[1]).where(_touches(size)), "cover-edges")
    # centres of the first cells, a few of each polygon, against all its edges
    x, y = ((F.col(c) + 0.5) * size for c in ("cx", "cy"))
    starts = rows.groupBy(*cell).agg(F.count("*").alias("n"))
    odd = starts.select(*cell).join(plain, polygon).groupBy(*cell).agg((F.sum(right_of(x, y, *map(F.col, EDGE)).cast("int")) % 2).cast("int").alias("inside"))
    cells = written(starts.join(odd, cell), "cover")
    for level in range(depth + 1):
        split = cells.where(F.col("n") > most) if level < depth else cells.limit(0)
        done = cells.where((F.col("n") <= most) & ((F.col("inside") == 1) | (F.col("n") > 0))) if level < depth else cells
        own = rows.join(done.where("n > 0").select(*cell), cell, "left_semi").groupBy(*cell).agg(F.collect_list(e).alias("edges"))
        parts.append(done.join(own, cell, "left").select(polygon, F.lit(level).alias("level"), "cx", "cy", "inside", F.coalesce("edges", F.array().cast(own.schema["edges"].dataType)).alias("edges")))
        if split.isEmpty():
            break
        four = F.explode(F.array(*[F.struct((2 * F.col("cx") + a).alias("cx"), (2 * F.col("cy") + b).alias("cy")) for a in (0, 1) for b in (0, 1)])).alias("child")
        child = rows.join(split.select(*cell, "inside"), cell).select("*", four)
        to = [(F.col(f"child.{c}") + 0.5) * (size / 2) for c in ("cx", "cy")]
        change = _changes(to[0], to[1], (F.col("cx") + 0.5) * size, (F.col("cy") + 0.5) * size, (F.col("cx") + 1) * size, {c: F.col(c) for c in EDGE})
        child = child.select(polygon, "child.cx", "child.cy", "inside", change.alias("change"), *EDGE)
        size /= 2
        sizes.append(size)
        child = written(child.withColumn("touch", _touches(size)), "cover-edges")
        cells = child.groupBy(*cell).agg(F.sum(F.col("touch").cast("long")).alias("n"), ((F.first("inside") + F.sum("change")) % 2).cast("int").alias("inside"))
        cells = written(cells, "cover")
        rows = child.where("touch").select(*cell, *EDGE)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out, sizes


def points_by_cover(points: DataFrame, x: str, y: str, key: Sequence[str], edges: DataFrame, polygon: str, most: int = MOST_EDGES, depth: int = DEPTH) -> DataFrame:
    """(key, label): the last polygon in order that holds each point, null if none;
    points_in_polygons() for any number of edges in a row of the plane. A point is
    looked up once per level and tests the edges of one cell of each polygon.
    Null coordinates are in no polygon."""
    cells, sizes = cover(edges, polygon, most, depth)
    p = points.select(*key, F.col(x).cast("double").alias("__x"), F.col(y).cast("double").alias("__y"))
    levels = F.array(*[F.struct(F.lit(k).alias("level"), F.floor(F.col("__x") / s).alias("cx"), F.floor(F.col("__y") / s).alias("cy"), F.lit(s).alias("s")) for k, s in enumerate(sizes)])
    if not sizes:
        return points.select(*key, F.lit(None).cast(dict(edges.dtypes)[polygon]).alias("label"))
    p = p.where("__x is not null and __y is not null").withColumn("__l", F.explode(levels)).select(*key, "__x", "__y", "__l.level", "__l.cx", "__l.cy", "__l.s")
    met = join_bounded(p, written(cells, "cover-cells"), ["level", "cx", "cy"])
    centre = [(F.col(c) + 0.5) * F.col("s") for c in ("cx", "cy")]
    odd = F.aggregate("edges", F.col("inside"), lambda n, e: n + _changes(F.col("__x"), F.col("__y"), centre[0], centre[1], (F.col("cx") + 1) * F.col("s"), e)) % 2
    inside = met.where(odd == 1).groupBy(*key).agg(F.max(polygon).alias("label"))
    return points.select(*key).join(inside, list(key), "left")
