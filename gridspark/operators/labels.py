"""Label maps: runs, components, extension, contiguity, neighbourhoods."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridspark.operators.components import connected_components
from gridspark.operators.fill import fill_nearest
from gridspark.operators.distance import nearest_sources
from gridspark.operators.regrid import point_in_polygon
from gridspark.sources.staging import written

FOUR = ((0, 1), (1, 0), (0, -1), (-1, 0))
EIGHT = (*FOUR, (1, 1), (1, -1), (-1, 1), (-1, -1))


def runs(df: DataFrame, label: str, i: str = "i", j: str = "j") -> DataFrame:
    """Runs of equal labels along rows: j, label, first and last i."""
    w = Window.partitionBy(j, label).orderBy(i)
    g = df.withColumn("__g", F.col(i) - F.row_number().over(w))
    return g.groupBy(j, label, "__g").agg(F.min(i).alias("i_first"), F.max(i).alias("i_last")).drop("__g")


def uniform_spacing(df: DataFrame, coord: str, tolerance: float = 1e-6) -> DataFrame:
    """One row: number of steps, their mean, and whether all are alike."""
    from gridspark.operators.ordering import global_rank

    r = global_rank(df.select(coord).distinct(), [coord], "__n")
    after = r.select((F.col("__n") - 1).alias("__n"), F.col(coord).alias("__next"))
    steps = r.join(after, "__n").select((F.col("__next") - F.col(coord)).alias("s"))
    out = steps.agg(F.count("s").alias("n_steps"), F.avg("s").alias("step"), F.min("s").alias("lo"), F.max("s").alias("hi"))
    even = (F.col("hi") - F.col("step") <= tolerance) & (F.col("step") - F.col("lo") <= tolerance)
    return out.select("n_steps", "step", even.alias("uniform"))


def neighbours(df: DataFrame, offsets: Sequence[tuple[int, int]], columns: Sequence[str], i: str = "i", j: str = "j") -> DataFrame:
    """(i, j, then the columns of each neighbour as n_...): one equi-join on the
    shifted cell, however many offsets."""
    steps = F.explode(F.array(*[F.struct(F.lit(b).alias("di"), F.lit(a).alias("dj")) for a, b in offsets]))
    moved = df.select(i, j, *[F.col(c).alias(f"n_{c}") for c in columns]).withColumn("__s", steps)
    return moved.select((F.col(i) + F.col("__s.di")).cast("int").alias(i), (F.col(j) + F.col("__s.dj")).cast("int").alias(j), *[f"n_{c}" for c in columns])


def _least(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the links (a, b) and of each the smallest one it is linked to."""
    node, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(node))
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (root[root] != root).any():
            root = root[root]
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return node, node[root]


def _joined_in_tiles(links: DataFrame) -> DataFrame:
    """(node, component) of the links (a, ta, b, tb), ta and tb being the tiles of
    their ends: links within a tile are joined in one go, so that only the parts
    that touch a tile's border go through rounds."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        node, root = _least(pdf.a.to_numpy(np.int64), pdf.b.to_numpy(np.int64))
        return pd.DataFrame({"node": node, "root": root})

    links = written(links, "label-links")
    part = written(links.where("ta = tb").select("a", "b", "ta").groupBy("ta").applyInPandas(one, "node long, root long"), "label-parts")
    ends = [part.select(F.col("node").alias(x), F.col("root").alias(f"__{x}")) for x in "ab"]
    across = links.where("ta <> tb").join(ends[0], "a", "left").join(ends[1], "b", "left")
    comp = connected_components(across.select(F.coalesce("__a", "a").alias("a"), F.coalesce("__b", "b").alias("b")), "label-components")
    # a node without links in its tile has none in part
    known = part.join(comp.withColumnRenamed("node", "root"), "root", "left").select("node", F.coalesce("component", "root").alias("component"))
    return known.unionByName(comp.join(part, "node", "left_anti").select("node", "component"))


def components(df: DataFrame, label: str, eight: bool = False, i: str = "i", j: str = "j", width: int = 1 << 20, tile: int = 512) -> DataFrame:
    """df with component: of the cells of equal non-null label that touch, the
    smallest j * width + i. Runs of a row are one node each, so that links are
    between runs of adjacent rows only, and runs that begin in one tile of
    `tile` by `tile` cells are joined there at once. An i outside 0..width-1 is
    an error."""
    r = runs(df.where(F.col(label).isNotNull()), label, i, j)
    wide = F.raise_error(F.lit(f"{i} is not within 0..{width - 1}")).cast("long")
    node = F.when((F.col("i_first") < 0) | (F.col("i_last") >= width), wide).otherwise(F.col(j).cast("long") * width + F.col("i_first"))
    r = written(r.withColumn("node", node), "runs")
    below = r.select((F.col(j) + 1).alias(j), label, F.col("i_first").alias("__a"), F.col("i_last").alias("__b"), F.col("node").alias("__n"))
    at = [F.floor(F.col(a) / tile) * (1 << 40) + F.floor(b / tile) for a, b in (("i_first", F.col(j)), ("__a", F.col(j) - 1))]
    reach = 1 if eight else 0
    touch = (F.col("__a") <= F.col("i_last") + reach) & (F.col("__b") >= F.col("i_first") - reach)
    links = r.join(below, [j, label]).where(touch).select(F.col("node").alias("a"), at[0].alias("ta"), F.col("__n").alias("b"), at[1].alias("tb"))
    comp = _joined_in_tiles(links)
    named = r.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    cells = named.select(j, label, F.explode(F.sequence("i_first", "i_last")).alias(i), "component")
    return df.join(cells, [i, j, label], "left")


def component_stats(df: DataFrame, label: str, **how) -> DataFrame:
    """Of each label its number of components, the cells of the largest, and
    those of all others."""
    c = components(df, label, **how).where("component is not null").groupBy(label, "component").count()
    return c.groupBy(label).agg(F.count("*").alias("n_components"), F.max("count").alias("largest"), (F.sum("count") - F.max("count")).alias("islands"))


def largest_component(df: DataFrame, label: str, **how) -> DataFrame:
    """Only the cells of each label's largest component (ties: the smallest)."""
    c = components(df, label, **how).where("component is not null")
    best = c.groupBy(label, "component").count().groupBy(label)
    best = best.agg(F.max_by("component", F.struct("count", -F.col("component"))).alias("component"))
    return c.join(best, [label, "component"], "left_semi")


def adjacency(c: DataFrame, eight: bool = False) -> DataFrame:
    """(a, b, w) of components of cells that touch, both ways: w is the number of
    pairs of cells, one of each, that share an edge (0: corners only)."""
    steps = [(FOUR, 1), (EIGHT[4:], 0)] if eight else [(FOUR, 1)]
    own = c.where("component is not null").select("i", "j", F.col("component").alias("a"))
    pairs = None
    for offsets, w in steps:
        ring = neighbours(c.where("component is not null"), offsets, ["component"])
        met = own.join(ring, ["i", "j"]).where("a <> n_component").groupBy("a", F.col("n_component").alias("b")).agg(F.sum(F.lit(w)).alias("w"))
        pairs = met if pairs is None else pairs.unionByName(met)
    return pairs.groupBy("a", "b").agg(F.sum("w").alias("w")) if eight else pairs


def make_contiguous(df: DataFrame, label: str, rounds: int = 8, **how) -> DataFrame:
    """Islands, all but each label's largest component, take the label that most
    of their neighbouring cells have (ties: the lowest); up to `rounds` times,
    then an error if islands are left. Negative labels are unlabelled cells.

    Cells are labelled once. An island moves as a whole, so that the rounds run
    on components: their labels, sizes and lengths of common borders. After a
    round only links of islands that moved are looked at, groups that these join
    become one, and the tables shrink; the cells get their labels at the end.
    """
    cells = df.select("i", "j", F.when(F.col(label) >= 0, F.col(label)).alias(label))
    c = written(components(cells, label, **how), "contiguity")
    known = c.where("component is not null")
    nodes = written(known.groupBy(F.col("component").alias("g")).agg(F.first(label).alias("l"), F.count("*").alias("n")), "contiguity-nodes")
    edges = written(adjacency(c, how.get("eight", False)), "contiguity-edges")
    names = nodes.select(F.col("g").alias("component"), "g")

    def islands() -> DataFrame:
        best = nodes.groupBy("l").agg(F.max_by("g", F.struct("n", -F.col("g"))).alias("main"))
        return nodes.join(best, "l").where("g <> main").select("g")

    for k in range(rounds + 1):
        left = written(islands(), "contiguity-islands")
        if left.isEmpty():
            break
        if k == rounds:
            raise ValueError("islands are left")
        ring = edges.where("w > 0").join(left.withColumnRenamed("g", "a"), "a").join(nodes.select(F.col("g").alias("b"), F.col("l").alias("to")), "b")
        votes = ring.groupBy("a", "to").agg(F.sum("w").alias("w")).groupBy("a").agg(F.max_by("to", F.struct("w", -F.col("to"))).alias("to"))
        moved = written(votes, "contiguity-moved")
        now = written(nodes.join(moved.withColumnRenamed("a", "g"), "g", "left").select("g", F.coalesce("to", "l").alias("l"), "n"), "contiguity-nodes")
        near = edges.join(moved.withColumnRenamed("to", "la"), "a").join(now.select(F.col("g").alias("b"), F.col("l").alias("lb")), "b")
        comp = connected_components(near.where("la = lb").select("a", "b"), "contiguity-joined")
        comp = written(comp.withColumnsRenamed({"node": "g", "component": "into"}), "contiguity-into")
        to = F.coalesce("into", "g").alias("g")
        nodes = written(now.join(comp, "g", "left").select(to, "l", "n").groupBy("g").agg(F.first("l").alias("l"), F.sum("n").alias("n")), "contiguity-nodes")
        names = written(names.join(comp, "g", "left").select("component", to), "contiguity-names")
        ends = [comp.select(F.col("g").alias(x), F.col("into").alias(f"into_{x}")) for x in "ab"]
        both = edges.join(ends[0], "a", "left").join(ends[1], "b", "left").select(F.coalesce("into_a", "a").alias("a"), F.coalesce("into_b", "b").alias("b"), "w")
        edges = written(both.where("a <> b").groupBy("a", "b").agg(F.sum("w").alias("w")), "contiguity-edges")
    found = names.join(nodes.select("g", F.col("l").alias("__to")), "g").select("component", "__to")
    return c.join(found, "component", "left").select("i", "j", F.coalesce("__to", F.lit(-1)).cast(df.schema[label].dataType).alias(label))


def extend_nearest(df: DataFrame, label: str) -> DataFrame:
    """Unlabelled cells (negative) take the label of the nearest labelled one."""
    cells = df.select("i", "j", F.when(F.col(label) >= 0, F.col(label)).alias(label)).withColumn("__in", F.lit(True))
    out = fill_nearest(cells, label, "__in")
    return out.select("i", "j", F.coalesce(label, F.lit(-1)).alias(label))


def select_shelf(df: DataFrame, seeds: DataFrame, shelf: str, reach: int = 10) -> DataFrame:
    """Shelf cells (a boolean) of the components that come within `reach` cells,
    diagonals included, of a seed cell."""
    c = components(df.select("i", "j", F.when(F.col(shelf), 1).alias("__s")), "__s", eight=False).where("component is not null")
    # seeds and cells meet in tiles of the reach, own and adjacent
    tile = [F.floor(F.col(x) / reach).cast("int") for x in "ij"]
    s = seeds.select(F.col("i").alias("__i"), F.col("j").alias("__j"), F.floor(F.col("i") / reach).cast("int").alias("__a"), F.floor(F.col("j") / reach).cast("int").alias("__b"))
    around = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)]))
    ask = c.withColumn("__n", around).withColumns({"__a": tile[0] + F.col("__n.a"), "__b": tile[1] + F.col("__n.b")})
    near = (F.abs(F.col("i") - F.col("__i")) <= reach) & (F.abs(F.col("j") - F.col("__j")) <= reach)
    hit = ask.join(s, ["__a", "__b"]).where(near).select("component").distinct()
    return c.join(hit, "component", "left_semi").select("i", "j")


def shelf_break(shelf: DataFrame, deep: DataFrame) -> DataFrame:
    """Shelf cells that touch a deep cell, diagonals included."""
    ring = neighbours(deep, EIGHT, []).distinct()
    return shelf.join(ring, ["i", "j"], "left_semi").select("i", "j")


def extrude_labels(cells: DataFrame, sources: DataFrame, label: str) -> DataFrame:
    """Cells take the label of the nearest source cell (ties: lowest j, then i),
    whether that is among them or not."""
    have = written(sources.groupBy("i", "j").agg(F.min(label).alias(label)), "label-sources")
    found = nearest_sources(cells, have).join(have.withColumnsRenamed({"i": "source_i", "j": "source_j"}), ["source_i", "source_j"])
    return cells.select("i", "j").join(found.select("i", "j", label), ["i", "j"], "left")


def fill_bounded(df: DataFrame, label: str, wall: str) -> DataFrame:
    """Unlabelled cells (negative) within walls: each component of them takes the
    label that most of the cells on its ring have (ties: the lowest)."""
    c = components(df.select("i", "j", label, wall, F.when((F.col(label) < 0) & ~F.col(wall), 1).alias("__free")), "__free")
    ring = neighbours(c.where((F.col(label) >= 0)), FOUR, [label])
    votes = c.where("component is not null").select("i", "j", "component").join(ring, ["i", "j"]).groupBy("component", f"n_{label}").count()
    votes = votes.groupBy("component").agg(F.max_by(f"n_{label}", F.struct("count", -F.col(f"n_{label}"))).alias("__to"))
    return c.join(votes, "component", "left").select("i", "j", F.coalesce("__to", label).alias(label))


def triple_points(df: DataFrame, label: str) -> DataFrame:
    """Blocks of two by two cells with two labels and an unlabelled cell
    (negative): corner i, j and the two labels, the lower first."""
    moved = neighbours(df.where(F.col(label).isNotNull()), ((0, 0), (0, -1), (-1, 0), (-1, -1)), [label])
    b = moved.groupBy("i", "j").agg(F.count("*").alias("n"), F.array_sort(F.collect_set(F.when(F.col(f"n_{label}") >= 0, F.col(f"n_{label}")))).alias("l"), F.count_if(F.col(f"n_{label}") < 0).alias("free"))
    b = b.where((F.col("n") == 4) & (F.col("free") >= 1) & (F.size("l") == 2))
    return b.select("i", "j", F.get("l", F.lit(0)).alias("low"), F.get("l", F.lit(1)).alias("high"))


def nearest_to_triples(triples: DataFrame, breaks: DataFrame) -> DataFrame:
    """Of each triple point (i, j, low, high; its centre is half a cell on) the
    nearest shelf-break cell break_i, break_j and its distance in cells (ties:
    lowest j, then i)."""
    twice = lambda c, more: (2 * F.col(c).cast("long") + more).alias(c)  # noqa: E731  centres become whole
    found = nearest_sources(triples.select(twice("i", 1), twice("j", 1)), breaks.select(twice("i", 0), twice("j", 0)))
    kinds = dict(breaks.dtypes)
    half = lambda c, x: F.expr(f"{c} div 2").cast(kinds[x])
    found = found.select(((F.col("i") - 1) / 2).cast("long").alias("i"), ((F.col("j") - 1) / 2).cast("long").alias("j"), half("source_i", "i").alias("break_i"), half("source_j", "j").alias("break_j"), (F.sqrt("d2") / 2).alias("distance"))
    return triples.join(found, ["i", "j"]).select("i", "j", "low", "high", "break_i", "break_j", "distance")


def best_per_pair(nearest: DataFrame) -> DataFrame:
    """Of each pair of labels the triple point nearest to the break (ties: lowest
    j, then i)."""
    s = F.min(F.struct(F.round("distance", 9).alias("distance"), "j", "i", "break_j", "break_i")).alias("s")
    return nearest.groupBy("low", "high").agg(s).select("low", "high", "s.i", "s.j", "s.break_i", "s.break_j", "s.distance")


def label_cells(cells: DataFrame, polygons: Sequence, x: str, y: str, depth: str, deepest: float, reach: int, walls: DataFrame | None = None, band: float = 1.0) -> DataFrame:
    """Labels of all cells (i, j, label) from polygons: cells inside them; shelf
    cells (depth up to `deepest`) of components within reach of those take the
    label of the nearest shelf-break cell, which takes that of the nearest
    labelled one; what walls (i, j) enclose takes the label on its ring; all
    others that of the nearest labelled cell; islands are moved at the end."""
    basin = point_in_polygon(cells, x, y, ["i", "j"], polygons, band)
    g = cells.select("i", "j", depth).join(basin, ["i", "j"])
    g = written(g, "labels")
    shelf = written(select_shelf(g.withColumn("__shelf", F.col(depth) <= deepest), g.where("label is not null"), "__shelf", reach), "labels-shelf")
    edge = written(shelf_break(shelf, g.where(F.col(depth) > deepest)), "labels-edge")
    known = g.where("label is not null").select("i", "j", "label")
    on_edge = extrude_labels(edge, known, "label") if not known.isEmpty() else known
    on_edge = written(on_edge, "labels")
    out = g.select("i", "j", "label")
    if not on_edge.isEmpty():
        shelf = extrude_labels(shelf, on_edge, "label").withColumnRenamed("label", "__l")
        out = out.join(shelf, ["i", "j"], "left").select("i", "j", F.coalesce("label", "__l").alias("label"))
    out = written(out.withColumn("label", F.coalesce("label", F.lit(-1))), "labels")
    if walls is not None:
        w = walls.select("i", "j", F.lit(True).alias("__wall")).distinct()
        out = fill_bounded(out.join(w, ["i", "j"], "left").withColumn("__wall", F.coalesce("__wall", F.lit(False))), "label", "__wall")
    out = extend_nearest(written(out, "labels"), "label")
    return make_contiguous(written(out, "labels"), "label")


def validate_labels(df: DataFrame, label: str, expected: Sequence[int]) -> DataFrame:
    """Labels expected that are absent or in more than one component."""
    stats = component_stats(df.select("i", "j", F.when(F.col(label) >= 0, F.col(label)).alias(label)), label)
    want = df.sparkSession.createDataFrame([(x,) for x in expected], f"{label} int")
    out = want.join(stats, label, "left").select(label, F.coalesce("n_components", F.lit(0)).alias("n_components"))
    return out.where("n_components <> 1")


def slopes(df: DataFrame, value: str, dx: float, keys: Sequence[str] = ()) -> DataFrame:
    """Angle of the steepest slope from the neighbours along both axes: centred
    differences, one-sided where a neighbour is missing."""

    def along(a: str, b: str):
        w = Window.partitionBy(*keys, b).orderBy(a)
        back, on = F.lag(value).over(w), F.lead(value).over(w)
        v = F.col(value)
        return F.when(back.isNotNull() & on.isNotNull(), (on - back) / (2 * dx)).when(on.isNotNull(), (on - v) / dx).when(back.isNotNull(), (v - back) / dx)

    s = df.withColumns({"__x": along("i", "j"), "__y": along("j", "i")})
    return s.withColumn("slope", F.atan(F.sqrt(F.col("__x") * F.col("__x") + F.col("__y") * F.col("__y")))).drop("__x", "__y")


def autocorrelation(df: DataFrame, value: str, n: int, lags: int) -> DataFrame:
    """Wrap-around autocorrelation along i by lag, summed over all rows."""
    a = df.select("i", "j", F.col(value).alias("a")).withColumn("lag", F.explode(F.sequence(F.lit(0), F.lit(lags))))
    b = df.select(F.col("i").alias("__i"), F.col("j").alias("__j"), F.col(value).alias("b"))
    p = a.join(b, (F.pmod(F.col("i") + F.col("lag"), F.lit(n)) == F.col("__i")) & (F.col("j") == F.col("__j")))
    return p.groupBy("lag").agg(F.sum(F.col("a") * F.col("b")).alias("correlation"))


def local_maxima(df: DataFrame, value: str, least: float) -> DataFrame:
    """Cells at least as large as their eight neighbours and as `least`."""
    ring = neighbours(df, EIGHT, [value]).groupBy("i", "j").agg(F.max(f"n_{value}").alias("__m"))
    j = df.join(ring, ["i", "j"], "left")
    return j.where((F.col(value) >= least) & (F.col("__m").isNull() | (F.col(value) >= F.col("__m")))).select("i", "j", value)


