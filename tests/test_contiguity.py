"""Contiguity repair and the label pipeline against their definitions, cell by
cell."""

import random
from collections import Counter

import pytest

from gridspark.operators import labels
from gridspark.plans.labels_queries import b12
from gridspark.plans.views import cells as cells_of


def parts(g, eight):
    """Component of each labelled cell: its smallest cell (j, i)."""
    root = {}
    for p in sorted(g):
        if g[p] < 0 or p in root:
            continue
        root[p] = p
        todo = [p]
        while todo:
            j, i = todo.pop()
            for y, x in labels.EIGHT if eight else labels.FOUR:
                q = (j + y, i + x)
                if q not in root and g.get(q) == g[p]:
                    root[q] = p
                    todo.append(q)
    return root


def by_hand(g, rounds, eight=False):
    g = dict(g)
    for k in range(rounds + 1):
        root = parts(g, eight)
        size = Counter(root.values())
        main = {}
        for p, n in size.items():
            x = g[p]
            if x not in main or (n, [-c for c in p]) > (size[main[x]], [-c for c in main[x]]):
                main[x] = p
        islands = {p for p in size if p != main[g[p]]}
        if not islands:
            return g
        if k == rounds:
            raise ValueError
        votes = {p: Counter() for p in islands}
        for (j, i), r in root.items():
            if r in islands:
                for y, x in labels.FOUR:
                    q = (j + y, i + x)
                    if q in root and root[q] != r:
                        votes[r][g[q]] += 1
        to = {p: min(v, key=lambda x: (-v[x], x)) for p, v in votes.items() if v}
        g = {p: to.get(root.get(p), x) for p, x in g.items()}


@pytest.mark.parametrize("seed", [2, 3])
def test_against_cells(spark, seed):
    rng = random.Random(seed)
    n, m = ((6, 8), (9, 14), (12, 12), (7, 20), (10, 10))[seed]
    eight = seed == 3
    strewn = (0.05, 0.15, 0.25, 0.3, 0.2)[seed]
    g = {(j, i): rng.choice([0, 1, 2, 3, -1]) if rng.random() < strewn else i * 3 // m for j in range(n) for i in range(m) if rng.random() > 0.02}
    df = spark.createDataFrame([(j, i, x) for (j, i), x in g.items()], "j int, i int, label int")
    try:
        want = by_hand(g, 8, eight)
    except ValueError:
        with pytest.raises(ValueError, match="islands"):
            labels.make_contiguous(df, "label", eight=eight).collect()
        return
    assert {(r.j, r.i): r.label for r in labels.make_contiguous(df, "label", eight=eight).collect()} == want


def test_an_island_alone_is_an_error(spark):
    """Two components of a label without neighbours can't move."""
    df = spark.createDataFrame([(0, 0, 1), (0, 5, 1)], "j int, i int, label int")
    with pytest.raises(ValueError, match="islands"):
        labels.make_contiguous(df, "label", rounds=2)


def test_several_rounds(spark):
    """An island within an island, which moves after the outer one has."""
    g = {(j, i): 0 if i < 6 else 1 for j in range(9) for i in range(12)}
    g |= {(j, i): 1 for j in range(2, 7) for i in range(1, 5)} | {(j, i): 0 for j in range(3, 6) for i in range(2, 4)} | {(4, 2): 1}
    df = spark.createDataFrame([(j, i, x) for (j, i), x in g.items()], "j int, i int, label int")
    assert {(r.j, r.i): r.label for r in labels.make_contiguous(df, "label").collect()} == by_hand(g, 8)


def inside(x, y, ring):
    odd = False
    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
        if (ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay):
            odd = not odd
    return odd


def nearest(p, sources):
    return min(sources, key=lambda s: ((s[0] - p[0]) ** 2 + (s[1] - p[1]) ** 2, s))


def around(p, offsets):
    return [(p[0] + y, p[1] + x) for y, x in offsets]


def label_by_hand(depth, polygons, deepest, reach, walls):
    known = {p: k for p in depth for k, ring in polygons if inside(p[1], p[0], ring)}
    root = parts({p: 1 for p in depth if depth[p] <= deepest}, False)
    hit = {r for p, r in root.items() if any(max(abs(p[0] - s[0]), abs(p[1] - s[1])) <= reach for s in known)}
    shelf = {p for p, r in root.items() if r in hit}
    edge = {p for p in shelf if any(depth.get(q, 0) > deepest for q in around(p, labels.EIGHT))}
    edge = {p: known[nearest(p, known)] for p in edge}
    out = {p: known[p] if p in known else edge[nearest(p, edge)] if p in shelf else -1 for p in depth}
    root = parts({p: 1 for p in depth if out[p] < 0 and p not in walls}, False)
    votes = {r: Counter() for r in root.values()}
    for p, r in root.items():
        votes[r].update(out[q] for q in around(p, labels.FOUR) if out.get(q, -1) >= 0)
    to = {r: min(v, key=lambda x: (-v[x], x)) for r, v in votes.items() if v}
    out = {p: to.get(root.get(p), x) for p, x in out.items()}
    have = {p: x for p, x in out.items() if x >= 0}
    return by_hand({p: x if x >= 0 else have[nearest(p, have)] for p, x in out.items()}, 8)


def test_label_pipeline(spark, data):
    """The registered query, all steps one after another by hand."""
    depth = {(r.j, r.i): r.v for r in cells_of(spark, data).collect()}
    polygons = [(k, [(10.2 * k, -0.5), (10.2 * k + 7.5, -0.5), (10.2 * k + 5.5, 9.3), (10.2 * k + 1.5, 7.3)]) for k in range(4)]
    want = label_by_hand(depth, polygons, 6000.0, 3, {p for p in depth if p[1] % 9 == 4})
    assert {(r.j, r.i): r.label for r in b12(spark, data).collect()} == want


@pytest.mark.parametrize("eight", [False, True])
def test_components_across_tiles(spark, eight):
    """Runs longer than tiles, links within and across them, negative rows."""
    rng = random.Random(5)
    g = {(j, i): rng.choice((0, 0, 0, 1, -1)) for j in range(-9, 14) for i in range(31)}
    df = spark.createDataFrame([(i, j, v if v >= 0 else None) for (j, i), v in g.items()], "i int, j int, label int")
    got = {(r.j, r.i): r.component for r in labels.components(df, "label", eight, tile=4).collect()}
    root = parts(g, eight)
    assert got == {p: root[p][0] * (1 << 20) + root[p][1] if p in root else None for p in g}


def test_links_within_a_tile_take_no_rounds(spark, monkeypatch):
    """A column of 500 cells is one component before any round."""
    asked, solve = [], labels.connected_components
    monkeypatch.setattr(labels, "connected_components", lambda edges, *a: asked.append(edges.count()) or solve(edges, *a))
    df = spark.range(500).selectExpr("3 i", "cast(id as int) j", "1 label")
    assert {r.component for r in labels.components(df, "label").collect()} == {3}
    assert asked == [0]
