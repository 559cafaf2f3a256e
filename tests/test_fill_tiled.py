"""Horizontal fills against a version cell by cell, in one piece and by tiles."""

import math
import random

import pytest

from gridspark.operators import fill
from gridspark.plans import scenarios_queries
from gridspark.plans.views import cells as cells_of

#: Distances to neighbours and their weights, as fill.py gives them.
WEIGHT = {d: w for (a, b), w in zip(fill.RINGS, fill.WEIGHTS) for d in ((a, b), (b, a))}


def by_hand(cells, values, passes):
    """cells: {(j, i): dict of values, zone, inside, open}; passes: (allowed, same zone, rounds)."""
    state = {k: [c[v] for v in values] for k, c in cells.items()}

    def filled(k):
        return k in state and state[k][0] is not None

    def sign(x):
        return (x > 0) - (x < 0)

    for allowed, zoned, rounds in passes:
        for done in range(max(rounds(c) for c in cells.values())):
            new = {}
            for (j, i), c in cells.items():
                if filled((j, i)) or not allowed(c) or done >= rounds(c):
                    continue
                total, sums = 0.0, [0.0] * len(values)
                for y in range(-3, 4):
                    for x in range(-3, 4):
                        w = WEIGHT.get((abs(y), abs(x)))
                        k = (j + y, i + x)
                        if w is None or not filled(k) or (zoned and cells[k]["zone"] != c["zone"]):
                            continue
                        if (abs(y), abs(x)) not in ((1, 0), (0, 1), (1, 1)):  # further cells need the one before them
                            step = (y - sign(y), x - sign(x)) if abs(y) == abs(x) else (y - sign(y), x) if abs(y) > abs(x) else (y, x - sign(x))
                            if not filled((j + step[0], i + step[1])):
                                continue
                        total += w
                        sums = [s + w * v for s, v in zip(sums, state[k])]
                if total > 0.1:
                    new[j, i] = [s / total for s in sums]
            if not new:
                break
            state.update(new)
    return state


def slab(seed, n, m, holes=0.6):
    rng = random.Random(seed)
    cells = {}
    for j in range(n):
        for i in range(m):
            if rng.random() < 0.03:
                continue  # not there at all
            zone = rng.choice([None, 0, 2]) if rng.random() < 0.05 else (j * 2 // n) + 2 * (i * 2 // m)
            some = None if rng.random() < holes else rng.uniform(-1, 1)
            cells[j - 5, i + 3] = {"t": some, "s": None if some is None else rng.uniform(30, 35), "zone": zone, "inside": rng.random() < 0.8, "open": rng.random() < 0.7}
    return cells


ROUNDS, ZONES, LEVELS = (2, 4, 3), ({2: 5}, {1: 7, 3: 1}), {2: 6}


def passes(level):
    own = lambda p: lambda c: ZONES[p].get(-1 if c["zone"] is None else c["zone"], ROUNDS[p])
    return [(lambda c: c["inside"] and c["open"], True, own(0)), (lambda c: c["inside"], True, own(1)), (lambda c: True, False, lambda c: LEVELS.get(level, ROUNDS[2]))]


def table(spark, slabs):
    rows = [(t, k, j, i, c["t"], c["s"], c["zone"], c["inside"], c["open"]) for (t, k), cells in slabs.items() for (j, i), c in cells.items()]
    return spark.createDataFrame(rows, "time int, k int, j int, i int, t double, s double, zone int, inside boolean, open boolean")


HOW = {"rounds": ROUNDS, "zone_rounds": ZONES, "level": "k", "level_rounds": LEVELS}


def found(df):
    return {(r.time, r.k, r.j, r.i): (r.t, r.s) for r in df.collect()}


def same(a, b):
    return a.keys() == b.keys() and all((x is None and y is None) or (x is not None and y is not None and math.isclose(x, y, abs_tol=1e-9)) for k in a for x, y in zip(a[k], b[k]))


@pytest.fixture(scope="module")
def slabs():
    return {(1, 1): slab(1, 40, 40, 0.85), (1, 2): slab(2, 23, 31), (2, 1): slab(3, 3, 2), (2, 2): {(0, 0): {"t": 1.0, "s": 30.0, "zone": 1, "inside": True, "open": True}}}


@pytest.fixture(scope="module")
def want(slabs):
    return {(t, k, j, i): tuple(v) for (t, k), cells in slabs.items() for (j, i), v in by_hand(cells, ["t", "s"], passes(k)).items()}


def test_one_piece_by_hand(spark, slabs, want):
    assert same(found(fill.fill_horizontal(table(spark, slabs), ["time", "k"], ["t", "s"], **HOW)), want)
    assert sum(v[0] is not None for v in want.values()) > sum(c["t"] is not None for s in slabs.values() for c in s.values())


@pytest.mark.parametrize(("size", "step"), [(4, 1), (16, 2)])
def test_tiles_by_hand(spark, slabs, want, size, step):
    """10 x 10 tiles and more of 4 cells, the rounds one by one; and larger ones."""
    assert same(found(fill.fill_tiled(table(spark, slabs), ["time", "k"], ["t", "s"], **HOW, size=size, step=step)), want)


def test_tiles_far_and_empty(spark):
    """A value that has to cross many tiles; a table without rows."""
    cells = {(0, i): {"t": 1.0 if i == 0 else None, "s": 2.0 if i == 0 else None, "zone": 0, "inside": True, "open": True} for i in range(60)}
    df = table(spark, {(1, 1): cells})
    got = found(fill.fill_tiled(df, ["time", "k"], ["t", "s"], (30, 60, 5), size=6, step=2))
    assert set(got.values()) == {(1.0, 2.0)} and len(got) == 60
    assert fill.fill_tiled(df.limit(0), ["time", "k"], ["t"], (1, 1, 1), size=6, step=2).collect() == []


def test_a_step_within_the_tile(spark, slabs):
    with pytest.raises(ValueError):
        fill.fill_tiled(table(spark, slabs), ["time", "k"], ["t"], size=5, step=2)


@pytest.mark.parametrize("timed", [True, False])
def test_extrapolation_by_hand(spark, data, timed):
    """The registered pipelines: ice mask, horizontal fill, fill downward, and the
    overlap of levels 20 deep with levels 30 deep."""
    slabs = {}
    for r in cells_of(spark, data).collect():
        for k in (1, 2, 3):
            v = None if k == 3 or r.v_holes is None or r.ice_frac > 0.5 else r.v_holes / k
            place = (r.j % 40, r.i) if timed else (r.j, r.i)
            slabs.setdefault((r.j // 40 if timed else 0, k), {})[place] = {"v": v, "zone": r.zone, "inside": r.ice_frac < 0.5, "open": r.v > 0}
    first, second = fill.FIRST_ROUNDS, fill.SECOND_ROUNDS
    flat = {}
    for (t, k), cells in slabs.items():
        own = [
            (lambda c: c["inside"] and c["open"], True, lambda c: first.get(c["zone"], 20)),
            (lambda c: c["inside"], True, lambda c: second.get(c["zone"], 120)),
            (lambda c: True, False, lambda c: fill.LAST_ROUNDS.get(k, 5)),
        ]
        for (j, i), v in by_hand(cells, ["v"], own).items():
            flat.setdefault((t, j, i), {})[k] = v[0]
    want = {}
    for cell, v in flat.items():
        v[1] = v[1] if v[1] is not None else v[2]
        v[2] = v[2] if v[2] is not None else v[1]
        v[3] = v[3] if v[3] is not None else v[2]
        for k, ((a, x), (b, y)) in {1: ((1, 20), (2, 10)), 2: ((2, 10), (3, 20))}.items():
            some = [(v[n], w) for n, w in ((a, x), (b, y)) if v[n] is not None]
            want[(*cell, k)] = sum(n * w for n, w in some) / sum(w for _, w in some) if some else None
    query = scenarios_queries.b11 if timed else scenarios_queries.b11_climatology
    got = {(r.time if timed else 0, r.j, r.i, r.k): r.value for r in query(spark, data).collect()}
    assert same({k: (v,) for k, v in got.items()}, {k: (v,) for k, v in want.items()})
    assert sum(v is not None for v in got.values()) > len(got) / 2
