"""The state-space correction, all steps one after another, cell by cell."""

import math

import pytest

from gridspark.plans.distributions_queries import b2
from gridspark.plans.views import states

N = 5


def percentile(pairs, q):
    total, c = sum(w for _, w in pairs), 0.0
    for v, w in sorted(pairs):
        c += w
        if c >= q * total * (1 - 1e-12):
            return v


def histogram(pairs, edges):
    h = [0.0] * (len(edges) - 1)
    for v, w in pairs:
        for k in range(len(h)):
            if edges[k] <= v < edges[k + 1] or (v == edges[-1] and k == len(h) - 1):
                h[k] += w
    total = sum(h)
    return [x / total if total else 0.0 for x in h]


def best_scale(model, reference, edges):
    pm, pr = percentile(model, 0.99), percentile(reference, 0.99)
    found = []
    for n in range(5, 15):
        scale = n / 10
        tried = histogram([(scale * (v - pm) + pr, w) for v, w in model], edges)
        found.append((round(math.dist(tried, histogram(reference, edges)), 9), scale))
    return min(found)[1], pm, pr


def equal_bin(v, low, high):
    return min(N - 1, math.floor(N * ((v - low) / (high - low) if high > low else 0.0)))


def lookup_bin(v, low, high):
    return min(N - 1, max(0, int((N - 1) * ((v - low) / (high - low) if high > low else 0.0))))


def filled(bins):
    bins = dict(bins)
    while bins and any(v is None for v in bins.values()) and any(v is not None for v in bins.values()):
        new = {}
        for (a, b), v in bins.items():
            if v is None:
                near = [bins[a + y, b + x] for y in (-1, 0, 1) for x in (-1, 0, 1) if bins.get((a + y, b + x)) is not None]
                if near:
                    new[a, b] = sum(near) / len(near)
        bins.update(new)
    return bins


def test_state_space_correction(spark, data):
    cells = states(spark, data).collect()
    want = {}
    for zone in {r.zone for r in cells}:
        own = [r for r in cells if r.zone == zone]
        model = [(0.8 * r.s + 3, 1.2 * r.t - 1, r.volume) for r in own]
        cs, pm, pr = best_scale([(s, w) for s, _, w in model], [(r.s, r.volume) for r in own], [5.0 * k for k in range(9)])
        m_min, r_min = min(t for _, t, _ in model), min(r.t for r in own)
        spread = percentile([(t, w) for _, t, w in model], 0.99) - m_min
        ct = (percentile([(r.t, r.volume) for r in own], 0.99) - r_min) / spread if spread else None
        salt = [cs * (f(s for s, _, _ in model) - pm) + pr for f in (min, max)]
        warm = [None if ct is None else ct * (f(t for _, t, _ in model) - m_min) + r_min for f in (min, max)]
        ends = [(min(x), max(x)) for x in ([r.s for r in own], [r.t for r in own])]
        for year in (2000, 2001, 2002):
            groups = {}
            for r in own:
                groups.setdefault((equal_bin(r.s, *ends[0]), equal_bin(r.t, *ends[1])), []).append(r)
            bins = {(a, b): None for a in range(N) for b in range(N)}
            for at, rows in groups.items():
                if all(r.delta is not None for r in rows):
                    bins[at] = sum(r.volume * r.delta * (year - 1999) for r in rows) / sum(r.volume for r in rows)
            bins = filled(bins)
            for r in own:
                delta = None if ct is None else bins[lookup_bin(r.s, *salt), lookup_bin(r.t, *warm)]
                want[r.i, r.j, year] = None if delta is None else r.t + delta
    got = {(r.i, r.j, r.year): r.changed for r in b2(spark, data).collect()}
    assert got.keys() == want.keys()
    assert sum(v is not None for v in want.values()) > len(want) / 2
    for k, v in want.items():
        assert v == pytest.approx(got[k], abs=1e-9) if v is not None and got[k] is not None else v == got[k], k
