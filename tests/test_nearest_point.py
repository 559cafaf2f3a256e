"""Nearest cells of points against a search, and what of it is sorted."""

import random

from gridspark.operators import regrid


def test_only_ties_are_sorted(spark, monkeypatch):
    """Ties by j, then i; a point without an id counts as one; far points too."""
    plans, write = {}, regrid.written

    def seen(df, name="table", path=None):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return write(df, name, path)

    monkeypatch.setattr(regrid, "written", seen)
    rng = random.Random(3)
    cells = [(i, j, float(j), float(i), 100 * j + i) for i in range(9) for j in range(9)]
    points = [(k, rng.randrange(-20, 40) / 2, rng.randrange(-20, 40) / 2) for k in range(60)] + [(None, 3.5, 3.5), (60, -300.0, 4.0)]
    c = spark.createDataFrame(cells, "i int, j int, la double, lo double, zone int")
    p = spark.createDataFrame(points, "k int, la double, lo double")
    got = regrid.nearest_point(c, p, "k", "la", "lo", "zone", ["j", "i"], distance="d").collect()
    want = {}
    for k, la, lo in points:
        d, j, i = min((abs(j - la) + abs(i - lo), j, i) for i, j, *_ in cells)
        want[k] = (100 * j + i, d)
    assert len(got) == len(points) and {r.k: (r.zone, r.d) for r in got} == want
    assert "HashAggregate" in plans["nearest-least"] and "SortAggregate" not in plans["nearest-least"]
