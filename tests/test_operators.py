"""Operators against NumPy brute force, invariants, and errors."""

import math

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gridspark.functions import calendars, convert
from gridspark.operators import align, calibrate, components, distributions, fill, labels, masks, ordering, regrid, timeagg, vertical, zonal
from gridspark.sources import incremental, tables
from gridspark.streaming import annual


def grid_rows(a, name="v"):
    return [(j, i, None if a[j, i] != a[j, i] else a[j, i].item()) for j in range(a.shape[0]) for i in range(a.shape[1])]


# time ------------------------------------------------------------------------


def test_annual_mean_of_a_constant_and_short_years(spark):
    rows = [("a", 2000, m, 31, 7.0) for m in range(1, 13)] + [("a", 2001, m, 30, 7.0) for m in range(1, 12)]
    df = spark.createDataFrame(rows, "cell string, yr int, mon int, dim int, v double")
    out = {r.yr: r for r in timeagg.annual_mean(df, ["cell"], "v", "dim", "yr", "mon").collect()}
    assert out[2000].mean == 7.0 and out[2001].n_months == 11
    with pytest.raises(ValueError, match="2001"):
        timeagg.annual_mean(df, ["cell"], "v", "dim", "yr", "mon", strict=True)


def test_missing_counts_as_zero_unless_skipped(spark):
    df = spark.createDataFrame([("a", 1, 10, 4.0), ("a", 1, 30, None)], "cell string, yr int, dim int, v double")
    assert timeagg.window_mean(df, ["cell"], "v", "dim", "yr", 1, 1).first().mean == 1.0
    assert timeagg.window_mean(df, ["cell"], "v", "dim", "yr", 1, 1, skipna=True).first().mean == 4.0


def test_corrected_window_mean_is_the_observed(spark, data):
    from gridspark.operators import biascorr
    from gridspark.plans.views import series

    s = series(spark, data).where("v is not null")
    obs = s.where("flag = 'R'").groupBy("cell").agg(F.avg("v").alias("mean"))
    out = biascorr.classic(s.where("flag = 'A'"), obs, ["cell"], "v", "dim", "yr", 1996, 1998)
    mean = timeagg.window_mean(out, ["cell"], "corrected", "dim", "yr", 1996, 1998, out="c").join(obs, "cell")
    assert mean.where("abs(c - mean) > 1e-9").count() == 0 and mean.count() > 0


def test_calendars(spark):
    df = spark.createDataFrame([(y, m, c) for y in (1900, 2000, 2001) for m in (1, 2, 12) for c in ("gregorian", "noleap", "360_day")], "y int, m int, c string")
    got = {(r.y, r.m, r.c): r.d for r in df.select("*", calendars.days_in_month(F.col("y"), F.col("m"), F.col("c")).alias("d")).collect()}
    assert [got[y, 2, "gregorian"] for y in (1900, 2000, 2001)] == [28, 29, 28]
    assert got[2000, 2, "noleap"] == 28 and got[2000, 2, "360_day"] == 30
    lo, hi = calendars.year_bounds(F.lit(2000), F.lit("gregorian"))
    assert spark.range(1).select(lo, hi).first()[:] == (54786, 55152)


# along levels ----------------------------------------------------------------


def test_resample_keeps_the_integral(spark):
    rng = np.random.default_rng(0)
    source = [(float(k), float(k + 1)) for k in range(12)]
    target = [(0.0, 2.5), (2.5, 7.0), (7.0, 12.0)]
    v = rng.random((5, 12))
    df = spark.createDataFrame([(c, k + 1, float(v[c, k])) for c in range(5) for k in range(12)], "cell int, k int, v double")
    w = vertical.weights_table(spark, vertical.overlap_weights(source, target))
    dz = spark.createDataFrame([(k, b - a) for k, (a, b) in enumerate(target, 1)], "k int, dz double")
    out = {(r.cell, r.k): r.v for r in vertical.resample(df, w, ["cell"], "k", "v", dz).collect()}
    for c in range(5):
        assert sum(out[c, k] * (b - a) for k, (a, b) in enumerate(target, 1)) == pytest.approx(v[c].sum())


def test_resample_brute_force_with_holes(spark):
    rng = np.random.default_rng(1)
    v = np.where(rng.random((20, 9)) < 0.4, np.nan, rng.random((20, 9)))
    source = [(-10.0 * k - 5, -10.0 * k + 5) for k in range(1, 10)]
    target = [(-23.0, -5.0), (-61.0, -23.0), (-95.0, -61.0)]
    weights = vertical.overlap_weights(source, target)
    thick = [b - a for a, b in target]
    rows = [(c, k + 1, None if np.isnan(v[c, k]) else float(v[c, k])) for c in range(20) for k in range(9)]
    df = spark.createDataFrame(rows, "cell int, k int, v double")
    dz = spark.createDataFrame([(k, x) for k, x in enumerate(thick, 1)], "k int, dz double")
    long = {(r.cell, r.k): r.v for r in vertical.resample(df, vertical.weights_table(spark, weights), ["cell"], "k", "v", dz, 0.5).collect()}
    prof = vertical.to_profiles(df, ["cell"], "k", "v", 9).select("cell", vertical.profile_resample(F.col("v"), weights, thick, 0.5).alias("v"))
    prof = {r.cell: r.v for r in prof.collect()}
    for c in range(20):
        for t in range(3):
            own = [(v[c, s - 1], w) for d, s, w in weights if d == t + 1 and not np.isnan(v[c, s - 1])]
            cover = sum(w for _, w in own)
            want = sum(x * w for x, w in own) / cover if cover / thick[t] > 0.5 else None
            for got in (long[c, t + 1], prof[c][t]):
                assert got == (want if want is None else pytest.approx(want))


def test_fills_of_odd_profiles(spark):
    rows = [("none", 1, None), ("none", 2, None), ("one", 1, 5.0), ("top", 1, None), ("top", 2, 3.0), ("top", 3, None)]
    df = spark.createDataFrame(rows, "cell string, k int, v double")
    down = {(r.cell, r.k): r.v for r in vertical.fill_down(df, ["cell"], "k", ["v"]).collect()}
    assert down == {("none", 1): None, ("none", 2): None, ("one", 1): 5.0, ("top", 1): 3.0, ("top", 2): 3.0, ("top", 3): 3.0}


def test_positive_up_conflict(spark):
    df = spark.createDataFrame([("a", 1, -1.0), ("a", 2, -2.0)], "cell string, k int, z double")
    assert [r.z for r in vertical.positive_up(df, ["cell"], "z", "k").orderBy("k").collect()] == [-1.0, -2.0]
    with pytest.raises(PySparkException, match="do not run down"):
        vertical.positive_up(df, ["cell"], "z", "k", positive="down").collect()


def test_interpolation_weights_sum_to_one():
    w = vertical.interpolation_weights([-30.0, -20.0, -10.0], [-5.0, -15.0, -20.0, -40.0])
    for t in range(1, 5):
        assert sum(x for d, _, x in w if d == t) == pytest.approx(1)
    assert {d for d, *_ in vertical.interpolation_weights([-30.0, -20.0], [-10.0, -25.0], extrapolate=False)} == {2}


# distributions ---------------------------------------------------------------


def test_weighted_percentile_brute_force(spark):
    rng = np.random.default_rng(2)
    v, w = rng.integers(0, 9, 200).astype(float), rng.random(200)
    df = spark.createDataFrame([("a", float(a), float(b)) for a, b in zip(v, w, strict=True)], "z string, v double, w double")
    for q in (0.01, 0.5, 0.99):
        order = np.argsort(v, kind="stable")
        c = np.cumsum(w[order])
        want = v[order][np.searchsorted(c, q * c[-1] * (1 - 1e-12))]
        assert distributions.weighted_percentile(df, ["z"], "v", "w", q).first().p == want
    empty = df.where("v > 100")
    assert distributions.weighted_percentile(empty, ["z"], "v", "w", 0.5).count() == 0


def test_fill_bins_brute_force(spark):
    rng = np.random.default_rng(3)
    g = np.where(rng.random((6, 6)) < 0.7, np.nan, rng.random((6, 6)))
    rows = [("z", s, t, float(g[s, t])) for s in range(6) for t in range(6) if not np.isnan(g[s, t])]
    out = fill.fill_bins(spark.createDataFrame(rows, "zone string, s_bin int, t_bin int, delta double"), "zone", "s_bin", "t_bin", "delta", 6).collect()
    while np.isnan(g).any():
        new = g.copy()
        for s in range(6):
            for t in range(6):
                near = [g[a, b] for a in range(max(0, s - 1), min(6, s + 2)) for b in range(max(0, t - 1), min(6, t + 2)) if not np.isnan(g[a, b])]
                if np.isnan(g[s, t]) and near:
                    new[s, t] = np.mean(near)
        g = new
    assert all(r.delta == pytest.approx(g[r.s_bin, r.t_bin]) for r in out) and len(out) == 36


# gap filling -----------------------------------------------------------------


def slab_by_hand(v, allowed, zone, rounds):
    v = v.copy()
    n, m = v.shape
    for _ in range(rounds):
        new = v.copy()
        for j in range(n):
            for i in range(m):
                if not np.isnan(v[j, i]) or not allowed[j, i]:
                    continue
                total = acc = 0.0
                for y, x, w, way in fill.KERNEL:
                    cells = [(j + y, i + x), *[(j + a, i + b) for a, b in way]]
                    if all(0 <= a < n and 0 <= b < m and not np.isnan(v[a, b]) for a, b in cells) and (zone is None or zone[j + y, i + x] == zone[j, i]):
                        total, acc = total + w, acc + w * v[j + y, i + x]
                if total > 0.1:
                    new[j, i] = acc / total
        v = new
    return v


def test_fill_slab_brute_force():
    assert len(fill.KERNEL) == 28
    rng = np.random.default_rng(4)
    for with_zone in (False, True):
        v = np.where(rng.random((12, 15)) < 0.7, np.nan, rng.random((12, 15)))
        allowed, zone = rng.random((12, 15)) < 0.9, rng.integers(0, 2, (12, 15)) if with_zone else None
        (got,) = fill.fill_slab([v], allowed, zone, 4)
        np.testing.assert_allclose(got, slab_by_hand(v, allowed, zone, 4))


def test_fill_nearest_brute_force(spark):
    rng = np.random.default_rng(5)
    v = np.where(rng.random((18, 21)) < 0.95, np.nan, rng.random((18, 21)))
    df = spark.createDataFrame([(j, i, x, True) for j, i, x in grid_rows(v)], "j int, i int, v double, inside boolean")
    got = {(r.j, r.i): r.v for r in fill.fill_nearest(df, "v", "inside").collect()}
    have = [(j, i) for j in range(18) for i in range(21) if not np.isnan(v[j, i])]
    for j in range(18):
        for i in range(21):
            near = min(have, key=lambda p: ((p[0] - j) ** 2 + (p[1] - i) ** 2, p))
            assert got[j, i] == v[near]


def test_fill_horizontal_two_values(spark):
    v = np.full((5, 5), np.nan)
    v[2, 2] = 4.0
    rows = [("t", 1, j, i, x, None if x is None else 0.5, 0, True, True) for j, i, x in grid_rows(v)]
    df = spark.createDataFrame(rows, "variable string, k int, j int, i int, value double, spread double, zone int, inside boolean, open boolean")
    out = fill.fill_horizontal(df, ["variable", "k"], ["value", "spread"])
    assert {(r.value, r.spread) for r in out.collect()} == {(4.0, 0.5)}


# label maps ------------------------------------------------------------------


def flood(g, offsets):
    root = {}
    for j in range(g.shape[0]):
        for i in range(g.shape[1]):
            if g[j, i] < 0 or (j, i) in root:
                continue
            queue, root[j, i] = [(j, i)], (j, i)
            while queue:
                a, b = queue.pop()
                for y, x in offsets:
                    p = (a + y, b + x)
                    if 0 <= p[0] < g.shape[0] and 0 <= p[1] < g.shape[1] and g[p] == g[j, i] and p not in root:
                        root[p] = (j, i)
                        queue.append(p)
    return root


@pytest.mark.parametrize("eight", [False, True])
def test_components_brute_force(spark, eight):
    g = np.random.default_rng(6).integers(-1, 2, (14, 17))
    df = spark.createDataFrame([(j, i, int(g[j, i]) if g[j, i] >= 0 else None) for j in range(14) for i in range(17)], "j int, i int, label int")
    got = {(r.j, r.i): r.component for r in labels.components(df, "label", eight).where("label is not null").collect()}
    want = flood(g, labels.EIGHT if eight else labels.FOUR)
    groups = {}
    for p, r in want.items():
        groups.setdefault(r, set()).add(got[p])
    assert got.keys() == want.keys()
    assert all(len(s) == 1 for s in groups.values()) and len({min(s) for s in groups.values()}) == len(groups)


def test_connected_components_of_a_chain(spark):
    n = 300
    order = np.random.default_rng(7).permutation(n).tolist()
    df = spark.createDataFrame([(a, b) for a, b in zip(order, order[1:], strict=False)] + [(1000, 1001), (5, 5), (None, 3)], "a long, b long")
    got = {r.node: r.component for r in components.connected_components(df).collect()}
    assert {got[k] for k in range(n)} == {0} and got[1001] == 1000
    assert components.connected_components(df.limit(0)).count() == 0


def test_contiguity(spark):
    g = np.zeros((6, 8), int)
    g[:, 4:] = 1
    g[2, 1] = 1
    g[3, 6] = 0
    df = spark.createDataFrame([(j, i, int(g[j, i])) for j in range(6) for i in range(8)], "j int, i int, label int")
    out = {(r.j, r.i): r.label for r in labels.make_contiguous(df, "label").collect()}
    assert out[2, 1] == 0 and out[3, 6] == 1
    assert labels.validate_labels(spark.createDataFrame([(j, i, x) for (j, i), x in out.items()], "j int, i int, label int"), "label", [0, 1]).count() == 0


def test_diagonal_cells_are_two_components(spark):
    df = spark.createDataFrame([(0, 0, 1), (1, 1, 1)], "j int, i int, label int")
    assert labels.component_stats(df, "label").first().n_components == 2
    assert labels.component_stats(df, "label", eight=True).first().n_components == 1


def test_shelf_selection_brute_force(spark):
    rng = np.random.default_rng(8)
    shelf, seed = rng.random((20, 20)) < 0.45, rng.random((20, 20)) < 0.02
    df = spark.createDataFrame([(j, i, bool(shelf[j, i])) for j in range(20) for i in range(20)], "j int, i int, shelf boolean")
    seeds = spark.createDataFrame([(j, i) for j in range(20) for i in range(20) if seed[j, i]], "j int, i int")
    got = {(r.j, r.i) for r in labels.select_shelf(df, seeds, "shelf", reach=3).collect()}
    root = flood(np.where(shelf, 1, -1), labels.FOUR)
    hit = {r for p, r in root.items() if any(seed[a, b] for a in range(max(0, p[0] - 3), min(20, p[0] + 4)) for b in range(max(0, p[1] - 3), min(20, p[1] + 4)))}
    assert got == {p for p, r in root.items() if r in hit}


def test_fill_bounded(spark):
    g = np.array([[0, -1, -1, 1], [0, -1, -1, 1], [0, -1, -1, 1]])
    rows = [(j, i, int(g[j, i]), i == 2) for j in range(3) for i in range(4)]
    df = spark.createDataFrame(rows, "j int, i int, label int, wall boolean")
    out = {(r.j, r.i): r.label for r in labels.fill_bounded(df, "label", "wall").collect()}
    assert [out[j, 1] for j in range(3)] == [0, 0, 0] and out[0, 2] == -1


# regridding ------------------------------------------------------------------


def test_projection_round_trip(spark):
    cells = regrid.with_lat_lon(regrid.grid_cells(spark, 400000.0))
    x, y = regrid.from_lat_lon(F.col("lat"), F.col("lon"))
    off = cells.select(F.abs(x - F.col("x")).alias("a"), F.abs(y - F.col("y")).alias("b"), "lat", "lon").agg(F.max("a"), F.max("b"), F.min("lat"), F.max("lat"), F.min("lon"), F.max("lon")).first()
    assert off[0] < 1e-3 and off[1] < 1e-3
    assert -90 <= off[2] < -85 and off[3] > -55 and -180 <= off[4] and off[5] < 180
    r = spark.range(1).select(regrid.to_lat_lon(F.lit(0.0), F.lit(1e6))[0]).first()[0]
    assert -81.0 < r < -80.5  # about 9.2 degrees from the pole


def test_weights_that_sum_to_one_keep_constants(spark):
    t = spark.createDataFrame([(k, float(k) / 3, 1.7) for k in range(6)], "id int, x double, y double")
    w = regrid.bilinear_weights(t, "x", "y", 0.0, 0.0, 1.0, 1.0, 4, 4, ["id"])
    src = spark.createDataFrame([(i, j, 5.0) for i in range(4) for j in range(4)], "i int, j int, v double")
    assert {round(r.v, 9) for r in regrid.apply_weights(src, w, ["i", "j"], ["id"], "v").collect()} == {5.0}


def test_point_in_polygon_brute_force(spark):
    rng = np.random.default_rng(9)
    ring = [(math.cos(a) * r, math.sin(a) * r) for a, r in zip(np.linspace(0, 2 * math.pi, 9)[:-1], rng.random(8) + 0.3, strict=True)]
    pts = rng.uniform(-1, 1, (300, 2))
    df = spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate(pts)], "id int, x double, y double")
    got = {r.id: r.label for r in regrid.point_in_polygon(df, "x", "y", ["id"], [(7, ring)]).collect()}
    for k, (x, y) in enumerate(pts):
        odd = 0
        for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]], strict=True):
            odd += (ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay)
        assert got[k] == (7 if odd % 2 else None)


def test_periodic_wrap_only_over_a_gap(spark):
    df = spark.createDataFrame([(i, 0, 90.0 * i) for i in range(5)], "i int, j int, lon double")
    assert regrid.periodic_wrap(df, "i", "lon", 5).count() == 5
    assert regrid.periodic_wrap(df.where("i < 4"), "i", "lon", 4).orderBy("i").tail(1)[0][:] == (4, 0, 360.0)


# alignment, masks, zones, calibration ----------------------------------------


def test_alignment_errors(spark):
    a = spark.createDataFrame([(1, 2.0), (2, 3.0)], "k int, a double")
    b = spark.createDataFrame([(1, 5.0)], "k int, b double")
    with pytest.raises(ValueError, match="differ"):
        align.align_exact(a, b, ["k"])
    assert align.align_exact(a.where("k = 1"), b, ["k"]).first()[:] == (1, 2.0, 5.0)
    assert align.same_rows(a, a) and not align.same_rows(a, a.union(a))
    with pytest.raises(ValueError, match="missing"):
        masks.require_columns(a, ["k", "bed"])
    with pytest.raises(ValueError, match="coordinates"):
        masks.attach_coords(a, b, on=["k"])


def test_combined_estimates(spark):
    df = spark.createDataFrame([(1.0, 0.5, 3.0, 1.0), (None, None, 2.0, 1.0), (None, None, None, None)], "a double, ea double, b double, eb double")
    for skipna, want in ((True, [(2.0, 1.75), (2.0, 1.0), (None, None)]), (False, [(2.0, 1.75), (None, None), (None, None)])):
        mean, half = zonal.combine_estimates([("a", "ea"), ("b", "eb")], skipna)
        assert [tuple(r) for r in df.select(mean, half).collect()] == want


def test_argmin_ties_and_constraint(spark):
    sums = spark.createDataFrame([("m", 1, 0.0, 8.0), ("m", 1, 1.0, 12.0)], "p string, zone int, o double, v double")
    t = spark.createDataFrame([(1, 10.0)], "zone int, target double")
    r = calibrate.optimal_offset(sums, t, ["p"], "zone", "o", "v", "target").first()
    assert (r.offset, r.residual) == (0.0, 2.0)


def test_draws_follow_their_distribution_and_repeat(spark):
    k = spark.createDataFrame([("a", 10.0, 2.0)], "key string, mean double, sigma double")
    d = calibrate.draws(k, 4000, "mean", "sigma")
    r = d.agg(F.avg("drawn"), F.stddev("drawn"), F.avg("weight")).first()
    assert abs(r[0] - 10) < 0.15 and abs(r[1] - 2) < 0.1 and abs(r[2] - 0.5) < 0.03
    assert d.exceptAll(calibrate.draws(k, 4000, "mean", "sigma")).isEmpty()


def test_global_rank(spark):
    df = spark.range(1000).select(((F.col("id") * 37) % 1000).alias("x"))
    assert [r[:] for r in ordering.global_rank(df, ["x"], "n").orderBy("n").limit(3).collect()] == [(0, 1), (1, 2), (2, 3)]


def test_text_parsing(spark):
    df = spark.createDataFrame([("−1 234.5 ± 6.7",), ("12+-3",), ("none",)], "t string")
    v, e = convert.value_and_error(F.col("t"))
    assert [tuple(r) for r in df.select(v, e).collect()] == [(-1234.5, 6.7), (12.0, 3.0), (None, None)]


# sources and sinks -----------------------------------------------------------


def test_sources(spark, tmp_path):
    p = str(tmp_path / "t")
    spark.createDataFrame([(1.0, 0.5, 1.5, 3.0)], "time double, lo double, hi double, thetao double").write.parquet(p)
    df = tables.read_variable(spark, p, names={"lo": "time_lo", "hi": "time_hi", "thetao": "ct"})
    assert df.columns == ["time", "time_lo", "time_hi", "ct"] and df.count() == 1
    assert "part-" in tables.with_lineage(spark.read.parquet(p)).first().file
    with pytest.raises(ValueError, match="bounds"):
        tables.read_variable(spark, p)
    pairs = tables.pair_files(spark, ["t_1850-1859.nc", "t_1860-1869.nc"], ["s_1860-1869.nc", "s_1850-1859.nc"])
    assert {(r.a, r.b) for r in pairs.collect()} == {("t_1850-1859.nc", "s_1850-1859.nc"), ("t_1860-1869.nc", "s_1860-1869.nc")}
    with pytest.raises(ValueError, match="1860"):
        tables.pair_files(spark, ["t_1850-1859.nc", "t_1860-1869.nc"], ["s_1850-1859.nc"])
    kept = tables.collect_pairs(spark, {"historical": (["t_1850-1859.nc"], ["s_1850-1859.nc"]), "ssp": (["t_2015-2020.nc"], [])})
    assert [(r.scenario, r.years) for r in kept.collect()] == [("historical", "1850-1859")]
    (tmp_path / "d.txt").write_text("basin  melt\n 1   2.5\n 2 -3\n")
    assert [r[:] for r in tables.read_delimited(spark, str(tmp_path / "d.txt"), "basin int, melt double").collect()] == [(1, 2.5), (2, -3.0)]


def test_append_is_idempotent_and_publish_atomic(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0), (2, 3.0)], "time int, v double")
    p = str(tmp_path / "a")
    for _ in range(2):
        incremental.append_new(df, p, ["time"])
    assert spark.read.parquet(p).count() == 2
    to = incremental.published_path(str(tmp_path), "tf", "m", "ssp", "v1", 2015, 2020)
    assert incremental.publish(df, to) and not incremental.publish(df, to)
    assert spark.read.parquet(to).count() == 2
    incremental.write_selected(df, str(tmp_path / "w"), ["v"], ["time"])
    assert dict(spark.read.parquet(str(tmp_path / "w")).dtypes)["v"] == "float"
    incremental.split_blocks(df.withColumn("block", F.col("time") % 2), str(tmp_path / "b"), "block")
    assert spark.read.parquet(str(tmp_path / "b")).where("block = 1").count() == 1


def test_stream_appends_once_and_closes_years(spark, tmp_path):
    src, dst, cp = (str(tmp_path / n) for n in ("src", "dst", "cp"))
    schema = "cell string, yr int, mon int, dim int, v double"
    rows = [("a", 2000, m, 30, 1.0) for m in range(1, 13)] + [("a", 2001, 1, 31, 2.0)]
    spark.createDataFrame(rows, schema).write.parquet(src)
    annual.append_stream(spark, src, schema, dst, cp, ["cell", "yr", "mon"]).awaitTermination()
    spark.createDataFrame(rows[-1:], schema).write.mode("append").parquet(src)  # comes again
    annual.append_stream(spark, src, schema, dst, cp, ["cell", "yr", "mon"]).awaitTermination()
    assert spark.read.parquet(dst).count() == 13
    for _ in range(2):
        annual.close_years(spark.read.parquet(dst), str(tmp_path / "y"), ["cell"], "v", "dim", "yr", "mon")
    assert [r.yr for r in spark.read.parquet(str(tmp_path / "y")).collect()] == [2000]
