"""Gap filling: horizontal slabs, histogram bins, nearest and linear fills."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridspark.operators.distance import nearest_sources
from gridspark.sources.staging import bucketed, written

#: Weights of a Gaussian of 24 km on 8 km cells at the six distances below.
WEIGHTS = (0.946, 0.801, 0.895, 0.757, 0.641, 0.606)
RINGS = ((1, 0), (2, 0), (1, 1), (2, 1), (2, 2), (3, 0))


def _kernel() -> list[tuple[int, int, float, list[tuple[int, int]]]]:
    """(dj, di, weight, cells on the way): a neighbour counts only if the cell
    one step nearer, along each of its axes, is filled."""
    out = []
    for w, (a, b) in zip(WEIGHTS, RINGS, strict=True):
        for y, x in sorted({(s * p, t * q) for p, q in ((a, b), (b, a)) for s in (1, -1) for t in (1, -1)}):
            way = []
            if max(abs(y), abs(x)) > 1 or abs(y) + abs(x) > 1:
                way = [(y - np.sign(y), x - np.sign(x))] if abs(y) == abs(x) else [(y - np.sign(y), x)] if abs(y) > abs(x) else [(y, x - np.sign(x))]
            out.append((y, x, w, [p for p in way if p != (0, 0)]))
    return out


KERNEL = _kernel()
#: Cells that one round looks far.
_REACH = 3


def fill_slab(values: list[np.ndarray], allowed: np.ndarray, zone: np.ndarray | None, rounds: int | np.ndarray, least: float = 0.1, begin: int = 0, end: int | None = None) -> list[np.ndarray]:
    """Fill missing allowed cells, round by round, with the weighted mean of the
    filled neighbours of the same zone; a cell needs a total weight over
    `least`. Several values share the first one's validity. rounds may differ by
    cell; of all of them those from `begin` to `end` are run."""
    values = [v.copy() for v in values]
    n, m = values[0].shape
    pad = 3

    def framed(a: np.ndarray, by) -> np.ndarray:
        return np.pad(a, pad, constant_values=by)

    def moved(a: np.ndarray, y: int, x: int) -> np.ndarray:
        return a[pad + y : pad + y + n, pad + x : pad + x + m]

    zones = framed(zone, -99) if zone is not None else None
    top = int(np.max(rounds))
    for done in range(begin, top if end is None else min(top, end)):
        have = ~np.isnan(values[0])
        want = allowed & ~have & (done < rounds)
        if not want.any():
            break
        h = framed(have, False)
        vs = [framed(np.where(have, v, 0.0), 0.0) for v in values]
        total, sums = np.zeros((n, m)), [np.zeros((n, m)) for _ in values]
        for y, x, w, way in KERNEL:
            ok = moved(h, y, x)
            for a, b in way:
                ok = ok & moved(h, a, b)
            if zones is not None:
                ok = ok & (moved(zones, y, x) == zone)
            total += w * ok
            for k, v in enumerate(vs):
                sums[k] += w * ok * moved(v, y, x)
        take = want & (total > least)
        if not take.any():
            break
        for k, s in enumerate(sums):
            values[k][take] = s[take] / total[take]
    return values


#: Rounds of the first two passes in zones that need other than the default
#: numbers, and of the last one by level.
FIRST_ROUNDS = {2: 75, 7: 120, 14: 120}
SECOND_ROUNDS = {4: 200, 5: 200, 6: 200, 7: 200, 8: 200, 14: 200, 10: 40, 11: 40, 13: 40, 15: 40}
LAST_ROUNDS = {2: 200}


def fill_horizontal(df: DataFrame, keys: Sequence[str], values: Sequence[str], rounds: tuple[int, int, int] = (20, 120, 5), zone: str = "zone", inside: str = "inside", open_: str = "open", missing_above: float | None = None, zone_rounds: tuple[dict[int, int], dict[int, int]] = ({}, {}), level: str | None = None, level_rounds: dict[int, int] | None = None) -> DataFrame:
    """Three passes over each slab (one per key: variable, time block, level):
    within zones where `inside` and `open_`, within zones where `inside`, then
    everywhere. Slabs are independent, so that tasks are as many as slabs.
    Columns j, i, zone, inside, open_ and the values; all come back filled.
    missing_above: absolute values beyond it are missing too. zone_rounds: other
    numbers of rounds of the first two passes by zone; level_rounds: of the last
    one by the key `level`."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keys, "j", "i", *values).schema)
    limits = _Limits(rounds, zone_rounds, level_rounds)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        j0, i0 = pdf.j.min(), pdf.i.min()
        shape = (int(pdf.j.max() - j0 + 1), int(pdf.i.max() - i0 + 1))
        at = ((pdf.j - j0).to_numpy(), (pdf.i - i0).to_numpy())
        vs, z, flags = _arrays(pdf, shape, at, values, zone, inside, open_, missing_above)
        for p in range(3):
            vs = fill_slab(vs, *_pass(p, z, flags, limits, pdf[level].iloc[0] if level else None))
        out = pdf[[*keys, "j", "i"]].copy()
        for name, v in zip(values, vs, strict=True):
            out[name] = v[at]
        return out

    return df.groupBy(*keys).applyInPandas(one, schema)


class _Limits(NamedTuple):
    """Rounds of the three passes: in general, and in certain zones and levels."""

    rounds: tuple[int, int, int]
    zones: tuple[dict[int, int], dict[int, int]]
    levels: dict[int, int] | None

    def most(self, p: int) -> int:
        return max(self.rounds[p], *((self.zones[p] if p < 2 else self.levels) or {0: 0}).values())


def _arrays(pdf: pd.DataFrame, shape: tuple[int, int], at: tuple[np.ndarray, np.ndarray], values: Sequence[str], zone: str, inside: str, open_: str, missing_above: float | None) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Rows as arrays: the values (NaN: missing), the zone (-1: none), and bits
    for cells that are there, inside and open."""

    def grid(column, by, kind) -> np.ndarray:
        a = np.full(shape, by, kind)
        a[at] = column
        return a

    vs = [grid(pdf[v].to_numpy(np.float64, na_value=np.nan), np.nan, float) for v in values]
    if missing_above is not None:
        bad = np.abs(vs[0]) > missing_above
        for v in vs:
            v[bad] = np.nan
    flag = lambda c: pdf[c].fillna(False).astype(bool).to_numpy()
    return vs, grid(pdf[zone].fillna(-1), -1, np.int32), grid(1 + 2 * flag(inside) + 4 * flag(open_), 0, np.uint8)


def _pass(p: int, z: np.ndarray, flags: np.ndarray, limits: _Limits, level: object) -> tuple[np.ndarray, np.ndarray | None, int | np.ndarray]:
    """Where the p-th pass may fill, the zones that it keeps to, and its rounds."""
    there, inside, open_ = ((flags & b) > 0 for b in (1, 2, 4))
    if p == 2:
        return there, None, limits.rounds[2] if level is None else (limits.levels or {}).get(int(level), limits.rounds[2])
    n = np.full(z.shape, limits.rounds[p])
    for k, own in limits.zones[p].items():
        n[z == k] = own
    return there & inside & open_ if p == 0 else there & inside, z, n


_STRIP = "array<struct<tile: string, y: int, x: int, h: int, w: int, data: binary>>"


def fill_tiled(df: DataFrame, keys: Sequence[str], values: Sequence[str], rounds: tuple[int, int, int] = (20, 120, 5), zone: str = "zone", inside: str = "inside", open_: str = "open", missing_above: float | None = None, zone_rounds: tuple[dict[int, int], dict[int, int]] = ({}, {}), level: str | None = None, level_rounds: dict[int, int] | None = None, size: int = 512, step: int = 40) -> DataFrame:
    """fill_horizontal() for slabs of any extent: a task holds one tile.

    Slabs are cut into tiles of `size` cells, each with a margin as wide as
    `step` rounds reach. A step runs so many rounds on every tile, which are
    exact within the margin, keeps the tile's own cells and sends the strips that
    changed to the neighbours whose margin they are in. Tiles lie in buckets, so
    that only strips are exchanged; each step is written, and a pass ends when
    its rounds do or no cell was filled in a step. Tiles that nothing reaches are
    handed on as they are.
    """
    margin = _REACH * step
    if margin > size:
        raise ValueError("a step reaches beyond the next tile")
    wide = size + 2 * margin
    own = slice(margin, margin + size)
    limits = _Limits(rounds, zone_rounds, level_rounds)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    named = ", ".join(f"{c} {kinds[c]}" for c in keys)
    lies = f"{named}, tile string, ty long, tx long, data binary, zone binary, flags binary, fresh boolean"
    state = f"{lies}, strips {_STRIP}, filled long"
    near = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1)]

    def side(c: str, t: str, a: int) -> Column:
        local = F.col(c) - F.col(t) * size
        return F.lit(True) if a == 0 else local < margin if a < 0 else local >= size - margin

    at = {"ty": F.floor(F.col("j") / size), "tx": F.floor(F.col("i") / size)}
    cells = df.select(*keys, "j", "i", *values, zone, inside, open_).withColumns(at)
    into = F.array(*[F.when(side("j", "ty", a) & side("i", "tx", b), F.struct((F.col("ty") + a).alias("ty"), (F.col("tx") + b).alias("tx"))) for a, b in near])
    cells = cells.drop("ty", "tx").withColumns(at).withColumn("into", F.explode(F.filter(into, lambda x: x.isNotNull()))).drop("ty", "tx").select("*", "into.ty", "into.tx").drop("into")
    name = lambda ty, tx: F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in keys], ty, tx)
    cells = cells.withColumn("tile", name(F.col("ty"), F.col("tx")))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        ty, tx = int(pdf.ty.iloc[0]), int(pdf.tx.iloc[0])
        y, x = ((pdf[c] - t * size + margin).to_numpy(int) for c, t in (("j", ty), ("i", tx)))
        vs, z, flags = _arrays(pdf, (wide, wide), (y, x), values, zone, inside, open_, missing_above)
        out = pdf[[*keys, "tile", "ty", "tx"]].iloc[:1].copy()
        if not flags[own, own].any():
            out = out.iloc[:0]
        return out.assign(data=np.stack(vs).tobytes(), zone=z.tobytes(), flags=flags.tobytes(), fresh=True)

    now = cells.groupBy(*keys, "tile", "ty", "tx").applyInPandas(pack, lies)
    now = bucketed(now.withColumns({"strips": F.lit(None).cast(_STRIP), "filled": F.lit(0).cast("long")}), "tile", "fill-tiles")

    def run(p: int, done: int):
        def advance(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in pdfs:
                for row in pdf.to_dict("records"):
                    got = row.pop("got")
                    got = [] if got is None else list(got)
                    if not (row["fresh"] or len(got) or done == 0):
                        yield pd.DataFrame([row | {"strips": [], "filled": 0}])
                        continue
                    data = np.frombuffer(row["data"]).reshape(-1, wide, wide).copy()
                    for s in got:
                        data[:, s["y"] : s["y"] + s["h"], s["x"] : s["x"] + s["w"]] = np.frombuffer(s["data"]).reshape(len(data), s["h"], s["w"])
                    z = np.frombuffer(row["zone"], np.int32).reshape(wide, wide)
                    flags = np.frombuffer(row["flags"], np.uint8).reshape(wide, wide)
                    allowed, by, n = _pass(p, z, flags, limits, row[level] if level else None)
                    new = fill_slab(list(data), allowed, by, n, begin=done, end=done + step)
                    changed = np.isnan(data[0, own, own]) & ~np.isnan(new[0][own, own])
                    data[:, own, own] = np.stack(new)[:, own, own]
                    strips = []
                    edge = {-1: (slice(0, margin), margin + size), 0: (slice(0, size), margin), 1: (slice(size - margin, size), 0)}
                    for a, b in near:
                        (rows, y), (columns, x) = edge[a], edge[b]
                        if (a or b) and changed[rows, columns].any():
                            part = np.ascontiguousarray(data[:, own, own][:, rows, columns])
                            to = "/".join([*row["tile"].split("/")[:-2], str(row["ty"] + a), str(row["tx"] + b)])
                            strips.append({"tile": to, "y": y, "x": x, "h": part.shape[1], "w": part.shape[2], "data": part.tobytes()})
                    yield pd.DataFrame([row | {"data": data.tobytes(), "strips": strips, "fresh": bool(changed.any()), "filled": int(changed.sum())}])

        return advance

    columns = now.columns
    for p in range(3):
        done = 0
        while done < limits.most(p):
            sent = now.select(F.explode("strips").alias("s")).select("s.*").groupBy("tile")
            sent = sent.agg(F.collect_list(F.struct("y", "x", "h", "w", "data")).alias("got"))  # eight at most
            met = now.drop("strips", "filled").join(sent, "tile", "left").select(*[c for c in columns if c not in ("strips", "filled")], "got")
            now = bucketed(met.mapInPandas(run(p, done), state), "tile", "fill-tiles")
            done += step
            if not now.agg(F.sum("filled")).first()[0]:
                break

    def unpack(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            for row in pdf.to_dict("records"):
                data = np.frombuffer(row["data"]).reshape(-1, wide, wide)[:, own, own]
                y, x = np.nonzero(np.frombuffer(row["flags"], np.uint8).reshape(wide, wide)[own, own])
                out = {c: row[c] for c in keys} | {"j": y + row["ty"] * size, "i": x + row["tx"] * size}
                yield pd.DataFrame(out | {v: data[k][y, x] for k, v in enumerate(values)})

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keys, "j", "i", *values).schema)
    return now.select(*keys, "ty", "tx", "data", "flags").mapInPandas(unpack, schema)


def fill_bins(deltas: DataFrame, key: str, s_bin: str, t_bin: str, value: str, n: int) -> DataFrame:
    """Fill missing bins of each key's n x n histogram from the mean of their
    filled neighbours of eight, round by round until none is left; edge bins
    just have fewer. n * n rows a group by construction."""
    schema = f"{key} {dict(deltas.dtypes)[key]}, {s_bin} int, {t_bin} int, {value} double"

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        g = np.full((n + 2, n + 2), np.nan)
        g[pdf[s_bin] + 1, pdf[t_bin] + 1] = pdf[value].to_numpy(np.float64, na_value=np.nan)
        inner = (slice(1, n + 1), slice(1, n + 1))
        while np.isnan(g[inner]).any() and not np.isnan(g[inner]).all():
            near = np.stack([g[1 + a : n + 1 + a, 1 + b : n + 1 + b] for a in (-1, 0, 1) for b in (-1, 0, 1) if a or b])
            count = (~np.isnan(near)).sum(0)
            mean = np.nansum(near, 0) / np.maximum(count, 1)
            take = np.isnan(g[inner]) & (count > 0)
            g[inner] = np.where(take, mean, g[inner])
        s, t = np.indices((n, n))
        return pd.DataFrame({key: pdf[key].iloc[0], s_bin: s.ravel().astype(np.int32), t_bin: t.ravel().astype(np.int32), value: g[inner].ravel()})

    return deltas.groupBy(key).applyInPandas(one, schema)


def fill_nearest(df: DataFrame, value: str, inside: str, i: str = "i", j: str = "j", keys: Sequence[str] = ()) -> DataFrame:
    """Missing cells inside a mask take the value of the nearest cell of their
    keys that has one (ties: lowest j, then i), however far: an exact distance
    transform, linear in the cells. Of rows that share a cell the lowest value
    is taken."""
    df = written(df, "fill-cells")
    at = [*keys, F.col(i).alias("i"), F.col(j).alias("j")]
    want = df.where(F.col(value).isNull() & F.col(inside)).select(*at)
    have = df.where(F.col(value).isNotNull()).select(*at, F.col(value).alias("__v")).groupBy(*keys, "i", "j").agg(F.min("__v").alias("__v"))
    found = nearest_sources(want, have, keys)
    found = found.join(have.withColumnsRenamed({"i": "source_i", "j": "source_j"}), [*keys, "source_i", "source_j"])
    found = found.select(*keys, F.col("i").alias(i), F.col("j").alias(j), "__v")
    filled = F.when(F.col(value).isNull() & F.col(inside), F.col("__v")).otherwise(F.col(value))
    return df.join(found, [*keys, i, j], "left").withColumn(value, filled).drop("__v")


def fill_linear(df: DataFrame, value: str, inside: str, i: str = "i", j: str = "j") -> DataFrame:
    """Missing cells inside a mask from the nearest cells that have a value left,
    right, below and above, weighted by inverse distance; the rest, whose row and
    column have none, from the nearest cell that has a value or got one so."""
    num, den = F.lit(0.0), F.lit(0.0)
    out = df
    for n, (by, along) in enumerate(((j, i), (i, j))):
        for m, order in enumerate((F.col(along).asc(), F.col(along).desc())):
            w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
            pick = F.when(F.col(value).isNotNull(), F.struct(F.col(value).alias("v"), F.col(along).alias("at")))
            name = f"__{n}{m}"
            out = out.withColumn(name, F.last(pick, True).over(w))
            weight = F.when(F.col(name).isNotNull(), 1 / F.abs(F.col(along) - F.col(f"{name}.at"))).otherwise(0.0)
            num, den = num + weight * F.coalesce(F.col(f"{name}.v"), F.lit(0.0)), den + weight
    filled = F.when(F.col(value).isNull() & F.col(inside) & (den > 0), num / den).otherwise(F.col(value))
    return fill_nearest(out.withColumn(value, filled).drop("__00", "__01", "__10", "__11"), value, inside, i, j)
