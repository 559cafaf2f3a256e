"""Nearest source cells on a grid by an exact distance transform in two passes.

Along each column windows find, for every row that asks, the nearest source of
that column. Along each asking row the columns' distances are parabolas, whose
lower envelope gives each cell its nearest source. Work is linear in the cells
of the asking rows, however wide a hole is.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def envelope(place: Sequence[int], height: Sequence[int], rank: Sequence[int]) -> tuple[list[int], list[int]]:
    """Of parabolas (x - place) ** 2 + height ** 2 with rising places: those that
    are lowest at some whole x, and the x from which each is. Where two are
    alike the lower rank wins; ranks run from 0 and are all different."""
    k = len(place) + 1
    base = [k * (p * p + h * h) + r for p, h, r in zip(place, height, rank)]
    low: list[int] = []
    start: list[int] = []
    for q in range(len(place)):
        x = None
        while low:
            p = low[-1]
            x = (base[q] - base[p]) // (2 * k * (place[q] - place[p])) + 1  # q is lower from here on
            if len(low) > 1 and x <= start[-1]:
                low.pop()
                start.pop()
            else:
                break
        start.append(place[0] if x is None else x)
        low.append(q)
    return low, start


def _row(place: np.ndarray, row: np.ndarray, height: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For cells at x the place and the row of the nearest source; places rise."""
    rank = np.empty(len(place), np.int64)
    rank[np.lexsort((place, row))] = np.arange(len(place))
    low, start = envelope(place.tolist(), height.tolist(), rank.tolist())
    # starts that lie before the first place are of cells further left
    at = np.maximum(np.searchsorted(np.array(start[1:], np.int64), x, "right"), 0)
    best = np.array(low)[at]
    return place[best], row[best]


def _begins(t: pa.Table, by: Sequence[str]) -> np.ndarray:
    """Places of rows, but the first, that differ from the one before in `by`."""
    new = np.zeros(max(t.num_rows - 1, 0), bool)
    for c in by:
        code = t[c].combine_chunks().dictionary_encode(null_encoding="encode").indices
        new |= np.diff(code.to_numpy()) != 0
    return np.flatnonzero(new) + 1


def _whole(batches: Iterator[pa.RecordBatch], by: Sequence[str]) -> Iterator[pa.Table]:
    """Batches sorted by `by`, dealt anew so that rows alike in it stay together."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        before = [held[-1].slice(held[-1].num_rows - 1)] if held else []
        new = _begins(pa.Table.from_batches([*before, b]), by)
        if len(new):
            last = int(new[-1]) - len(before)
            yield pa.Table.from_batches([*held, b.slice(0, last)])
            held = [b.slice(last)]
        else:
            held.append(b)
    if held:
        yield pa.Table.from_batches(held)


def nearest_sources(asking: DataFrame, sources: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, i, j, source_i, source_j, d2) of every asking cell (keys, i, j): the
    nearest source cell of its keys in a straight line (ties: lowest j, then i)
    and the square of the distance. Cells whose keys have no source are left out.
    Cells are whole numbers and need not fill a grid; a task holds one Arrow
    batch at a time, or one row of the grid if that is longer."""
    keys = list(keys)
    kinds = dict(asking.dtypes)
    asks = asking.select(*keys, F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j")).distinct()
    have = sources.select(*keys, F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j")).distinct()
    rows = asks.select(*keys, "j").distinct()
    ends = rows.groupBy(*keys).agg(F.min("j").alias("__a"), F.max("j").alias("__b"))
    columns = have.select(*keys, "i").distinct()
    columns = columns.join(ends, keys) if keys else columns.join(F.broadcast(ends))  # one row without keys
    box = columns.where("__a is not null").select(*keys, "i", F.explode(F.sequence("__a", "__b")).alias("j")).join(rows, [*keys, "j"], "left_semi")
    both = have.withColumn("at", F.col("j")).unionByName(box.withColumn("at", F.lit(None).cast("long")))
    upto = [Window.partitionBy(*keys, "i").orderBy(o).rangeBetween(Window.unboundedPreceding, 0) for o in (F.col("j").asc(), F.col("j").desc())]
    above, below = (F.last("at", True).over(w) for w in upto)
    both = both.withColumns({"above": above, "below": below}).where("at is null")
    source = F.when(F.col("below").isNull() | (F.col("j") - F.col("above") <= F.col("below") - F.col("j")), F.col("above")).otherwise(F.col("below"))
    found = both.select(*keys, "i", "j", source.alias("source_j")).withColumn("height", F.abs(F.col("j") - F.col("source_j")))
    nothing = F.lit(None).cast("long")
    met = found.unionByName(asks.withColumns({"source_j": nothing, "height": nothing}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole(batches, [*keys, "j"]):
            ends = [0, *_begins(t, [*keys, "j"]).tolist(), t.num_rows]
            i, j, row, high = (t[c].fill_null(0).to_numpy() for c in ("i", "j", "source_j", "height"))
            own = t["source_j"].is_valid().to_numpy()
            to_i, to_j, done = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64), np.zeros(len(i), bool)
            for a, b in zip(ends, ends[1:]):
                has = own[a:b]
                if has.all() or not has.any():
                    continue
                ask = a + np.flatnonzero(~has)
                to_i[ask], to_j[ask] = _row(i[a:b][has], row[a:b][has], high[a:b][has], i[ask])
                done[ask] = True
            i, j, to_i, to_j = i[done], j[done], to_i[done], to_j[done]
            out = [*t.select(keys).filter(pa.array(done)).columns, *map(pa.array, (i, j, to_i, to_j, (i - to_i) ** 2 + (j - to_j) ** 2))]
            yield from pa.table(out, names=[*keys, "i", "j", "source_i", "source_j", "d2"]).to_batches()

    named = "".join(f"{c} {kinds[c]}, " for c in keys)
    rows = met.repartition(*keys, "j").sortWithinPartitions(*keys, "j", "i")
    return rows.mapInArrow(run, f"{named}i long, j long, source_i long, source_j long, d2 long")
