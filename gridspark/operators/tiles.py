"""Fields that lie by tile: written once, bucketed by square tiles of the grid,
so that steps by cell and regridding exchange no field again.

A field's rows carry the column tile; every aggregation and window whose keys
have it runs where the rows are. For regridding a cell's times and levels are
packed into arrays, and the sparse weights into one block of arrays per source
tile, joined on the tile alone. Sums by destination are combined within each
tile, so that only the target's rows are exchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.sources.staging import bucketed

#: Cells of a tile's edge. A block of weights has SIZE * SIZE lists.
SIZE = 32
#: Times of one packed row at most, for times that are numbers.
CHUNK = 120


def tile(i: str = "i", j: str = "j", size: int = SIZE) -> Column:
    """The number of the tile that a cell is in; cells may be negative."""
    a, b = (F.floor(F.col(c) / size).cast("long") for c in (i, j))
    return b * (1 << 31) + a


def place(i: str = "i", j: str = "j", size: int = SIZE) -> Column:
    """A cell's place in its tile, row by row from 0."""
    return (F.pmod(F.col(j), F.lit(size)) * size + F.pmod(F.col(i), F.lit(size))).cast("int")


def by_tile(df: DataFrame, i: str = "i", j: str = "j", size: int = SIZE, name: str = "tiles") -> DataFrame:
    """df with its tile, written in buckets of tiles: the one exchange of a field."""
    return bucketed(df.withColumn("tile", tile(i, j, size)), "tile", name)


def packed(df: DataFrame, keys: Sequence[str], values: Sequence[str], time: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """(tile, i, j, e): a row per cell, and per `chunk` of the time's numbers if it
    is named; e are the cell's (keys, values), in no order. Exchanges nothing
    where df lies by tile."""
    part = [] if time is None else [F.floor(F.col(time) / chunk).alias("part")]
    return df.groupBy("tile", "i", "j", *part).agg(F.collect_list(F.struct(*keys, *values)).alias("e")).drop("part")


def weight_blocks(weights: DataFrame, dst: Sequence[str], size: int = SIZE, name: str = "weight-blocks") -> DataFrame:
    """(tile, own): the weights (i, j, dst, w) of each source tile; own has, at
    each cell's place, its list of (dst, w)."""
    w = weights.withColumns({"tile": tile(size=size), "at": place(size=size)})
    own = w.groupBy("tile", "at").agg(F.collect_list(F.struct(*dst, "w")).alias("to"))
    own = own.groupBy("tile").agg(F.map_from_entries(F.collect_list(F.struct("at", "to"))).alias("m"))
    lists = F.transform(F.sequence(F.lit(0), F.lit(size * size - 1)), lambda k: F.try_element_at("m", k))
    return bucketed(own.select("tile", lists.alias("own")), "tile", name)


def apply_blocks(cells: DataFrame, blocks: DataFrame, dst: Sequence[str], keys: Sequence[str], value: str, renormalize: float | None = None, share: str | None = None, size: int = SIZE) -> DataFrame:
    """(keys, dst, value) and the covered weight as `share`, if named: the sums of
    weight * value by destination and keys, nulls adding nothing. renormalize:
    divided by the covered weight where it exceeds this, else null.

    cells is packed(), blocks weight_blocks(): cells without weights and weights
    without cells add nothing.
    """
    met = cells.join(blocks, "tile").select("e", F.explode(F.get("own", place(size=size))).alias("to"))
    rows = met.select("to", F.explode("e").alias("x"))
    v, w = F.col(f"x.{value}"), F.col("to.w")
    group = [*[F.col(f"x.{c}").alias(c) for c in keys], *[F.col(f"to.{c}").alias(c) for c in dst]]
    out = rows.groupBy(*group).agg(F.sum(v * w).alias("__x"), F.sum(F.when(v.isNotNull(), w).otherwise(0.0)).alias("__w"))
    x = F.col("__x") if renormalize is None else F.when(F.col("__w") > renormalize, F.col("__x") / F.col("__w"))
    return out.select(*keys, *dst, x.alias(value), *([F.col("__w").alias(share)] if share else []))
