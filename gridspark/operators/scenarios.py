"""Scenario sets and gap-fill pipelines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridspark.operators import align, fill, masks, regrid, tiles, vertical
from gridspark.sources.staging import bucketed, written


def uniform_offsets(df: DataFrame, value: str, offsets: Sequence[float] = (0.5, 1.0, 2.0, 4.0)) -> DataFrame:
    """df for each offset added to a value, with the offset as the scenario."""
    out = df.withColumn("scenario", F.explode(F.array(*map(F.lit, map(float, offsets)))))
    return out.withColumn(value, F.col(value) + F.col("scenario"))


#: Fixed values of the contemporary pathways: the offset of temperatures, the
#: trend a year before RAMP_TO in the ramped regions, and the amplitude in
#: metres of the thermocline's shift.
OFFSET = {"main": 0.0, "cold": -0.17, "warm": 0.17, "vary": 0.0}
TREND = {"main": -0.00140, "cold": -0.00620, "warm": 0.00190, "vary": 0.0}
AMPLITUDE = {9: 120.0, 8: 100.0, 4: 100.0}
RAMP_SHARE = {8: 0.5, 9: 1.0}
BLENDED, COLDEST, RAMP_TO, BLEND_TO, TOP_LEVELS = 4, -1.9, 1995, 2015, 13


def contemporary(clim: DataFrame, t: str, s: str, zone: str, first: int = 1950, last: int = 2025, step: float = 60.0) -> DataFrame:
    """A climatology by year under the pathways main, cold, warm and vary.

    clim is in profile form: arrays t and s over levels `step` metres apart,
    downwards, and a zone. Cold and warm shift temperatures by a constant. All
    but vary have a linear trend up to RAMP_TO in some zones. Cold blends one
    zone from the coldest temperature, and its salinity from the mean of the
    upper levels, to the climatology in BLEND_TO. Vary moves profiles of some
    zones up and down by a cosine of the years, interpolated onto the levels,
    the ends held. All is array work in the row, after one explode.
    """
    z, year, scenario = F.col(zone), F.col("year"), F.col("scenario")

    def chosen(table: dict) -> Column:
        return F.coalesce(*[F.when(scenario == k, v) for k, v in table.items()])

    def by_zone(table: dict) -> Column:
        return F.coalesce(*[F.when(z == k, v) for k, v in table.items()], F.lit(0.0))

    years = F.explode(F.sequence(F.lit(first), F.lit(last)))
    out = clim.withColumn("year", years).withColumn("scenario", F.explode(F.array(*map(F.lit, OFFSET))))
    ramp = vertical.ramp_before(year, F.lit(0.0), chosen(TREND), by_zone(RAMP_SHARE), RAMP_TO)
    base = chosen(OFFSET) + F.when(year < RAMP_TO, ramp).otherwise(0.0)
    dz = vertical.cosine_shift(year, by_zone(AMPLITUDE))
    blended = (scenario == "cold") & (z == BLENDED) & (year < BLEND_TO)
    upper = F.slice(F.col(s), 1, TOP_LEVELS)
    mean = F.aggregate(upper, F.lit(0.0), lambda x, y: x + y) / F.size(upper)

    def blend(start: Column, x: Column) -> Column:
        return vertical.blend_to_pivot(year, start, x, first, BLEND_TO)

    def moved(values: str) -> Column:
        return vertical.profile_shift(F.col(values), dz, step)

    warm = F.transform(F.col(t), lambda x: x + base)
    new_t = F.when(scenario == "vary", moved(t)).when(blended, F.transform(warm, lambda x: blend(F.lit(COLDEST), x))).otherwise(warm)
    new_s = F.when(scenario == "vary", moved(s)).when(blended, F.transform(F.col(s), lambda x: blend(mean, x))).otherwise(F.col(s))
    return out.withColumns({t: new_t, s: new_s})


def replace_region(field: DataFrame, observed: DataFrame, keys: Sequence[str], region: str, value: str) -> DataFrame:
    """An observed profile (by the keys and region) replaces the field of its
    region wherever it has a value."""
    obs = observed.withColumnRenamed(value, "__obs")
    return field.join(obs, [*keys, region], "left").withColumn(value, F.coalesce("__obs", value)).drop("__obs")


def extrapolate(df: DataFrame, keys: Sequence[str], level: str, value: str, ice: str, threshold: float, rounds: tuple[int, int, int], source: Sequence[tuple[float, float]], target: Sequence[tuple[float, float]], size: int | None = None, **how) -> DataFrame:
    """Gap fill end to end: ice mask, horizontal fill by slab (with how), fill
    downward, and conservative resampling from the intervals of the fine levels
    (1, 2, ...) to those of the target levels. A climatology without time has no
    keys. size: slabs may be larger than a task holds and are filled by tiles of
    so many cells."""
    masked = df.withColumn(value, masks.under_ice(F.col(value), F.col(ice), threshold))
    if size is None:
        flat = fill.fill_horizontal(masked, [*keys, level], [value], rounds, level=level, **how)
    else:
        flat = fill.fill_tiled(masked, [*keys, level], [value], rounds, level=level, size=size, step=min(40, size // 3), **how)
    down = vertical.fill_down(flat, [*keys, "j", "i"], level, [value])
    spark = df.sparkSession
    weights = vertical.weights_table(spark, vertical.overlap_weights(source, target))
    thickness = spark.createDataFrame([(k, abs(b - a)) for k, (a, b) in enumerate(target, 1)], f"{level} int, dz double")
    return vertical.resample(down, weights, [*keys, "j", "i"], level, value, thickness)


def remap(df: DataFrame, time: str, level: str, value: str, source: Sequence[float], target: Sequence[float], weights: DataFrame, dst: Sequence[str], n_lon: int, grid: DataFrame) -> DataFrame:
    """A model's field on the target grid: validity from the first time,
    interpolation to the target levels of what is valid, divided by the validity,
    the first longitude column once more at the seam, then the horizontal
    weights, without renormalisation for the validity and with it for the data.
    Times whose levels differ are an error. Coordinates of the grid are attached.

    df has i, j, lon, the level (1, 2, ...), the time (a number) and the value;
    weights i, j, w and the dst columns. The field is exchanged once, to lie by
    tile; interpolation, packing and weights then run tile by tile, and data and
    validity come from one pass. A column repeated at the seam is a second weight
    of the first column's cells, so that no row is copied.
    """
    field = tiles.by_tile(df.select("i", "j", "lon", time, level, value), name="remap-field")
    first = Window.partitionBy("tile", "i", "j", level).orderBy(time)
    masked = field.withColumn("valid", F.first(F.col(value).isNotNull()).over(first)).withColumn(value, F.when(F.col("valid"), F.col(value)))
    w = vertical.weights_table(df.sparkSession, vertical.interpolation_weights(source, target))
    flat = vertical.interpolate_valid(masked, w, ["tile", time, "i", "j", "lon"], level, value)
    flat = bucketed(flat, "tile", "remap-levels")
    if not align.consistent_levels(flat, time, level).isEmpty():
        raise ValueError("times differ in their levels")
    if regrid.has_seam(flat, "i", "lon", n_lon):
        weights = weights.withColumn("i", F.when(F.col("i") == n_lon, 0).otherwise(F.col("i")))
    cells = tiles.packed(flat, [time, level], [value], time)
    data = tiles.apply_blocks(cells, tiles.weight_blocks(weights, dst), dst, [time, level], value, 1e-3, "valid")
    return masks.attach_coords(written(data.withColumnsRenamed({dst[0]: "i", dst[1]: "j"}), "remapped"), grid)
