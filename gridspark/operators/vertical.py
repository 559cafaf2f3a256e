"""Operators along an ordered axis.

The long form has one row per level. The profile form has one row per column
with an array over levels; there every operator is array work in the row, so
that columns need no shuffle at all.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridspark.sources.bounded import join_bounded


def _along(keys: Sequence[str], level: str):
    return Window.partitionBy(*keys).orderBy(level)


def fill_down(df: DataFrame, keys: Sequence[str], level: str, values: Sequence[str], first_from_second: bool = True, start: int | None = None) -> DataFrame:
    """Fill level 1 from level 2, then each missing level from the one above.
    start: filling begins at this level, so that the one before it stays as is."""
    w = _along(keys, level)
    down = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = df
    for v in values:
        first = F.row_number().over(w) == 1
        top = F.coalesce(F.col(v), F.lead(v).over(w)) if first_from_second else F.col(v)
        out = out.withColumn(f"__{v}", F.when(first, top).otherwise(F.col(v)))
    for v in values:
        filled = F.last(f"__{v}", True).over(down)
        if start is not None:
            filled = F.when(F.row_number().over(w) >= start, filled).otherwise(F.col(f"__{v}"))
        out = out.withColumn(f"__f_{v}", filled)
    return out.withColumns({v: F.col(f"__f_{v}") for v in values}).drop(*[f"__{v}" for v in values], *[f"__f_{v}" for v in values])


def fill_both(df: DataFrame, keys: Sequence[str], level: str, value: str) -> DataFrame:
    """Fill forward, then backward, along depth."""
    w = _along(keys, level)
    forward = F.last(value, True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    back = F.first(value, True).over(w.rowsBetween(0, Window.unboundedFollowing))
    return df.withColumn("__v", F.coalesce(forward, back)).drop(value).withColumnRenamed("__v", value)


def interpolation_weights(source: Sequence[float], target: Sequence[float], extrapolate: bool = True) -> list[tuple[int, int, float]]:
    """(target level, source level, weight) from 1, of linear interpolation; the
    axes may run either way. Beyond the source's ends linear, or left out."""
    order = sorted(range(len(source)), key=lambda k: source[k])
    out = []
    for t, z in enumerate(target, 1):
        if len(source) == 1:
            if extrapolate or z == source[0]:
                out.append((t, 1, 1.0))
            continue
        hi = next((n for n in range(1, len(order)) if source[order[n]] >= z), len(order) - 1)
        a, b = order[hi - 1], order[hi]
        if not extrapolate and not source[a] <= z <= source[b]:
            continue
        w = (z - source[a]) / (source[b] - source[a])
        out += [(t, a + 1, 1.0 - w), (t, b + 1, w)]
    return out


def overlap_weights(source: Sequence[tuple[float, float]], target: Sequence[tuple[float, float]]) -> list[tuple[int, int, float]]:
    """(target, source, overlap) of intervals, numbered from 1."""
    out = []
    for t, (a, b) in enumerate(target, 1):
        for s, (x, y) in enumerate(source, 1):
            w = min(max(a, b), max(x, y)) - max(min(a, b), min(x, y))
            if w > 0:
                out.append((t, s, float(w)))
    return out


def weights_table(spark, weights: Sequence[tuple[int, int, float]]) -> DataFrame:
    """A weight table of the axes' length squared at most, to be broadcast."""
    return spark.createDataFrame([*weights], "dst int, src int, w double")


def interpolate(df: DataFrame, weights: DataFrame, keys: Sequence[str], level: str, value: str) -> DataFrame:
    """Weighted sums on a new axis; null where a level it needs is null or not
    there. One equi-join with a small table and one aggregation."""
    need = weights.where("w <> 0").withColumn("__n", F.count("*").over(Window.partitionBy("dst")))
    j = join_bounded(df, need, F.col(level) == F.col("src"))
    out = j.groupBy(*keys, "dst").agg(F.sum(F.col(value) * F.col("w")).alias(value), F.count(value).alias("__c"), F.max("__n").alias("__n"))
    return out.select(*keys, F.col("dst").alias(level), F.when(F.col("__c") == F.col("__n"), F.col(value)).alias(value))


def interpolate_valid(df: DataFrame, weights: DataFrame, keys: Sequence[str], level: str, value: str, threshold: float = 1e-3) -> DataFrame:
    """Interpolate the value with nulls as 0 and the validity, and divide where
    the validity exceeds the threshold."""
    j = join_bounded(df, weights, F.col(level) == F.col("src"))
    valid = F.when(F.col(value).isNotNull(), F.col("w")).otherwise(0.0)
    out = j.groupBy(*keys, "dst").agg(F.sum(F.coalesce(F.col(value), F.lit(0.0)) * F.col("w")).alias("__v"), F.sum(valid).alias("__f"))
    return out.select(*keys, F.col("dst").alias(level), F.when(F.col("__f") > threshold, F.col("__v") / F.col("__f")).alias(value))


def resample(df: DataFrame, weights: DataFrame, keys: Sequence[str], level: str, value: str, thickness: DataFrame, threshold: float = 0.0) -> DataFrame:
    """Conservative resampling by interval overlap: nulls leave the numerator and
    the denominator; a level stays if more than `threshold` of its thickness
    (column dz of a table by level) is covered."""
    j = join_bounded(df, weights, F.col(level) == F.col("src"))
    some = F.when(F.col(value).isNotNull(), F.col("w"))
    out = j.groupBy(*keys, "dst").agg(F.sum(F.col(value) * F.col("w")).alias("__v"), F.sum(some).alias("__w"))
    out = join_bounded(out, thickness.select(F.col(level).alias("dst"), "dz"), "dst")
    return out.select(*keys, F.col("dst").alias(level), F.when(F.col("__w") / F.col("dz") > threshold, F.col("__v") / F.col("__w")).alias(value))


def first_time_valid(df: DataFrame, keys: Sequence[str], time: str, values: Sequence[str]) -> DataFrame:
    """Of each key, whether all values are there at the first time."""
    ok = F.lit(True)
    for v in values:
        ok = ok & F.col(v).isNotNull()
    first = df.groupBy(*keys).agg(F.min_by(F.struct(ok.alias("ok")), F.col(time)).alias("s"))
    return first.select(*keys, F.col("s.ok").alias("valid"))


def level_bounds(df: DataFrame, keys: Sequence[str], z: str, level: str) -> DataFrame:
    """Bounds halfway between levels; the ends mirror their inner bound."""
    w = _along(keys, level)
    up, down = F.lag(z).over(w), F.lead(z).over(w)
    lo = (F.coalesce(up, 2 * F.col(z) - down) + F.col(z)) / 2
    hi = (F.coalesce(down, 2 * F.col(z) - up) + F.col(z)) / 2
    return df.withColumns({"z_lo": lo, "z_hi": hi})


def positive_up(df: DataFrame, keys: Sequence[str], z: str, level: str, unit: str = "m", positive: str | None = None) -> DataFrame:
    """z in metres, positive up. Without a label the sign of the last level
    tells; a label at odds with it is an error."""
    w = _along(keys, level).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    scaled = F.col(z) / 100 if unit == "cm" else F.col(z)
    end = F.last(z).over(w)
    if positive is None:
        return df.withColumn(z, F.when(end > 0, -scaled).otherwise(scaled))
    odd = (end > 0) if positive == "up" else (end < 0)
    text = F.lit(f"the values of {z} do not run {positive}")
    value = -scaled if positive == "down" else scaled
    return df.withColumn(z, F.when(odd, F.raise_error(text).cast("double")).otherwise(value))


def shift(df: DataFrame, keys: Sequence[str], level: str, z: str, value: str, dz: Column, step: float) -> DataFrame:
    """Move a profile on evenly spaced levels up by dz, interpolate it back onto
    its levels and hold the end values beyond them."""
    w = _along(keys, level)
    n = F.count("*").over(Window.partitionBy(*keys))
    rows = df.withColumn("__k", F.row_number().over(w)).withColumn("__n", n)
    arrays = rows.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("__k", value))), lambda x: x[value]).alias("__a"))
    rows = rows.join(arrays, list(keys))
    # levels go down by `step`: the value now at z was dz below it, dz / step levels on
    at = F.least(F.greatest(F.col("__k") + dz / step, F.lit(1.0)), F.col("__n").cast("double"))
    lo = F.floor(at).cast("int")
    a, b = F.try_element_at("__a", lo), F.try_element_at("__a", F.least(lo + 1, F.col("__n").cast("int")))
    frac = at - lo
    return rows.withColumn("shifted", F.when(frac == 0, a).otherwise(a + (b - a) * frac)).drop("__k", "__n", "__a")


def nearest_level(df: DataFrame, depth: DataFrame, keys: Sequence[str], z: str, value: str, at: str) -> DataFrame:
    """The value at the level nearest to a depth of each column (ties: the upper)."""
    j = df.join(depth, list(keys))
    return j.groupBy(*keys).agg(F.min_by(F.struct(F.col(value).alias("v")), F.struct(F.abs(F.col(z) - F.col(at)), -F.col(z))).getField("v").alias(value))


def at_depth(df: DataFrame, depth: DataFrame, keys: Sequence[str], level: str, z: str, value: str, at: str) -> DataFrame:
    """Linear interpolation to a depth of each column; null outside its levels."""
    w = _along(keys, level)
    pairs = df.withColumns({"__z": F.lead(z).over(w), "__v": F.lead(value).over(w)}).join(depth, list(keys))
    t = F.col(at)
    inside = (F.col("__z").isNull() & (t == F.col(z))) | ((t <= F.col(z)) & (t > F.col("__z")))
    v = F.when(t == F.col(z), F.col(value)).otherwise(F.col(value) + (F.col("__v") - F.col(value)) * (t - F.col(z)) / (F.col("__z") - F.col(z)))
    found = pairs.where(inside).select(*keys, v.alias(value))
    return depth.select(*keys).join(found, list(keys), "left")


def cosine_shift(year: Column, amplitude: Column, origin: int = 2008, period: float = 16.0) -> Column:
    """A depth shift that varies as a cosine of time."""
    return amplitude * F.cos(F.lit(2 * math.pi) * (year - origin) / period)


def ramp_before(year: Column, value_at_pivot: Column, factor: Column, mask: Column, pivot: int) -> Column:
    """The pivot's value plus factor a year, back in time from the pivot."""
    return value_at_pivot + factor * (pivot - year) * mask


def blend_to_pivot(year: Column, constant: Column, value_at_pivot: Column, first: int, pivot: int) -> Column:
    """From a constant at `first` linearly to the pivot's value."""
    w = (year - first) / float(pivot - first)
    return constant + (value_at_pivot - constant) * F.least(F.greatest(w, F.lit(0.0)), F.lit(1.0))


def to_profiles(df: DataFrame, keys: Sequence[str], level: str, value: str, n: int) -> DataFrame:
    """Long to profile form: an array over levels 1..n, null where no row is."""
    got = df.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(level, value))).alias("__m"))
    return got.select(*keys, F.transform(F.sequence(F.lit(1), F.lit(n)), lambda k: F.try_element_at(F.col("__m"), k)).alias(value))


def profile_fill_both(value: Column) -> Column:
    """fill_both on an array, in the row."""

    def near(x: Column, i: Column) -> Column:
        before = F.filter(F.slice(value, F.lit(1), i + 1), lambda y: y.isNotNull())
        after = F.filter(F.slice(value, i + 1, F.size(value)), lambda y: y.isNotNull())
        return F.coalesce(x, F.when(F.size(before) > 0, F.element_at(before, -1)), F.get(after, F.lit(0)))

    return F.transform(value, near)


def profile_shift(value: Column, dz: Column, step: float) -> Column:
    """shift on an array, in the row: the profile moved up by dz, interpolated
    onto its levels (`step` apart, downwards), the ends held."""
    n = F.size(value)

    def at(_: Column, i: Column) -> Column:
        p = F.least(F.greatest(i + dz / step, F.lit(0.0)), (n - 1).cast("double"))
        low = F.floor(p).cast("int")
        a, b = F.get(value, low), F.get(value, F.least(low + 1, n - 1))
        return F.when(p == low, a).otherwise(a + (b - a) * (p - low))

    return F.transform(value, at)


def profile_resample(value: Column, weights: Sequence[tuple[int, int, float]], thickness: Sequence[float], threshold: float = 0.0) -> Column:
    """resample on an array, in the row: the weights are literals of the plan."""
    out = []
    for t, dz in enumerate(thickness, 1):
        own = [(F.get(value, F.lit(s - 1)), w) for d, s, w in weights if d == t]
        num = sum((F.coalesce(v, F.lit(0.0)) * w for v, w in own), F.lit(0.0))
        den = sum((F.when(v.isNotNull(), w).otherwise(0.0) for v, w in own), F.lit(0.0))
        out.append(F.when(den / dz > threshold, num / den))
    return F.array(*out)
