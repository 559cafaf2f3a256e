"""Sums and means by zone, bin or region, and combined estimates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GT = 1e12


def zonal_sum(df: DataFrame, keys: Sequence[str], value: str, dx: float, out: str = "total") -> DataFrame:
    """Sum by keys of a rate per area, in Gt a year for cells dx wide; a sum of
    zero is missing."""
    return df.groupBy(*keys).agg(F.nullif(F.sum(F.col(value) * (dx * dx / GT)), F.lit(0.0)).alias(out))


def zonal_difference(warm: DataFrame, cold: DataFrame, keys: Sequence[str], value: str, sigma: str | None = None) -> DataFrame:
    """Zonal mean warm minus cold; sigma: root of the squared errors' sum."""

    def mean(df: DataFrame, n: str) -> DataFrame:
        more = [F.sqrt(F.avg(F.col(sigma) * F.col(sigma))).alias(f"s_{n}")] if sigma else []
        return df.groupBy(*keys).agg(F.avg(value).alias(f"m_{n}"), *more)

    out = mean(warm, "w").join(mean(cold, "c"), list(keys))
    cols = [(F.col("m_w") - F.col("m_c")).alias("difference")]
    if sigma:
        cols.append(F.sqrt(F.col("s_w") * F.col("s_w") + F.col("s_c") * F.col("s_c")).alias("sigma"))
    return out.select(*keys, *cols)


def mean_and_rms(df: DataFrame, keys: Sequence[str], value: str, error: str) -> DataFrame:
    """Zonal mean and root mean square of the errors."""
    return df.groupBy(*keys).agg(F.avg(value).alias("mean"), F.sqrt(F.avg(F.col(error) * F.col(error))).alias("error"))


def masked_mean(value: Column, mask: Column) -> Column:
    """Mean of a group weighted by a mask."""
    return F.sum(value * mask) / F.sum(mask)


def combine_estimates(values: Sequence[tuple[str, str]], skipna: bool = True) -> tuple[Column, Column]:
    """Of (value, error) columns the mean, and half the range from the least value
    minus error to the largest value plus error. skipna: missing estimates are
    left out; else one missing makes both missing."""
    some = [F.col(v) for v, _ in values]
    n = sum((F.when(v.isNotNull(), 1).otherwise(0) for v in some), F.lit(0))
    total = sum((F.coalesce(v, F.lit(0.0)) for v in some), F.lit(0.0))
    high = F.greatest(*[F.col(v) + F.col(e) for v, e in values])
    low = F.least(*[F.col(v) - F.col(e) for v, e in values])
    enough = n > 0 if skipna else n == len(values)
    return F.when(enough, total / n), F.when(enough, (high - low) / 2)


def error_sums(error: str) -> tuple[Column, Column]:
    """Of a group's errors: their sum if they are correlated, the root of the
    squares' sum if they are independent."""
    e = F.col(error)
    return F.sum(e), F.sqrt(F.sum(e * e))


def basin_totals(df: DataFrame, key: str, value: str, error: str, name: str, exclude: Sequence[str], most: int = 100, by_count: bool = True) -> DataFrame:
    """Totals by basin without named rows and without ids from `most` on; the
    error is the root of the squares' sum over the count, or the plain sum."""
    e = F.col(error)
    err = F.sqrt(F.sum(e * e)) / F.count("*") if by_count else F.sum(e)
    return df.where(~F.col(name).isin(*exclude) & (F.col(key) < most)).groupBy(key).agg(F.sum(value).alias("total"), err.alias("error"))


def coarsen(df: DataFrame, value: str, factor: int = 2, i: str = "i", j: str = "j", keys: Sequence[str] = ()) -> DataFrame:
    """Means of factor x factor blocks; blocks cut off by the edge go."""
    block = [F.floor(F.col(c) / factor).cast("int").alias(c) for c in (i, j)]
    out = df.groupBy(*keys, *block).agg(F.avg(value).alias(value), F.count("*").alias("__n"))
    return out.where(F.col("__n") == factor * factor).drop("__n")


def long_run_mean(df: DataFrame, key: str, columns: Sequence[str], out: str = "mean") -> DataFrame:
    """Average of one column per year: unpivoted, then averaged by key."""
    return df.unpivot([key], list(columns), "year", "value").groupBy(key).agg(F.avg("value").alias(out))


def time_to_offset(df: DataFrame, zone: str, which: int, time: str, value: str, baseline: float, digits: int = 2) -> DataFrame:
    """Turn time into the offset of a zone's mean from a baseline, rounded."""
    mean = df.where(F.col(zone) == which).groupBy(time).agg(F.round(F.avg(value) - baseline, digits).alias("offset"))
    return df.join(mean, time)
