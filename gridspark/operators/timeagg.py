"""Means over time: climatologies, annual means, spreads, window filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def weighted_mean(value: str, weight: str, skipna: bool = False) -> Column:
    """Weighted mean of a group. By default a missing value counts as 0 while its
    weight stays in the denominator; with skipna both are left out."""
    if skipna:
        return F.sum(F.col(value) * F.col(weight)) / F.sum(F.when(F.col(value).isNotNull(), F.col(weight)))
    return F.sum(F.coalesce(F.col(value), F.lit(0.0)) * F.col(weight)) / F.sum(weight)


def window_mean(df: DataFrame, keys: Sequence[str], value: str, weight: str, year: str, first: int, last: int, skipna: bool = False, out: str = "mean") -> DataFrame:
    """Mean by keys over the years first..last, both kept, weighted by days."""
    return df.where(F.col(year).between(first, last)).groupBy(*keys).agg(weighted_mean(value, weight, skipna).alias(out))


def annual_mean(df: DataFrame, keys: Sequence[str], value: str, weight: str, year: str, month: str, skipna: bool = False, strict: bool = False) -> DataFrame:
    """Monthly to annual means by days in month, with the number of months.

    strict: fail, naming the years, if one has not exactly 12 months.
    """
    out = df.groupBy(*keys, year).agg(weighted_mean(value, weight, skipna).alias("mean"), F.countDistinct(month).alias("n_months"))
    if strict:
        bad = [r[0] for r in out.where("n_months <> 12").select(year).distinct().orderBy(year).limit(20).collect()]
        if bad:
            raise ValueError(f"years without 12 months: {bad}")
    return out


def missing_years(df: DataFrame, keys: Sequence[str], year: str, first: int, last: int) -> DataFrame:
    """Keys and years of first..last that have no row."""
    want = df.select(*keys).distinct().withColumn(year, F.explode(F.sequence(F.lit(first), F.lit(last))))
    return want.join(df.select(*keys, year).distinct(), [*keys, year], "left_anti")


def mean_and_error(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Mean and standard error (population deviation over the root of n)."""
    return df.groupBy(*keys).agg(F.avg(value).alias("mean"), (F.stddev_pop(value) / F.sqrt(F.count(value))).alias("error"))


def mean_and_spread(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Mean and spread over members, years or both: root of E[x2] - E[x]2."""
    return df.groupBy(*keys).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("spread"))


def time_slice(df: DataFrame, time: str, first_year: int, last_year: int) -> DataFrame:
    """Label slice from 1 January of first_year to 1 January after last_year,
    inclusive at both ends."""
    t = F.col(time)
    return df.where((t >= F.make_date(F.lit(first_year), F.lit(1), F.lit(1))) & (t <= F.make_date(F.lit(last_year + 1), F.lit(1), F.lit(1))))


def last_steps_but_one(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int = 20) -> DataFrame:
    """Of each key the n steps before the final one."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("__step", F.row_number().over(w)).where(F.col("__step").between(2, n + 1)).drop("__step")


def time_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, out: str = "block") -> DataFrame:
    """Number consecutive steps of each key in blocks of n."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, F.floor((F.dense_rank().over(w) - 1) / n).cast("int"))


def at_points(df: DataFrame, points: DataFrame, on: Sequence[str]) -> DataFrame:
    """The series of the points named in a small table."""
    return df.join(points.select(*on).distinct(), list(on), "left_semi")
