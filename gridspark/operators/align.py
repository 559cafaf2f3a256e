"""Alignment of tables by their full keys, lookups and blends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unmatched(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys that only one of two tables has, with the side that has them."""
    left = a.select(*on).distinct().withColumn("__a", F.lit(1))
    right = b.select(*on).distinct().withColumn("__b", F.lit(1))
    both = left.join(right, list(on), "full")
    return both.where("__a is null or __b is null").select(*on, F.when(F.col("__a").isNull(), "right").otherwise("left").alias("side"))


def align_exact(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join on the full key; fails unless both have the same keys."""
    if not unmatched(a, b, on).isEmpty():
        raise ValueError(f"the tables differ in {list(on)}")
    return a.join(b, list(on))


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables hold the same rows as often."""
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def subtract(df: DataFrame, offset: DataFrame, on: Sequence[str], value: str, by: str, out: str) -> DataFrame:
    """Subtract a field without time from every time step."""
    return df.join(offset, list(on)).withColumn(out, F.col(value) - F.col(by))


def replace_rows(a: DataFrame, b: DataFrame, key: str, keys: Sequence, value: str) -> DataFrame:
    """a with the value of b in the rows of the keys named."""
    other = b.where(F.col(key).isin(*keys)).select(key, F.col(value).alias("__new"))
    hit = F.col(key).isin(*keys)
    return a.join(other, key, "left").withColumn(value, F.when(hit, F.col("__new")).otherwise(F.col(value))).drop("__new")


def with_alias(df: DataFrame, aliases: dict[str, str], name: str, lookup: DataFrame, key: str) -> DataFrame:
    """Look names up after mapping aliases; a name without a match gets nulls."""
    mapped = F.col(name)
    if aliases:
        pairs = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
        mapped = F.coalesce(F.element_at(pairs, F.col(name)), F.col(name))
    return df.withColumn("__name", mapped).join(lookup.withColumnRenamed(key, "__name"), "__name", "left").drop("__name")


def blend(zone: str, rules: Sequence[tuple[int, int, Column]], rest: Column) -> Column:
    """The first rule (low, high, column) whose range has the zone, else rest."""
    out = None
    for low, high, col in rules:
        test = F.col(zone).between(low, high)
        out = F.when(test, col) if out is None else out.when(test, col)
    return out.otherwise(rest) if out is not None else rest


def pick(df: DataFrame, chosen: DataFrame, on: Sequence[str]) -> DataFrame:
    """The slice of an ensemble that a table of chosen keys names."""
    return df.join(chosen, list(on))


def consistent_levels(df: DataFrame, chunk: str, level: str) -> DataFrame:
    """Chunks whose levels, as a set, differ from those that most chunks have
    (ties: the smaller set in order); empty if all agree."""
    sets = df.groupBy(chunk).agg(F.array_sort(F.collect_set(level)).alias("levels"))
    common = sets.groupBy("levels").count().orderBy(F.col("count").desc(), "levels").limit(1).select(F.col("levels").alias("common"))
    return sets.join(F.broadcast(common), sets["levels"] != F.col("common")).select(chunk, F.size("levels").alias("n_levels"))


def stack(parts: dict[str, DataFrame], key: str) -> DataFrame:
    """Concatenate tables along a new key."""
    out = None
    for name, df in parts.items():
        df = df.withColumn(key, F.lit(name))
        out = df if out is None else out.unionByName(df)
    return out
