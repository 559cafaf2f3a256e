"""Joins that broadcast a side only after a check of its size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_bounded(df: DataFrame, small: DataFrame, on, how: str = "inner", most: int = 20_000) -> DataFrame:
    """Join with a table of short rows that is broadcast only if it has at most
    `most` rows; beyond that Spark shuffles both (AQE splits hot keys)."""
    few = small.limit(most + 1).count() <= most
    return df.join(F.broadcast(small) if few else small, on, how)
