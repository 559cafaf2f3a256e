"""Bias correction against a climatology."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.operators import timeagg


def bias(model: DataFrame, observed: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Model climatology minus the observed one, by key."""
    obs = observed.select(*keys, F.col(value).alias("__obs"))
    return model.join(obs, list(keys)).select(*keys, (F.col(value) - F.col("__obs")).alias("bias"))


def classic(model: DataFrame, observed: DataFrame, keys: Sequence[str], value: str, weight: str, year: str, first: int, last: int, skipna: bool = False) -> DataFrame:
    """Every step of a model minus its mean bias over the window; observed has
    the climatology in a column mean."""
    clim = timeagg.window_mean(model, keys, value, weight, year, first, last, skipna)
    off = bias(clim, observed, keys, "mean")
    return model.join(off, list(keys)).withColumn("corrected", F.col(value) - F.col("bias"))
