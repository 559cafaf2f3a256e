"""Every query by name, with its SQL where SQL can express it."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return add


for _name in ("time", "masks", "zonal", "vertical", "distributions", "regridding", "labels", "calibration", "scenarios", "sources"):
    importlib.import_module(f"gridspark.plans.{_name}_queries")
