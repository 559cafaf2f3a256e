"""Scalar conversions: coordinates, units, names, text, missing values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename to a standard; fail if a name to map is not there."""
    missing = set(names) - set(df.columns)
    if missing:
        raise ValueError(f"columns are missing: {sorted(missing)}")
    return df.withColumnsRenamed(names)


def lon_360(lon: Column) -> Column:
    return F.pmod(lon, F.lit(360.0))


def lon_180(lon: Column) -> Column:
    return F.pmod(lon + 180, F.lit(360.0)) - 180


def clip_lat(lat: Column, low: float = -85.0, high: float = 90.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), lat))


def rate_to_gt(rate: Column, dx: float) -> Column:
    """kg per square metre and year in cells dx wide to Gt a year."""
    return rate * (dx * dx / 1e12)


def mass_to_metres(rate: Column, density: float) -> Column:
    return rate / density


def km3_to_gt(volume: Column, density: float) -> Column:
    return volume * density / 1000


def cm_to_m(value: Column) -> Column:
    return value / 100


def datenum_to_date(number: Column) -> Column:
    """Days counted as in MATLAB to a date."""
    return F.date_add(F.lit("1970-01-01").cast("date"), (number - 719529).cast("int"))


def year_range(name: Column) -> tuple[Column, Column]:
    """First and last year of a name that ends in _YYYY[MM]-YYYY[MM].suffix."""
    pattern = r"_(\d{4})\d{0,2}-(\d{4})\d{0,2}\."
    return tuple(F.nullif(F.regexp_extract(name, pattern, k), F.lit("")).cast("int") for k in (1, 2))


def annual_name(name: Column) -> Column:
    return F.replace(name, F.lit("Omon_"), F.lit("Oyr_"))


def value_and_error(text: Column) -> tuple[Column, Column]:
    """Numbers of "value ± error", whatever the minus sign and the spaces."""
    plain = F.translate(text, "−   ", "-")
    pattern = r"^([-+]?[\d.]+)(?:±|\+-|\+/-)([\d.]+)$"
    return tuple(F.nullif(F.regexp_extract(plain, pattern, k), F.lit("")).try_cast("double") for k in (1, 2))


def finite(value: Column) -> Column:
    """Null in place of NaN and infinities."""
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def fill(value: Column, by: float) -> Column:
    return F.coalesce(finite(value), F.lit(by))
