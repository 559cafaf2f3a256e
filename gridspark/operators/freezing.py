"""Pressure, linear freezing points, thermal forcing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from pyspark.sql import functions as F

#: Coefficient sets: by salinity, constant, by pressure in Pa. The pressure term
#: of the first counts downward, that of the others is signed.
COEFFICIENTS = {
    "modelling": (-0.0572, 0.0788, -7.77e-8),
    "contemporary": (-0.0573, 0.0832, -7.53e-8),
    "declared": (-0.0564, 0.0773, -7.8633e-8),
}
RHO, G = 1028.0, 9.81


def hydrostatic_pressure(z: Column) -> Column:
    """Pa at height z (negative below the surface)."""
    return F.lit(RHO * G) * (-z)


def freezing_point(salinity: Column, pressure: Column, coefficients: str = "modelling") -> Column:
    a, b, c = COEFFICIENTS[coefficients]
    return F.lit(a) * salinity + b + F.lit(c) * pressure


def clip_to_freezing(temperature: Column, freezing: Column) -> tuple[Column, Column]:
    """Thermal forcing of at least 0, and the temperature of at least freezing."""
    return F.greatest(F.lit(0.0), temperature - freezing), F.when(temperature < freezing, freezing).otherwise(temperature)


def thermal_forcing(df: DataFrame, temperature: str, salinity: str, z: str, coefficients: str = "modelling") -> DataFrame:
    """df with tf and the clipped temperature; salinity passes through."""
    cf = freezing_point(F.col(salinity), hydrostatic_pressure(F.col(z)), coefficients)
    tf, ct = clip_to_freezing(F.col(temperature), cf)
    return df.withColumns({"tf": tf, temperature: ct})
