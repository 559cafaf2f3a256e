"""Masks, quality checks, topography classes, coordinates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.sources.bounded import join_bounded


def keep_variable(df: DataFrame, value: str, coords: Sequence[str]) -> DataFrame:
    """One variable and its coordinates; the rest goes before any shuffle."""
    return df.select(*coords, value)


def quality_mask(df: DataFrame, value: str, errors: Sequence[str], threshold: float) -> DataFrame:
    """Null where an error is not below the threshold; only if all the error
    columns are there."""
    if not set(errors) <= set(df.columns):
        return df
    good = F.lit(True)
    for e in errors:
        good = good & (F.col(e) < threshold)
    return df.withColumn(value, F.when(good, F.col(value)))


def under_ice(value: Column, ice_frac: Column, threshold: float) -> Column:
    """Null where the ice fraction exceeds the threshold."""
    return F.when(~(F.coalesce(ice_frac, F.lit(0.0)) > threshold), value)


def open_ocean(df: DataFrame, floating: str, grounded: str) -> DataFrame:
    """Cells with neither floating nor grounded ice."""
    return df.where((F.col(floating) == 0) & (F.col(grounded) == 0))


def in_range(value: Column, low: float, high: float, ice_frac: Column | None = None, most_ice: float = 0.5) -> Column:
    """Null outside low..high or under more ice than most_ice."""
    good = value.between(low, high)
    return F.when(good if ice_frac is None else good & (ice_frac <= most_ice), value)


def melt_or_zero(value: Column, most: float = 1e7) -> Column:
    """A missing or absurd melt rate counts as none."""
    return F.when(F.abs(value) <= most, value).otherwise(0.0)


#: Class codes of two topography sources: which codes make up each fraction.
CODES_A = {"ocean_frac": (0, 3), "rock_frac": (1,), "grounded_frac": (2, 4), "floating_frac": (3,)}
CODES_B = {"grounded_frac": (1,), "floating_frac": (2, 3), "rock_frac": (4,)}


def topography_fractions(mask: Column, codes: dict[str, Sequence[int]], null_is_ocean: bool = False) -> dict[str, Column]:
    """One-hot fractions of a class code; with null_is_ocean a null is open ocean."""
    out = {name: F.when(mask.isin(*c), 1.0).otherwise(0.0) for name, c in codes.items()}
    if null_is_ocean:
        out["ocean_frac"] = F.when(mask.isNull() | mask.isin(*codes.get("floating_frac", ())), 1.0).otherwise(0.0)
    return out


def draft(surface: Column, thickness: Column) -> Column:
    return surface - thickness


def restrict_member(value: Column, member: Column, zone: Column, name: str, zones: Sequence[int]) -> Column:
    """Null for one member outside the zones it is valid in."""
    return F.when((member != name) | zone.isin(*zones), value)


def zero_is_missing(value: Column) -> Column:
    return F.nullif(value, F.lit(0.0))


def attach_coords(df: DataFrame, horizontal: DataFrame, levels: DataFrame | None = None, on: Sequence[str] = ("i", "j"), level: str = "k", strict: bool = True) -> DataFrame:
    """Attach grid coordinates and bounds; strict: fail if a cell has none."""
    if strict and not df.join(horizontal, list(on), "left_anti").isEmpty():
        raise ValueError("cells without coordinates")
    out = df.join(horizontal, list(on))
    return out if levels is None else join_bounded(out, levels, level)


def zone_masks(df: DataFrame, zone: str, bed: str, shelf: float) -> DataFrame:
    """df with in_zone, and on_shelf: in a zone with the bed above the shelf's depth."""
    inside = F.col(zone).isNotNull() & (F.col(zone) >= 0)
    return df.withColumns({"in_zone": inside, "on_shelf": inside & (F.col(bed) > shelf)})


TOPOGRAPHY = (
    "bed", "draft", "surface", "thickness", "ice_frac", "ocean_frac", "grounded_frac", "floating_frac", "rock_frac",
    "ocean_masked_bed", "ocean_masked_draft", "ocean_masked_surface", "ocean_masked_thickness",
)


def require_columns(df: DataFrame, names: Sequence[str] = TOPOGRAPHY) -> DataFrame:
    """df, if it has all the columns named."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns are missing: {missing}")
    return df
