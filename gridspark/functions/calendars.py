"""Dates of model calendars in whole numbers; no timestamps, so that a 30
February of a 360-day year is a date like any other."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Days of each month of a common year.
DAYS = (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)


def is_leap(year: Column) -> Column:
    return (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))


def days_in_month(year: Column, month: Column, calendar: Column) -> Column:
    """Of noleap / 365_day, 360_day, and any other name: the Gregorian one."""
    common = F.element_at(F.array(*[F.lit(x) for x in DAYS]), month)
    leap = F.when((month == 2) & is_leap(year), 29).otherwise(common)
    return F.when(calendar.isin("noleap", "365_day"), common).when(calendar == "360_day", 30).otherwise(leap)


def year_start(year: Column, calendar: Column) -> Column:
    """Days from 1 January 1850 to 1 January of a year."""
    y = year - 1850
    since = F.floor((year - 1) / 4) - F.floor((year - 1) / 100) + F.floor((year - 1) / 400)
    leaps = since - (1849 // 4 - 1849 // 100 + 1849 // 400)
    days = F.when(calendar.isin("noleap", "365_day"), y * 365).when(calendar == "360_day", y * 360).otherwise(y * 365 + leaps)
    return days.cast("int")


def year_bounds(year: Column, calendar: Column) -> tuple[Column, Column]:
    return year_start(year, calendar), year_start(year + 1, calendar)
