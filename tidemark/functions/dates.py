"""Calendar arithmetic with boundary-count semantics, and the seasonal labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.numbers import as_col

__all__ = [
    "add_days", "add_seconds", "business_season", "day_of_week_number", "days_between",
    "days_to_halloween", "halloween_bucket", "is_weekend", "month_start", "months_between_dates",
    "seconds_between", "utc_now", "week_start", "years_between",
]


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def months_between_dates(start: Column, end: Column) -> Column:
    """Month boundaries crossed (31 Jan to 1 Feb counts 1)."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def years_between(start: Column, end: Column) -> Column:
    """Year boundaries crossed, so an age is a difference of calendar years."""
    return F.year(end) - F.year(start)


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed."""
    return F.unix_seconds(end.cast("timestamp")) - F.unix_seconds(start.cast("timestamp"))


def add_days(c: Column, days: int | Column) -> Column:
    """A date shifted by days; stays a date."""
    return F.date_add(c, days)


def add_seconds(c: Column, seconds: Column) -> Column:
    return c + F.make_dt_interval(secs=seconds)


def month_start(c: Column) -> Column:
    return F.trunc(c, "month")


def week_start(c: Column) -> Column:
    """Monday of the week."""
    return F.trunc(c, "week")


def day_of_week_number(c: Column) -> Column:
    """0 = Sunday to 6 = Saturday."""
    return F.dayofweek(c) - 1


def is_weekend(c: Column) -> Column:
    return F.dayofweek(c).isin(1, 7)


def utc_now(c: Column | None = None, zone: str = "UTC") -> Column:
    """A zone-free timestamp in UTC, by default of the present moment."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), (F.now() if c is None else c).cast("timestamp_ntz"))


# Month -> season. September has no entry and falls through.
SEASON_MONTHS = {
    "Halloween Season": (10, 11),
    "Summer": (6, 7, 8),
    "Winter": (12, 1, 2),
    "Spring": (3, 4, 5),
}
OTHER_SEASON = "Fall"


def business_season(c: Column | str) -> Column:
    month = F.month(as_col(c))
    picked = F
    for label, months in SEASON_MONTHS.items():
        picked = picked.when(month.isin(*months), F.lit(label))
    return picked.otherwise(F.lit(OTHER_SEASON))


def days_to_halloween(c: Column | str) -> Column:
    """Signed days to 31 October of the same year."""
    day = as_col(c)
    return F.datediff(F.make_date(F.year(day), F.lit(10), F.lit(31)), day)


# Fixed values: (first day, last day, label) of signed days to Halloween.
HALLOWEEN_BUCKETS = [
    (0, 0, "Halloween Day"),
    (1, 7, "Week of Halloween"),
    (8, 30, "October Pre-Halloween"),
    (31, 60, "2 Months Before"),
    (-14, -1, "Post Halloween (2 wks)"),
    (None, -15, "Off Season"),
]
BEYOND_BUCKETS = "Far Out"


def halloween_bucket(days: Column) -> Column:
    picked = F
    for low, high, label in HALLOWEEN_BUCKETS:
        inside = days <= high if low is None else days.between(low, high)
        picked = picked.when(inside, F.lit(label))
    return picked.otherwise(F.lit(BEYOND_BUCKETS))
