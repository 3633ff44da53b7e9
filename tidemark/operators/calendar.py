"""Date spines and the calendar dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import as_col, business_season, day_of_week_number, days_to_halloween, is_weekend

Day = str | dt.date


MOST_DAYS = 100_000  # of a spine: one wrong date must not make millions of rows


def _spine(first: Column, last: Column, name: str) -> Column:
    days = F.date_diff(last, first)
    bounded = F.when(days > MOST_DAYS, F.raise_error(F.concat(F.lit("a calendar of days: "), days.cast("string"))).cast("date")).otherwise(last)
    return F.explode(F.sequence(first, bounded)).alias(name)


def _days(spark: SparkSession, start: Day, last: Column, name: str) -> DataFrame:
    return spark.range(1).select(_spine(F.lit(str(start)).cast("date"), last, name))


def date_spine(spark: SparkSession, start: Day, end_exclusive: Day, name: str = "date_day") -> DataFrame:
    """One row per day, the end left out."""
    return _days(spark, start, F.date_sub(F.lit(str(end_exclusive)).cast("date"), 1), name)


def date_spine_inclusive(spark: SparkSession, start: Day, end: Day, name: str = "spine_date") -> DataFrame:
    """One row per day, the end included."""
    return _days(spark, start, F.lit(str(end)).cast("date"), name)


def spine_over(df: DataFrame, column: Column | str, name: str = "date_day") -> DataFrame:
    """One row per day from the first to the last date of a column, read from the data."""
    span = df.agg(F.min(as_col(column)).alias("_lo"), F.max(as_col(column)).alias("_hi"))
    return span.where(F.col("_lo").isNotNull()).select(_spine(F.col("_lo"), F.col("_hi"), name))


def numbered_days(spark: SparkSession, start: Day, rows: int, last: Day | None = None, name: str = "spine_date") -> DataFrame:
    """`rows` consecutive days from a generated row set, cut at `last`."""
    days = spark.range(rows).select(F.date_add(F.lit(str(start)).cast("date"), F.col("id").cast("int")).alias(name))
    return days if last is None else days.where(F.col(name) <= F.lit(str(last)).cast("date"))


def calendar(spine: DataFrame, day: str = "date_day") -> DataFrame:
    """The calendar dimension over a spine."""
    d = F.col(day)
    return spine.select(
        d.alias("date_day"),
        F.year(d).alias("year"),
        F.year(d).alias("year_number"),
        F.month(d).alias("month_number"),
        F.monthname(d).alias("month_name"),
        F.day(d).alias("day_number"),
        day_of_week_number(d).alias("day_of_week_number"),
        F.dayname(d).alias("day_of_week"),
        F.quarter(d).alias("quarter"),
        is_weekend(d).alias("is_weekend"),
        ((F.month(d) == 10) & (F.day(d) == 31)).alias("is_halloween"),
        days_to_halloween(d).alias("days_to_halloween"),
        business_season(d).alias("business_season"),
    )
