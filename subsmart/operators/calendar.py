"""The generated calendar dimension and its extension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subsmart.functions.dates import as_date, date_id, year_end

# First day of a full build, and years generated past the run date.
FIRST_DAY = dt.date(2000, 1, 1)
HORIZON_YEARS = 3


def calendar_days(bounds: DataFrame) -> DataFrame:
    """One row per day of a one-row relation ``(first_day, last_day)``.

    Generated by exploding a sequence: no window over all rows, and every day of it.
    """
    return (
        bounds.filter(F.col("first_day") <= F.col("last_day"))
        .select(F.explode(F.sequence("first_day", "last_day")).alias("full_date"))
    )


def describe_days(days: DataFrame) -> DataFrame:
    """The calendar attributes of each ``full_date``."""
    day = F.col("full_date")
    weekday = F.dayofweek(day)  # Sunday = 1
    return days.select(
        date_id(day).alias("date_id"),
        day,
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofmonth(day).alias("day_of_month"),
        F.weekofyear(day).alias("week_number"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        weekday.isin(1, 7).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
    )


def calendar_bounds(
    spark: SparkSession,
    as_of: dt.date | str | Column,
    start: dt.date | str | Column = FIRST_DAY,
    horizon_years: int = HORIZON_YEARS,
) -> DataFrame:
    """``(first_day, last_day)``: ``start`` to the year end ``horizon_years`` after ``as_of``."""
    return spark.range(1).select(
        as_date(start).alias("first_day"), year_end(as_date(as_of), horizon_years).alias("last_day")
    )


def build_calendar(
    spark: SparkSession,
    as_of: dt.date | str | Column,
    start: dt.date | str | Column = FIRST_DAY,
    horizon_years: int = HORIZON_YEARS,
) -> DataFrame:
    """The whole calendar. Bounds may be scalar-subquery columns over data."""
    return describe_days(calendar_days(calendar_bounds(spark, as_of, start, horizon_years)))


def extend_calendar(
    existing: DataFrame,
    as_of: dt.date | str | Column,
    start: dt.date | str | Column = FIRST_DAY,
    horizon_years: int = HORIZON_YEARS,
) -> DataFrame:
    """Only the days to append to ``existing``; all days from ``start`` if it is empty."""
    next_day = F.coalesce(F.date_add(F.max("full_date"), 1), as_date(start))
    bounds = existing.agg(next_day.alias("first_day")).withColumn(
        "last_day", year_end(as_date(as_of), horizon_years)
    )
    return describe_days(calendar_days(bounds))
