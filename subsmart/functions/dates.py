"""Date arithmetic that stays DATE: Spark's ``date_trunc`` would return a timestamp."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: dt.date | str | Column) -> Column:
    """A date column from a Python date, an ISO text or a column."""
    return value.cast("date") if isinstance(value, Column) else F.lit(value).cast("date")


def date_id(day: Column) -> Column:
    """20240229 for 2024-02-29."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def days_in_month(month: Column) -> Column:
    return F.dayofmonth(F.last_day(month))


def year_end(day: Column, years_ahead: int = 0) -> Column:
    return F.make_date(F.year(day) + years_ahead, F.lit(12), F.lit(31))


def month_ordinal(day: Column) -> Column:
    """Months since year 0, for counting months between two dates."""
    return F.year(day) * 12 + F.month(day)


def days_inclusive(first: Column, last: Column) -> Column:
    return F.datediff(last, first) + 1
