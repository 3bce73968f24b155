from __future__ import annotations

import datetime as dt

from helpers import collected
from pyspark.sql import functions as F

from subsmart.operators.calendar import build_calendar, calendar_days, extend_calendar


def test_bounds_and_attributes(spark):
    df = build_calendar(spark, "2024-06-30")
    first, last = df.agg(F.min("full_date"), F.max("full_date")).first()
    assert (first, last) == (dt.date(2000, 1, 1), dt.date(2027, 12, 31))
    assert df.count() == (last - first).days + 1
    leap = df.filter("full_date = '2024-02-29'").first()
    assert tuple(leap) == (
        20240229, dt.date(2024, 2, 29), 5, "Thursday", 29, 9, 2, "February", 1, 2024, False, False,
    )


def test_weeks_are_iso_and_weekends_flagged(spark):
    df = build_calendar(spark, "2021-01-01", "2021-01-01", horizon_years=0)
    rows = {r.full_date.day: r for r in df.filter("full_date <= '2021-01-04'").collect()}
    assert [rows[d].week_number for d in (1, 3, 4)] == [53, 53, 1]
    assert [rows[d].day_of_week for d in (1, 2, 3, 4)] == [6, 7, 1, 2]
    assert [rows[d].is_weekend for d in (1, 2, 3, 4)] == [False, True, True, False]


def test_extension_starts_after_the_last_day(spark):
    old = build_calendar(spark, "2020-05-05", "2019-01-01")
    new = extend_calendar(old, "2021-05-05")
    assert new.agg(F.min("full_date"), F.max("full_date")).first() == (
        dt.date(2024, 1, 1),
        dt.date(2024, 12, 31),
    )
    assert extend_calendar(old.unionByName(new), "2021-09-09").isEmpty()
    assert extend_calendar(old, "2001-01-01").isEmpty()


def test_empty_calendar_is_refilled(spark):
    empty = build_calendar(spark, "2020-05-05").limit(0)
    assert collected(extend_calendar(empty, "2020-05-05"), "date_id")[0][0] == 20000101


def test_long_calendars_are_whole(spark):
    bounds = spark.sql("select date'1600-01-01' as first_day, date'2200-12-31' as last_day")
    found = calendar_days(bounds).agg(F.count("*"), F.max("full_date")).first()
    assert found == ((dt.date(2200, 12, 31) - dt.date(1600, 1, 1)).days + 1, dt.date(2200, 12, 31))
