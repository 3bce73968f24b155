"""Small inputs for the tests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from subsmart.schemas import SOURCES


def day(text: str | None) -> dt.date | None:
    return dt.date.fromisoformat(text) if text else None


def subscriptions(spark, rows):
    """Rows ``(account, start, cancel, product, tier, cost)``."""
    values = [
        (a, day(s), day(c), p, t, None if cost is None else Decimal(cost), True)
        for a, s, c, p, t, cost in rows
    ]
    return spark.createDataFrame(values, SOURCES["subscriptions"])


def usage_events(spark, rows):
    """Rows ``(account, user, event, time, product, type)``."""
    values = [
        (a, u, e, t and dt.datetime.fromisoformat(t), p, kind) for a, u, e, t, p, kind in rows
    ]
    return spark.createDataFrame(values, SOURCES["usage_events"])


def accounts(spark, rows):
    """Rows ``(id, name, signup, country, vertical, nps)``."""
    values = [(i, n, day(s), c, v, nps) for i, n, s, c, v, nps in rows]
    return spark.createDataFrame(values, SOURCES["accounts"])


def object_counts(spark, rows):
    """Rows ``(date, account, contacts)``; the other counts are 1."""
    values = [(day(d), a, n, 1, 1, 1, 1, 1) for d, a, n in rows]
    return spark.createDataFrame(values, SOURCES["object_counts_daily"])


def collected(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
