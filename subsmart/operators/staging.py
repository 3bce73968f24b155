"""Staging: one lazy projection per raw source, with the types pinned."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subsmart.schemas import OBJECT_TOTALS, SOURCES
from subsmart.sources.raw import require_columns


def _cast(column: str, kind: str, lenient: bool):
    source = F.col(column)
    return (source.try_cast(kind) if lenient else source.cast(kind)).alias(column)


def stage_accounts(raw: DataFrame, lenient: bool = False) -> DataFrame:
    """Accounts keyed by ``account_id``. ``lenient`` turns bad text into NULL instead of failing."""
    require_columns(raw, "accounts")
    return raw.select(
        F.col("id").alias("account_id"),
        "name",
        _cast("signup_date", "date", lenient),
        "country",
        "vertical",
        "nps",
    )


def stage_subscriptions(raw: DataFrame, lenient: bool = False) -> DataFrame:
    require_columns(raw, "subscriptions")
    pinned = {"start_date": "date", "cancel_date": "date", "monthly_cost": "decimal(10,2)"}
    return raw.select(
        *(
            _cast(field.name, pinned[field.name], lenient) if field.name in pinned else field.name
            for field in SOURCES["subscriptions"]
        )
    )


def stage_usage_events(raw: DataFrame, lenient: bool = False) -> DataFrame:
    require_columns(raw, "usage_events")
    return raw.select(
        "account_id",
        "user_id",
        "event_id",
        _cast("event_time", "timestamp_ntz", lenient),
        "product",
        "event_type",
    )


def stage_object_counts(raw: DataFrame, lenient: bool = False) -> DataFrame:
    require_columns(raw, "object_counts_daily")
    return raw.select(_cast("date", "date", lenient), "account_id", *OBJECT_TOTALS)
