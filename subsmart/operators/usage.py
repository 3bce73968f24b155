"""Daily product usage per account."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subsmart.operators.spread import Sized, sized

# The event types that count.
USAGE, ACTIVATION = "Usage", "Activation"


def relevant_events(events: DataFrame) -> DataFrame:
    """Usage and activation events; the predicate reaches the scan."""
    return events.filter(F.col("event_type").isin(ACTIVATION, USAGE)).select(
        "account_id",
        "user_id",
        F.col("product").alias("product_name"),
        "event_time",
        "event_type",
    )


def with_product(events: DataFrame, products: DataFrame | Sized) -> DataFrame:
    """Each relevant event with its product key and day; unknown products drop out."""
    return events.join(sized(products).frame, "product_name").select(
        "account_id",
        "user_id",
        "product_id",
        "product_name",
        F.to_date("event_time").alias("usage_date_day"),
        "event_time",
        "event_type",
    )


def daily_counts(events: DataFrame, user_col: str | None = None) -> DataFrame:
    """Counts by account, product name and day, before any join.

    ``active_users`` counts distinct accounts, which is 1 because the account is a
    group key (0 when it is NULL). With ``user_col`` it counts distinct users, in two
    levels so that a hot account-product-day group never meets in one task.
    """
    usage = F.when(F.col("event_type") == USAGE, 1).otherwise(0)
    activation = F.when(F.col("event_type") == ACTIVATION, 1).otherwise(0)
    keys = ["account_id", "product_name", F.to_date("event_time").alias("usage_date_day")]
    known = events.filter(F.col("product_name").isNotNull())
    if user_col is None:
        return known.groupBy(*keys).agg(
            F.sum(usage).alias("total_usage_events"),
            F.sum(activation).alias("total_activations"),
            F.max(F.when(F.col("account_id").isNotNull(), 1).otherwise(0))
            .cast("long")
            .alias("active_users"),
        )
    per_user = known.groupBy(*keys, F.col(user_col).alias("_user")).agg(
        F.sum(usage).alias("_usage"), F.sum(activation).alias("_activation")
    )
    return per_user.groupBy("account_id", "product_name", "usage_date_day").agg(
        F.sum("_usage").alias("total_usage_events"),
        F.sum("_activation").alias("total_activations"),
        F.count("_user").alias("active_users"),
    )


def product_usage_fact(
    staged: DataFrame, products: DataFrame | Sized, user_col: str | None = None
) -> DataFrame:
    """Usage and activation counts by account, product and day.

    Events are counted before the product join, so the join sees one row per
    group and product ids never widen the shuffle. ``products`` has one row per name.
    """
    counts = daily_counts(relevant_events(staged), user_col)
    return counts.join(sized(products).frame, "product_name").select(
        "account_id",
        "product_id",
        "usage_date_day",
        "total_usage_events",
        "total_activations",
        "active_users",
    )
