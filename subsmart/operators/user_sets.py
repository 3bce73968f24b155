"""Exact distinct users over any range of days, from sets kept by day and product.

A set is a bit map: the user's number is cut into a bucket and a bit, and the map of a
bucket has the bits of the users seen. Maps of days merge by OR, so a month, a product or
a trailing window is counted without going back to the events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subsmart.functions.dates import month_start
from subsmart.operators.spread import Sized
from subsmart.operators.usage import relevant_events, with_product

BY_DAY = ["usage_date_day", "product_id", "user_bucket"]


def daily_user_sets(staged: DataFrame, products: DataFrame | Sized) -> DataFrame:
    """The users of each day and product: ``user_bucket`` and its map ``users``.

    Maps are built where the events lie, so a hot day and product is one map per task and
    bucket. Events without user count for nobody. Small user numbers, given in turn, fill
    maps well; widely scattered ones make nearly empty maps, which only compress well.
    """
    seen = with_product(relevant_events(staged), products).filter(F.col("user_id").isNotNull())
    return (
        seen.groupBy("usage_date_day", "product_id", F.bitmap_bucket_number("user_id").alias("user_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("user_id")).alias("users"))
    )


def distinct_users(sets: DataFrame, *by: Column | str) -> DataFrame:
    """``active_users`` of each group of ``by``, the sets of all its days merged."""
    columns = [F.col(c) if isinstance(c, str) else c for c in by]
    merged = sets.groupBy(*columns, "user_bucket").agg(F.bitmap_or_agg("users").alias("users"))
    names = [c for c in merged.columns if c not in ("user_bucket", "users")]
    return merged.groupBy(*names).agg(F.sum(F.bitmap_count("users")).cast("long").alias("active_users"))


def monthly_users(sets: DataFrame) -> DataFrame:
    """Distinct users by month and product."""
    return distinct_users(sets, month_start(F.col("usage_date_day")).alias("usage_month"), "product_id")


def trailing_users(sets: DataFrame, days: int) -> DataFrame:
    """Distinct users by product over the ``days`` days up to each day that has events.

    Each map goes to the days whose window it lies in, and is merged there before it is
    shuffled. A day's window ends with it and has at most ``days`` maps of a bucket.
    """
    if days < 1:
        raise ValueError("a window has at least one day")
    present = sets.select(F.col("usage_date_day").alias("_day"), F.col("product_id").alias("_product")).distinct()
    ahead = F.explode(F.sequence(F.lit(0), F.lit(days - 1)))
    reached = sets.withColumn("_ahead", ahead).withColumn("_day", F.date_add("usage_date_day", F.col("_ahead")))
    merged = reached.groupBy("_day", F.col("product_id").alias("_product"), "user_bucket").agg(
        F.bitmap_or_agg("users").alias("users")
    )
    return merged.groupBy("_day", "_product").agg(
        F.sum(F.bitmap_count("users")).cast("long").alias("active_users")
    ).join(present, ["_day", "_product"], "left_semi").select(
        F.col("_day").alias("usage_date_day"), F.col("_product").alias("product_id"), "active_users"
    )
