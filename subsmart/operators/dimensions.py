"""Tier and product dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subsmart.functions.keys import surrogate_key


def build_tiers(subscriptions: DataFrame, dedupe: bool = True) -> DataFrame:
    """Tier and price with a hash key; ``dedupe=False`` keeps one row per subscription."""
    offers = subscriptions.filter(
        F.col("tier").isNotNull() & F.col("monthly_cost").isNotNull()
    ).select(F.col("tier").alias("tier_name"), F.col("monthly_cost").alias("tier_price"))
    if dedupe:
        offers = offers.distinct()  # before hashing, so md5 runs once per offer
    return offers.select(
        surrogate_key("tier_name", "tier_price").alias("tier_id"), "tier_name", "tier_price"
    )


def build_products(usage_events: DataFrame) -> DataFrame:
    """The distinct products that events name, with a hash key."""
    names = (
        usage_events.filter(F.col("product").isNotNull())
        .select(F.col("product").alias("product_name"))
        .distinct()
    )
    return names.select(surrogate_key("product_name").alias("product_id"), "product_name")
