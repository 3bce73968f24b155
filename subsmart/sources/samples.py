"""The four raw sources derived from order, customer, event and line-item tables.

They carry the edge cases the operators must survive: active subscriptions
(no cancel date), exact duplicates, reversed date ranges, a missing tier, a
product that no event names, events without product and an event type that is
filtered out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SUITE = ("Marketing", "Sales", "Service", "Content", "Operations")
TIER_OF_PRIORITY = {
    "1-URGENT": ("Enterprise", "1200.00"),
    "2-HIGH": ("Professional", "450.50"),
    "3-MEDIUM": ("Starter", "20.00"),
    "5-LOW": ("Trial", "0.00"),
}


@dataclass(frozen=True)
class RawSources:
    accounts: DataFrame
    subscriptions: DataFrame
    usage_events: DataFrame
    object_counts_daily: DataFrame


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sample_sources(spark: SparkSession, folder: str) -> RawSources:
    return RawSources(
        accounts=sample_accounts(spark, folder),
        subscriptions=sample_subscriptions(spark, folder),
        usage_events=sample_usage_events(spark, folder),
        object_counts_daily=sample_object_counts(spark, folder),
    )


def _lookup(key: Column, values: dict) -> Column:
    """``values[key]`` as a CASE expression, NULL where the key is absent."""
    result = F.lit(None)
    for match, value in reversed(values.items()):
        result = F.when(key == match, F.lit(value)).otherwise(result)
    return result


def sample_accounts(spark: SparkSession, folder: str) -> DataFrame:
    customer, nation = table(spark, folder, "customer"), table(spark, folder, "nation")
    first_order = (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.min(F.to_date("o_orderdate")).alias("signup_date"))
    )
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
        .join(first_order, "c_custkey", "left")
        .select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            "signup_date",
            F.col("n_name").alias("country"),
            F.col("c_mktsegment").alias("vertical"),
            (F.col("c_custkey") % 11).cast("int").alias("nps"),
        )
    )


def sample_subscriptions(spark: SparkSession, folder: str) -> DataFrame:
    key, start = F.col("o_orderkey"), F.to_date("o_orderdate")
    cancel = (
        F.when(F.col("o_orderstatus") == "O", F.lit(None))
        .when(key % 97 == 0, F.date_sub(start, 1))
        .otherwise(F.date_add(start, (key % 120).cast("int")))
    )
    tiers = {p: name for p, (name, _) in TIER_OF_PRIORITY.items()}
    prices = {p: price for p, (_, price) in TIER_OF_PRIORITY.items()}
    copies = F.when(key % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        table(spark, folder, "orders")
        .select(
            F.col("o_custkey").alias("account_id"),
            start.alias("start_date"),
            cancel.alias("cancel_date"),
            F.coalesce(_lookup(key % 6, dict(enumerate(SUITE))), F.lit("Beta")).alias("product"),
            _lookup(F.col("o_orderpriority"), tiers).alias("tier"),
            _lookup(F.col("o_orderpriority"), prices).cast("decimal(10,2)").alias("monthly_cost"),
            (key % 2 == 0).alias("touchless_conversion"),
            F.explode(copies).alias("copy"),
        )
        .drop("copy")
    )


def sample_usage_events(spark: SparkSession, folder: str) -> DataFrame:
    kind = (
        F.when(F.col("event_type") == "signup", "Activation")
        .when(F.col("event_type") == "error", "Error")
        .otherwise("Usage")
    )
    return table(spark, folder, "events").select(
        (F.col("user_id") % 50).alias("account_id"),
        "user_id",
        "event_id",
        F.col("ts").alias("event_time"),
        _lookup(F.col("event_id") % 6, dict(enumerate(SUITE))).alias("product"),
        kind.alias("event_type"),
    )


def sample_object_counts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.to_date("l_shipdate").alias("date"),
        F.col("l_suppkey").alias("account_id"),
        F.floor("l_quantity").alias("total_contacts"),
        F.col("l_linenumber").cast("long").alias("total_lists"),
        F.floor(F.col("l_extendedprice") / 1000).alias("total_deals"),
        (F.col("l_orderkey") % 7).alias("total_landing_pages"),
        (F.col("l_orderkey") % 5).alias("total_blogs"),
        (F.col("l_partkey") % 3).alias("total_workflows"),
    )
