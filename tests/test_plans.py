"""What the physical plans must and must not contain."""

from __future__ import annotations

import pytest

from subsmart.plans.registry import QUERIES


def plan(spark, folder, key):
    return QUERIES[key](spark, folder)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "key",
    [
        "subscription_days",
        "subscription_months",
        "financials_days_active",
        "fact_financials",
        "fact_product_usage",
        "account_signup_date_id",
        "scd2_version_chain",
        "replace_object_counts",
    ],
)
def test_no_nested_loops_or_cross_joins(spark, folder, key):
    text = plan(spark, folder, key)
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_dimension_joins_are_broadcast(spark, folder):
    for key in ("fact_financials", "fact_product_usage", "usage_with_product"):
        text = plan(spark, folder, key)
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text, key


def test_only_needed_columns_are_read(spark, folder):
    text = plan(spark, folder, "fact_object_counts")
    assert "l_discount" not in text and "l_tax" not in text
    usage = plan(spark, folder, "fact_product_usage")
    assert "props" not in usage and "value" not in usage


def test_filters_reach_the_scan(spark, tmp_path):
    from helpers import usage_events

    from subsmart.operators.staging import stage_usage_events
    from subsmart.operators.usage import relevant_events
    from subsmart.sources.raw import read_source

    usage_events(spark, []).write.parquet(str(tmp_path / "events"))
    events = stage_usage_events(read_source(spark, "usage_events", str(tmp_path / "events")))
    text = relevant_events(events)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(event_type, [Activation,Usage])]" in text


def test_no_python_in_the_plans(spark, folder):
    for key in ("fact_financials", "fact_product_usage_users", "scd2_version_chain", "dim_dates"):
        text = plan(spark, folder, key)
        assert "Python" not in text and "Pandas" not in text


def test_financials_shuffle_subscriptions_once(spark, folder):
    text = plan(spark, folder, "fact_financials")
    assert text.count("Exchange hashpartitioning") == 1
    assert "Exchange hashpartitioning(account_id" in text


def test_large_accounts_are_aggregated_before_they_move(spark, folder, monkeypatch):
    from subsmart.operators import spread

    monkeypatch.setattr(spread, "GROUP_ROWS", 5)
    text = plan(spark, folder, "fact_financials")
    large = text[text.rindex("Window") :]
    assert "Union" in text and "partial_sum" in large
    assert large.index("Exchange hashpartitioning") < large.index("partial_sum")


def test_usage_shuffles_once(spark, folder):
    text = plan(spark, folder, "fact_product_usage")
    assert text.count("Exchange hashpartitioning") == 1


def test_closed_versions_are_not_shuffled(spark):
    import datetime as dt

    from subsmart.operators.history import apply_batch
    from subsmart.schemas import MARTS

    history = spark.createDataFrame([], MARTS["dim_accounts"])
    batch = history.select("account_id", "name", "signup_date_id", "country", "vertical", "nps")
    after = apply_batch(history, batch, dt.date(2020, 1, 1))
    text = after._jdf.queryExecution().optimizedPlan().toString()
    closed = text[: text.index("Generate")]
    assert "Union" in closed and "Join" not in closed


@pytest.fixture
def small_skew_limits(spark):
    """No broadcasts, and partitions count as skewed at test size."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_product_is_split_when_dimensions_outgrow_a_broadcast(small_skew_limits):
    spark = small_skew_limits
    from pyspark.sql import functions as F

    from subsmart.operators.dimensions import build_products
    from subsmart.operators.spread import Sized, settle
    from subsmart.operators.usage import with_product

    # Half of the events name one product.
    product = F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 500))
    events = spark.range(60_000).select(
        F.col("id").alias("account_id"),
        F.col("id").alias("user_id"),
        product.alias("product"),
        product.alias("product_name"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("event_time"),
        F.lit("Usage").alias("event_type"),
    ).repartition(8, "account_id")
    unmarked = Sized(settle(build_products(events)), None)
    joined = with_product(events, unmarked)
    assert len(joined.collect()) == 60_000
    text = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in text
