from __future__ import annotations

import datetime as dt

from helpers import collected, object_counts, usage_events
from pyspark.sql import functions as F

from subsmart.operators import usage
from subsmart.operators.dimensions import build_products, build_tiers
from subsmart.operators.objects import object_counts_fact
from subsmart.operators.staging import stage_object_counts

EVENTS = [
    (1, 10, 1, "2024-01-01T00:00:00", "A", "Usage"),
    (1, 11, 2, "2024-01-01T23:59:59", "A", "Usage"),
    (1, 11, 3, "2024-01-01T12:00:00", "A", "Activation"),
    (1, 11, 4, "2024-01-02T00:00:00", "A", "Usage"),
    (1, 10, 5, "2024-01-01T10:00:00", None, "Usage"),
    (1, 10, 6, "2024-01-01T10:00:00", "A", "Error"),
    (None, 12, 7, "2024-01-01T10:00:00", "B", "Activation"),
    (2, None, 8, "2024-01-01T10:00:00", "B", "Usage"),
]
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def fact(spark, products=None, **options):
    events = usage_events(spark, EVENTS)
    products = build_products(events) if products is None else products
    named = products.withColumnRenamed("product_id", "id")
    df = usage.product_usage_fact(events, products, **options)
    return df.join(named, F.col("product_id") == F.col("id")).select(
        "account_id", "product_name", "usage_date_day", *df.columns[3:]
    )


def test_counts_by_account_product_and_day(spark):
    assert collected(fact(spark), "account_id", "usage_date_day") == [
        (None, "B", D1, 0, 1, 0),
        (1, "A", D1, 2, 1, 1),
        (1, "A", D2, 1, 0, 1),
        (2, "B", D1, 1, 0, 1),
    ]


def test_distinct_users(spark):
    users = collected(fact(spark, user_col="user_id"), "account_id", "usage_date_day")
    assert [(r[3], r[4], r[5]) for r in users] == [(0, 1, 1), (2, 1, 2), (1, 0, 1), (1, 0, 0)]


def test_unknown_products_drop_out(spark):
    products = build_products(usage_events(spark, EVENTS)).filter("product_name = 'A'")
    assert fact(spark, products).select("product_name").distinct().collect() == [("A",)]


def test_counting_before_the_join_equals_after(spark):
    events = usage_events(spark, EVENTS)
    products = build_products(events)
    joined = usage.with_product(usage.relevant_events(events), products)
    after = joined.groupBy("account_id", "product_id", "usage_date_day").agg(
        F.count_if(F.col("event_type") == "Usage").alias("u"),
        F.count_if(F.col("event_type") == "Activation").alias("a"),
        F.count_distinct("account_id").alias("n"),
    )
    before = usage.product_usage_fact(events, products)
    assert before.exceptAll(after).isEmpty() and before.count() == after.count()


def test_products_and_tiers(spark):
    products = build_products(usage_events(spark, EVENTS))
    assert collected(products.select("product_name"), "product_name") == [("A",), ("B",)]
    offers = spark.sql(
        "select * from values ('T', 1.00), ('T', 1.00), ('T', 2.00), (null, 1.00), ('P', null)"
        " as o(tier, monthly_cost)"
    )
    assert build_tiers(offers).count() == 2
    assert build_tiers(offers, dedupe=False).count() == 3


def test_repeated_snapshots_add_up(spark):
    raw = object_counts(
        spark, [("2024-01-01", 1, 5), ("2024-01-01", 1, 7), ("2024-01-02", 1, None)]
    )
    counts = collected(object_counts_fact(stage_object_counts(raw)), "usage_date")
    assert [r[:4] for r in counts] == [(1, D1, 12, 2), (1, D2, None, 1)]
