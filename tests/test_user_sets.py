from __future__ import annotations

import datetime as dt
import random

import pytest
from helpers import usage_events
from pyspark.sql import functions as F
from test_pipeline import sources

from subsmart.operators import user_sets
from subsmart.operators.dimensions import build_products
from subsmart.operators.staging import stage_usage_events
from subsmart.plans.build import ORDER, Warehouse


def events(seed, n=400):
    pick, rows = random.Random(seed), []
    users = [0, 1, 32768, 32769, -5, 10**12, *range(2, 12)]
    for i in range(n):
        day = dt.datetime(2024, 1, 20) + dt.timedelta(days=pick.randrange(25), hours=pick.randrange(24))
        user = None if pick.random() < 0.1 else pick.choice(users)
        rows.append((1, user, i, day.isoformat(), pick.choice(["A", "B", None]), pick.choice(["Usage", "Activation", "Error"])))
    return rows


def plain(rows):
    """(day, product, user) of the events that count."""
    return {(dt.date.fromisoformat(t[:10]), p, u) for _, u, _, t, p, kind in rows if p and u is not None and kind != "Error"}


@pytest.fixture(scope="module", params=[1, 2])
def case(request, spark):
    rows = events(request.param)
    staged = stage_usage_events(usage_events(spark, rows))
    products = build_products(staged)
    names = {r.product_id: r.product_name for r in products.collect()}
    return plain(rows), user_sets.daily_user_sets(staged, products).cache(), names


def test_months_products_and_all(case):
    seen, sets, names = case
    months = {(r.usage_month, names[r.product_id]): r.active_users for r in user_sets.monthly_users(sets).collect()}
    expected = {}
    for day, p, u in seen:
        expected.setdefault((day.replace(day=1), p), set()).add(u)
    assert months == {k: len(v) for k, v in expected.items()}
    days = {(r.usage_date_day, names[r.product_id]): r.active_users for r in user_sets.distinct_users(sets, "usage_date_day", "product_id").collect()}
    assert days == {(d, p): len({u for e, q, u in seen if (e, q) == (d, p)}) for d, p, _ in seen}
    assert user_sets.distinct_users(sets).first().active_users == len({u for *_, u in seen})


@pytest.mark.parametrize("length", [1, 3, 30])
def test_trailing_windows(case, length):
    seen, sets, names = case
    found = {(r.usage_date_day, names[r.product_id]): r.active_users for r in user_sets.trailing_users(sets, length).collect()}
    expected = {
        (d, p): len({u for e, q, u in seen if q == p and dt.timedelta(0) <= d - e < dt.timedelta(length)})
        for d, p, _ in seen
    }
    assert found == expected


def test_window_has_a_day(case):
    with pytest.raises(ValueError, match="at least one day"):
        user_sets.trailing_users(case[1], 0)


def test_hot_day_is_one_map_per_task(spark):
    rows = spark.range(0, 200_000, 1, 4).select(
        F.lit(1).cast("long").alias("account_id"), (F.col("id") % 50_000).alias("user_id"), F.col("id").alias("event_id"),
        F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("event_time"), F.lit("A").alias("product"),
        F.lit("Usage").alias("event_type"),
    )
    sets = user_sets.daily_user_sets(rows, build_products(rows))
    assert sets.count() == 3  # user 0, and two buckets
    assert user_sets.distinct_users(sets).first().active_users == 50_000
    plan = sets._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("partial_bitmap_construct_agg")


def test_stored_sets_follow_late_events(spark, tmp_path):
    warehouse, marts = Warehouse(spark, str(tmp_path)), ["dim_products", "usage_user_sets"]
    assert "usage_user_sets" not in ORDER
    warehouse.run_all(sources(spark), dt.date(2020, 3, 1), only=marts)
    late = sources(spark, events=[(1, 1, 1, "2020-01-01T08:00:00", "A", "Usage"), (1, 9, 2, "2020-01-02T08:00:00", "A", "Usage")])
    for _ in range(2):
        warehouse.run_all(late, dt.date(2020, 3, 1), only=marts)
        rows = user_sets.monthly_users(warehouse.read("usage_user_sets")).collect()
        assert [r.active_users for r in rows] == [2]
