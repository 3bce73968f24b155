from __future__ import annotations

import datetime as dt

import pytest
from helpers import accounts, object_counts, subscriptions, usage_events

from subsmart.plans.build import ORDER, Warehouse, create_staging_views
from subsmart.sources.samples import RawSources

EVENTS = [
    (1, 1, 1, "2020-01-01T08:00:00", "A", "Usage"),
    (1, 1, 2, "2020-01-02T08:00:00", "A", "Usage"),
]
PERIODS = [(1, "2020-01-01", "2020-02-10", "A", "Pro", "29.00")]
COUNTS = [("2020-01-01", 1, 5), ("2020-01-02", 1, 6)]
PEOPLE = [(1, "Ann", "2019-05-01", "FR", "Retail", 5)]


def sources(spark, people=PEOPLE, periods=PERIODS, events=EVENTS, counts=COUNTS):
    return RawSources(
        accounts(spark, people),
        subscriptions(spark, periods),
        usage_events(spark, events),
        object_counts(spark, counts),
    )


def test_full_then_incremental(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.run_all(sources(spark), dt.date(2020, 3, 1))
    sizes = {name: warehouse.read(name).count() for name in ORDER}
    assert sizes == {
        "dim_dates": 8766,
        "dim_tiers": 1,
        "dim_products": 1,
        "dim_accounts": 1,
        "fact_object_counts": 2,
        "fact_product_usage": 2,
        "fact_financials": 2,
    }
    # The second delivery lacks day 1, corrects day 2 and brings day 3 and a move.
    later = sources(
        spark,
        people=[(1, "Ann", "2019-05-01", "FR", "Bank", 5)],
        events=[(1, 1, 3, "2020-01-02T09:00:00", "A", "Activation")],
        counts=[("2020-01-02", 1, 60), ("2020-01-03", 1, 7)],
    )
    for _ in range(2):  # the same delivery twice changes nothing more
        warehouse.run_all(later, dt.date(2021, 3, 1))
        contacts = warehouse.read("fact_object_counts").orderBy("usage_date").collect()
        assert [r.total_contacts for r in contacts] == [5, 60, 7]
        usage = warehouse.read("fact_product_usage").orderBy("usage_date_day").collect()
        assert [(r.total_usage_events, r.total_activations) for r in usage] == [(1, 0), (0, 1)]
        assert warehouse.read("dim_accounts").count() == 2
        assert warehouse.read("dim_dates").count() == 8766 + 366  # 2024 is a leap year
        assert warehouse.read("fact_financials").count() == 2

    warehouse.run_all(later, dt.date(2021, 3, 1), full_refresh=True)
    assert warehouse.read("fact_object_counts").count() == 2
    assert warehouse.read("fact_product_usage").count() == 1
    assert warehouse.read("dim_accounts").count() == 2  # history outlives a refresh


def test_since_limits_the_incremental_input(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    first = sources(spark)
    warehouse.run_all(first, dt.date(2020, 3, 1), only=["fact_object_counts"])
    changed = sources(spark, counts=[("2020-01-01", 1, 500), ("2020-01-02", 1, 600)])
    warehouse.run_all(
        changed, dt.date(2020, 3, 1), only=["fact_object_counts"], since="2020-01-02"
    )
    rows = warehouse.read("fact_object_counts").orderBy("usage_date").collect()
    assert [r.total_contacts for r in rows] == [5, 600]


def test_since_recomputes_whole_months_of_financials(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.run_all(sources(spark), dt.date(2020, 3, 1))
    periods = [
        (1, "2020-01-01", "2020-02-10", "A", "Pro", "58.00"),
        (1, "2020-01-01", "2020-01-05", "A", "Pro", "29.00"),
    ]
    marts = ["dim_tiers", "fact_financials"]
    warehouse.run_all(
        sources(spark, periods=periods), dt.date(2020, 3, 1), only=marts, since="2020-02-20"
    )
    rows = warehouse.read("fact_financials").orderBy("financial_month").collect()
    assert [(r.financial_month.month, r.total_revenue) for r in rows] == [(1, 29.0), (2, 20.0)]


def test_views_serve_sql(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.run_all(sources(spark), dt.date(2020, 3, 1))
    warehouse.create_views()
    create_staging_views(sources(spark))
    row = spark.sql(
        "select sum(total_revenue) from fact_financials join dim_products using (product_id)"
        " where account_id in (select account_id from stg_subscriptions)"
    ).first()
    assert row[0] == 39.0


@pytest.mark.parametrize("name", ["dim_accounts", "fact_product_usage", "fact_financials"])
def test_absent_upstream_is_refused(spark, tmp_path, name):
    warehouse = Warehouse(spark, str(tmp_path))
    with pytest.raises(ValueError, match="must be built first"):
        warehouse.run_all(sources(spark), dt.date(2024, 1, 1), only=[name])
    assert not any(tmp_path.iterdir())


def test_unknown_mart_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="no such mart: dim_users"):
        Warehouse(spark, str(tmp_path)).run_all(
            sources(spark), dt.date(2020, 1, 1), only=["dim_users"]
        )
