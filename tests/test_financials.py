from __future__ import annotations

import calendar as cal
import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from helpers import collected, day, subscriptions, usage_events
from pyspark.sql import functions as F

from subsmart.functions.keys import surrogate_key
from subsmart.operators import financials as fin
from subsmart.operators import spread
from subsmart.operators.calendar import build_calendar
from subsmart.operators.dimensions import build_products, build_tiers
from subsmart.operators.staging import stage_subscriptions


def fact(spark, rows, first="2000-01-01", as_of="2001-06-30", used=("A", "B"), **options):
    subs = subscriptions(spark, rows)
    events = usage_events(
        spark, [(1, 1, i, "2000-01-01T00:00:00", p, "Usage") for i, p in enumerate(used)]
    )
    calendar = build_calendar(spark, as_of, first)
    return fin.financials_fact(subs, build_tiers(subs), build_products(events), calendar, **options)


def months(df, account=1):
    rows = df.filter(F.col("account_id") == account).orderBy("financial_month").collect()
    return [
        (r.financial_month.isoformat()[:7], round(r.total_revenue, 4), r.churned_subscriptions)
        for r in rows
    ]


def test_cancel_month_is_prorated_and_others_are_full(spark):
    df = fact(spark, [(1, "2000-01-20", "2000-03-10", "A", "Pro", "31.00")])
    assert months(df) == [("2000-01", 31.0, 0), ("2000-02", 31.0, 0), ("2000-03", 10.0, 1)]


def test_cancel_on_the_start_day(spark):
    df = fact(spark, [(1, "2000-05-05", "2000-05-05", "A", "Pro", "31.00")])
    assert months(df) == [("2000-05", 1.0, 1)]


def test_cancel_on_the_last_and_first_day(spark):
    assert months(fact(spark, [(1, "2000-02-01", "2000-02-29", "A", "Pro", "29.00")])) == [
        ("2000-02", 29.0, 1)
    ]
    assert months(fact(spark, [(1, "2000-02-01", "2000-03-01", "A", "Pro", "31.00")])) == [
        ("2000-02", 31.0, 0),
        ("2000-03", 1.0, 1),
    ]


def test_reversed_and_active_periods_yield_nothing(spark):
    rows = [
        (1, "2000-05-05", "2000-05-04", "A", "Pro", "31"),
        (1, "2000-05-05", None, "A", "Pro", "31"),
    ]
    assert fact(spark, rows).isEmpty()


def test_open_until_keeps_the_churn_test_on_the_cancel_date(spark):
    df = fact(spark, [(1, "2000-05-05", None, "A", "Pro", "31")], open_until="2000-06-15")
    assert months(df) == [("2000-05", 31.0, 0), ("2000-06", 31.0, 0)]


def test_days_of_overlapping_subscriptions_add_up(spark):
    rows = [
        (1, "2000-01-01", "2000-01-31", "A", "Pro", "31.00"),
        (1, "2000-01-01", "2000-01-10", "A", "Pro", "31.00"),
    ]
    assert months(fact(spark, rows)) == [("2000-01", 82.0, 1)]  # 41 days count for both
    assert months(fact(spark, rows, days_grain="subscription")) == [("2000-01", 41.0, 1)]


def test_copies_of_a_subscription_count_once(spark):
    row = (1, "2000-01-01", "2000-01-10", "A", "Pro", "31.00")
    assert months(fact(spark, [row] * 5)) == [("2000-01", 10.0, 1)]


def test_repeated_tier_rows_do_not_multiply_revenue(spark):
    subs = subscriptions(
        spark, [(a, "2000-01-01", "2000-02-10", "A", "Pro", "29.00") for a in (1, 2, 3)]
    )
    calendar = build_calendar(spark, "2001-06-30")
    products = build_products(usage_events(spark, [(1, 1, 1, "2000-01-01T00:00:00", "A", "Usage")]))
    one = fin.financials_fact(subs, build_tiers(subs), products, calendar)
    many = fin.financials_fact(subs, build_tiers(subs, dedupe=False), products, calendar)
    assert collected(many, "account_id", "financial_month") == collected(
        one, "account_id", "financial_month"
    )


def test_missing_tier_and_unused_product(spark):
    rows = [
        (1, "2000-01-01", "2000-02-10", "Z", "Pro", "31.00"),
        (2, "2000-01-01", "2000-02-10", "A", None, None),
    ]
    df = collected(fact(spark, rows), "account_id", "financial_month")
    assert [r[1] for r in df[:2]] == [None, None]  # product without events
    assert [(r[2], r[4], r[5], r[6]) for r in df[2:]] == [(None, None, 1, 0), (None, None, 1, 1)]


def test_products_without_key_share_a_group(spark):
    rows = [(1, "2000-01-01", "2000-02-29", p, "Pro", "10.00") for p in ("Y", "Z")]
    assert months(fact(spark, rows)) == [("2000-01", 20.0, 0), ("2000-02", 40.0, 1)]


def test_calendar_clips_days_but_not_the_churn_test(spark):
    row = (1, "1999-12-01", "2005-01-15", "A", "Pro", "31.00")
    df = fact(spark, [row], first="2000-01-11", as_of="1998-01-01")  # ends 2001-12-31
    rows = months(df)
    assert rows[0] == ("2000-01", 31.0, 0) and rows[-1] == ("2001-12", 31.0, 0)
    early = fact(spark, [(1, "1999-12-01", "2000-01-20", "A", "Pro", "31")], first="2000-01-11")
    assert months(early) == [("2000-01", 10.0, 1)]


def test_unknown_account_has_no_count(spark):
    df = fact(spark, [(None, "2000-01-01", "2000-01-31", "A", "Pro", "31.00")])
    assert [(r[4], r[5], r[6]) for r in collected(df)] == [(31.0, 0, 0)]


def test_unknown_grain_is_refused(spark):
    with pytest.raises(ValueError, match="days_grain"):
        fact(spark, [], days_grain="month")


def by_day(rows, first, last, known):
    """Revenue from scratch, one day at a time."""
    load, parts = defaultdict(int), defaultdict(int)
    for row in set(rows):
        account, start, cancel = row[0], day(row[1]), day(row[2])
        while cancel and start <= cancel:
            if first <= start <= last:
                load[account, start.replace(day=1)] += 1
                parts[row, start.replace(day=1)] += 1
            start += dt.timedelta(days=1)
    totals = defaultdict(lambda: [None, 0])
    for (row, month), _ in parts.items():
        account, _, cancel, product, tier, cost = row
        here = day(cancel).replace(day=1) == month
        length = cal.monthrange(month.year, month.month)[1]
        share = load[account, month] / length if here else 1
        offer = f"{tier}-{Decimal(cost):.2f}" if tier and cost is not None else None
        total = totals[account, product if product in known else None, offer, month]
        if cost is not None:
            total[0] = (total[0] or 0) + float(cost) * share
        total[1] = max(total[1], int(here and account is not None))
    return {k: (v[0] and round(v[0], 4), v[1]) for k, v in totals.items()}


@pytest.mark.parametrize("large", [1, 50, 10**6])
def test_random_subscriptions_equal_the_daily_computation(spark, monkeypatch, large):
    # Every account is large, one of them is, none is.
    monkeypatch.setattr(spread, "GROUP_ROWS", large)
    pick = random.Random(5)
    origin = dt.date(1999, 11, 1)
    rows = []
    for i in range(600):
        start = origin + dt.timedelta(days=pick.randrange(500))
        cancel = start + dt.timedelta(days=pick.randrange(-2, 200))
        account = 1 if i % 3 == 0 else pick.randrange(2, 30)  # a third belongs to one account
        tier, cost = pick.choice([("T", "20.00"), ("P", "450.50"), ("E", "1200.00"), (None, None)])
        product, cancelled = pick.choice("ABZ"), pick.random() < 0.8
        account = None if i % 17 == 0 else account
        rows.append(
            (account, str(start), str(cancel) if cancelled else None, product, tier, cost)
        )
    first, last = dt.date(2000, 1, 10), dt.date(2001, 12, 31)
    df = fact(spark, rows, first="2000-01-10", as_of="1998-06-30")
    names = spark.createDataFrame([("A",), ("B",)], "p string")
    products = {r[1]: r[0] for r in names.select("p", surrogate_key("p")).collect()}
    offers = spark.createDataFrame(
        [("T", "20.00"), ("P", "450.50"), ("E", "1200.00")], "t string, c string"
    )
    labels = offers.select(F.concat_ws("-", "t", "c"), surrogate_key("t", "c"))
    tiers = {r[1]: r[0] for r in labels.collect()}
    actual = {
        (r.account_id, products.get(r.product_id), tiers.get(r.tier_id), r.financial_month): (
            r.total_revenue if r.total_revenue is None else round(r.total_revenue, 4),
            r.churned_subscriptions,
        )
        for r in df.collect()
    }
    expected = by_day(rows, first, last, {"A", "B"})
    assert actual.keys() == expected.keys()
    for key, (revenue, churned) in expected.items():
        assert actual[key] == (pytest.approx(revenue), churned), key


def test_months_cover_the_days(spark):
    rows = [
        (1, "2000-01-20", "2000-03-10", "A", "Pro", "31"),
        (2, "2000-02-29", "2000-02-29", "A", "T", "1"),
    ]
    periods = fin.distinct_periods(
        subscriptions(spark, rows), build_calendar(spark, "2000-01-01", "2000-01-01")
    )
    by_month = fin.subscription_months(periods).select(
        "account_id", "financial_month", F.col("days_covered").cast("long").alias("days_covered")
    )
    daily = (
        fin.subscription_days(periods)
        .groupBy("account_id", "financial_month")
        .agg(F.count("*").alias("days_covered"))
    )
    assert collected(by_month, "account_id", "financial_month") == collected(
        daily, "account_id", "financial_month"
    )


def test_churn(spark):
    rows = [
        (1, "2000-01-20", "2000-02-10", "A", "Pro", "31"),
        (1, "2000-01-01", "2000-03-10", "B", "Pro", "31"),
    ]
    periods = fin.distinct_periods(
        subscriptions(spark, rows), build_calendar(spark, "2000-01-01", "2000-01-01")
    )
    churn = fin.monthly_churn(fin.subscription_months(periods))
    assert [r[2:] for r in collected(churn, "financial_month")] == [(1, 0), (1, 1), (1, 1)]


NARROW = [(1, "2020-01-01", "2020-03-10", "A", "Pro", "31.00")]


def narrow_fact(spark, keep, cost=None):
    subs = subscriptions(spark, NARROW)
    if cost is not None:
        subs = subs.withColumn("monthly_cost", F.lit(cost))
    events = usage_events(spark, [(1, 1, 1, "2020-01-01T00:00:00", "A", "Usage")])
    calendar = build_calendar(spark, "2020-06-30", "2020-01-01", 0).filter(keep)
    return fin.financials_fact(subs, build_tiers(subs), build_products(events), calendar)


@pytest.mark.parametrize("keep", ["false", "year > 2020", "full_date >= '2020-03-11'"])
def test_without_covered_calendar_days_there_is_no_revenue(spark, keep):
    assert narrow_fact(spark, keep).isEmpty()


def test_calendar_gaps_are_not_covered(spark):
    found = narrow_fact(spark, "month <> 2 and full_date <> '2020-03-05'").orderBy("financial_month").collect()
    assert [r.financial_month for r in found] == [dt.date(2020, 1, 1), dt.date(2020, 3, 1)]
    # Nine of the first ten days of March are in the calendar.
    assert [r.total_revenue for r in found] == [31.0, pytest.approx(31.0 * 9 / 31)]


def test_prices_keep_their_scale(spark):
    found = narrow_fact(spark, "month = 1", Decimal("29.0055")).collect()
    assert [r.total_revenue for r in found] == [29.0055]


# ---- days of activity by boundary events -----------------------------------


def random_periods(spark, seed, calendar):
    pick = random.Random(seed)
    rows = []
    for _ in range(60):
        start = dt.date(2019, 1, 1) + dt.timedelta(days=pick.randrange(800))
        end = start + dt.timedelta(days=pick.choice([0, 3, 40, 400, pick.randrange(-2, 90)]))
        rows.append((pick.choice([1, 2, 3, None]), str(start), str(end), pick.choice("AB"), "Pro", "1.00"))
    staged = stage_subscriptions(subscriptions(spark, [*rows, *rows[:5]]))
    return fin.distinct_periods(staged, calendar)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("gaps", [False, True])
def test_days_by_events_equal_days_by_months(spark, seed, gaps):
    calendar = build_calendar(spark, "2021-06-01", "2019-01-15", horizon_years=0)
    if gaps:
        calendar = calendar.filter("month not in (3, 7) and day_of_month not in (1, 10, 31)")
    present = fin.calendar_months(calendar) if gaps else None
    periods = random_periods(spark, seed, calendar)
    spread_out = fin.with_days_active(fin.subscription_months(periods, present))
    by_events = fin.months_with_days_active(periods, present).select(*spread_out.columns)
    a, b = (sorted(map(tuple, df.collect()), key=repr) for df in (spread_out, by_events))
    assert a == b and len(a) > 100


def test_account_days_have_every_month_between(spark):
    calendar = build_calendar(spark, "2021-06-01", "2019-01-01", horizon_years=0)
    rows = [(1, "2019-01-30", "2019-02-02", "A", "Pro", "1.00"), (1, "2019-04-30", "2019-08-01", "A", "Pro", "1.00")]
    periods = fin.distinct_periods(stage_subscriptions(subscriptions(spark, rows)), calendar)
    (row,) = fin.account_days(periods).collect()
    assert (row.first_month, row.days) == (2019 * 12 + 1, [2, 2, 0, 1, 31, 30, 31, 1])


def test_month_rows_are_not_shuffled(spark):
    calendar = build_calendar(spark, "2021-06-01", "2019-01-01", horizon_years=0)
    plan = fin.months_with_days_active(random_periods(spark, 1, calendar))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text[: text.index("Generate posexplode")]


def test_hot_account_has_one_row_of_days(spark):
    calendar = build_calendar(spark, "2021-06-01", "2019-01-01", horizon_years=0)
    hot = spark.range(20_000).select(
        F.lit(1).cast("long").alias("account_id"), F.lit("A").alias("product"), F.lit("Pro").alias("tier"),
        F.lit(1).cast("decimal(10,2)").alias("monthly_cost"), F.date_add(F.lit(dt.date(2019, 1, 1)), (F.col("id") % 300).cast("int")).alias("start_date"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), F.expr("cast(id div 300 as int)")).alias("cancel_date"),
    )
    periods = fin.distinct_periods(hot, calendar)
    assert fin.account_days(periods).count() == 1
    total = fin.months_with_days_active(periods).groupBy("financial_month").agg(
        F.max("days_active").alias("a"), F.sum("days_covered").alias("b")
    )
    assert total.filter("a <> b").isEmpty() and total.count() > 12
