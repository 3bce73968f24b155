from __future__ import annotations

import datetime as dt
import random

import pytest
from helpers import object_counts, subscriptions, usage_events
from test_pipeline import sources

from subsmart.operators import changes
from subsmart.operators.calendar import build_calendar
from subsmart.operators.dimensions import build_products, build_tiers
from subsmart.operators.staging import stage_object_counts, stage_subscriptions, stage_usage_events
from subsmart.plans.build import Warehouse
from subsmart.sources.generations import Marker


def prints_of(df):
    return {r.key: r.print for r in df.collect()}


def differing(a, b):
    """Keys of ``b`` whose print is new."""
    return {str(k) for k in b if a.get(k) != b[k]}


@pytest.fixture(scope="module")
def calendar(spark):
    return build_calendar(spark, "2020-06-01", "2019-01-01", horizon_years=0).cache()


def months(spark, calendar, rows, tiers=None):
    staged = stage_subscriptions(subscriptions(spark, rows))
    products = build_products(stage_usage_events(usage_events(spark, [(1, 1, 1, "2020-01-01", "A", "Usage")])))
    return prints_of(changes.financial_prints(staged, build_tiers(staged if tiers is None else tiers), products, calendar))


PERIODS = [
    (1, "2019-01-15", "2019-04-10", "A", "Pro", "29.00"),
    (2, "2019-03-01", "2020-02-01", "A", "Pro", "29.00"),
    (None, "2019-02-01", "2019-02-20", "A", None, None),
    (3, "2019-05-01", "2019-04-01", "A", "Pro", "29.00"),  # reversed: covers nothing
    (4, "2019-05-01", None, "A", "Pro", "29.00"),  # open: covers nothing
]


def test_months_of_changed_periods_are_found(spark, calendar):
    before = months(spark, calendar, PERIODS)
    assert sorted(before)[0] == dt.date(2019, 1, 1) and sorted(before)[-1] == dt.date(2020, 2, 1)
    assert months(spark, calendar, PERIODS[::-1]) == before
    longer = [(1, "2019-01-15", "2019-05-01", "A", "Pro", "29.00"), *PERIODS[1:]]
    found = differing(before, months(spark, calendar, longer))
    assert found == {f"2019-0{m}-01" for m in (1, 2, 3, 4, 5)}
    moved = [*PERIODS[:2], (None, "2019-02-01", "2019-02-20", None, "A", None), *PERIODS[3:]]
    assert differing(before, months(spark, calendar, moved)) == {"2019-02-01"}
    twice = [*PERIODS, PERIODS[2], PERIODS[2]]
    assert differing(before, months(spark, calendar, twice)) == {"2019-02-01"}
    assert differing(before, months(spark, calendar, [*PERIODS[:3]])) == set()


def test_months_follow_dimensions_and_calendar_days(spark, calendar):
    before = months(spark, calendar, PERIODS)
    no_tiers = stage_subscriptions(subscriptions(spark, PERIODS[2:3]))
    changed = differing(before, months(spark, calendar, PERIODS, tiers=no_tiers))
    assert len(changed) == 14
    gap = calendar.filter("full_date <> '2019-03-05'")
    assert differing(before, months(spark, gap, PERIODS)) == {"2019-03-01"}
    without = calendar.filter("month <> 3 or year <> 2019")
    assert dt.date(2019, 3, 1) not in months(spark, without, PERIODS)


def test_random_periods_against_a_plain_list(spark, calendar):
    pick = random.Random(4)

    def some():
        start = dt.date(2019, 1, 1) + dt.timedelta(days=pick.randrange(700))
        end = start + dt.timedelta(days=pick.randrange(-3, 200))
        return (pick.randrange(3), str(start), str(end), "A", "Pro", "1.00")

    def plain(rows):
        out = {}
        for r in rows:
            day, end = (max(min(dt.date.fromisoformat(x), dt.date(2020, 12, 31)), dt.date(2019, 1, 1)) for x in r[1:3])
            if r[1] > r[2]:
                continue
            for m in {(day + dt.timedelta(days=i)).replace(day=1) for i in range((end - day).days + 1)}:
                out.setdefault(m, []).append(r)
        return {m: sorted(rows) for m, rows in out.items()}

    first = [some() for _ in range(30)]
    second = [*first[:26], *(some() for _ in range(3))]
    a, b = months(spark, calendar, first), months(spark, calendar, second)
    plain_a, plain_b = plain(first), plain(second)
    assert set(a) == set(plain_a) and set(b) == set(plain_b)
    assert differing(a, b) == differing(plain_a, plain_b)


def test_days_of_changed_rows_are_found(spark):
    counts = [("2024-01-01", 1, 5), ("2024-01-01", 1, 5), ("2024-01-02", 1, 7), (None, 1, 1)]
    of = lambda rows: prints_of(changes.object_prints(stage_object_counts(object_counts(spark, rows))))
    before = of(counts)
    assert set(map(str, before)) == {"2024-01-01", "2024-01-02", "None"}
    assert differing(before, of([*counts, counts[0]])) == {"2024-01-01"}
    assert differing(before, of([("2024-01-01", 1, 6), ("2024-01-01", 1, 4), *counts[2:]])) == {"2024-01-01"}
    assert differing(before, of([*counts[:3], (None, 2, 1)])) == {"None"}


def test_events_that_do_not_count_change_nothing(spark):
    events = [(1, 1, 1, "2020-01-01T08:00:00", "A", "Usage"), (1, 1, 2, "2020-01-02T08:00:00", "A", "Usage")]

    def of(rows):
        staged = stage_usage_events(usage_events(spark, rows))
        return prints_of(changes.usage_prints(staged, build_products(stage_usage_events(usage_events(spark, events)))))

    before = of(events)
    assert of([*events, (1, 1, 3, "2020-01-01T09:00:00", "A", "Error")]) == before
    assert of([*events, (1, 1, 3, "2020-01-01T09:00:00", "B", "Usage")]) == before
    assert differing(before, of([events[0], (*events[1][:5], "Activation")])) == {"2020-01-02"}


def test_unchanged_sources_write_nothing(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    facts = ["fact_object_counts", "fact_product_usage", "fact_financials"]
    warehouse.run_all(sources(spark), dt.date(2020, 3, 1))
    for _ in range(2):
        warehouse.run_all(sources(spark), dt.date(2020, 3, 1))
    for name in facts:
        assert Marker(spark, str(tmp_path / name)).numbers() == [1]


def test_late_change_in_an_old_month_rewrites_that_month(spark, tmp_path):
    periods = [(1, f"20{y}-01-10", f"20{y}-02-20", "A", "Pro", "29.00") for y in (15, 16, 17, 18, 19)]
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.run_all(sources(spark, periods=periods), dt.date(2020, 3, 1))
    late = [*periods[:1], (1, "2016-01-10", "2016-02-25", "A", "Pro", "29.00"), *periods[2:]]
    warehouse.run_all(sources(spark, periods=late), dt.date(2020, 3, 1))
    (second,) = [w["id"] for w in Marker(spark, str(tmp_path / "fact_financials")).last()[1]["writes"]][1:]
    written = {p.name for p in (tmp_path / "fact_financials" / f"write={second}").glob("financial_month=*")}
    assert written == {"financial_month=2016-01-01", "financial_month=2016-02-01"}
    fresh = Warehouse(spark, str(tmp_path / "fresh"))
    fresh.run_all(sources(spark, periods=late), dt.date(2020, 3, 1))
    a, b = (w.read("fact_financials") for w in (warehouse, fresh))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and a.count() == 10


def test_run_that_dies_after_the_fact_is_repeated(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.run_all(sources(spark), dt.date(2020, 3, 1))
    later = sources(spark, counts=[("2020-01-01", 1, 500), ("2020-01-02", 1, 6)])

    def dies(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(warehouse.store, "upsert", dies)
        with pytest.raises(RuntimeError, match="lost"):
            warehouse.run_all(later, dt.date(2020, 3, 1), only=["fact_object_counts"])
    warehouse.run_all(later, dt.date(2020, 3, 1), only=["fact_object_counts"])
    rows = warehouse.read("fact_object_counts").orderBy("usage_date").collect()
    assert [r.total_contacts for r in rows] == [500, 6]


def test_since_forgets_what_it_may_have_changed(spark, tmp_path):
    warehouse, only = Warehouse(spark, str(tmp_path)), ["fact_object_counts"]
    warehouse.run_all(sources(spark), dt.date(2020, 3, 1), only=only)
    changed = sources(spark, counts=[("2020-01-01", 1, 5), ("2020-01-02", 1, 600)])
    warehouse.run_all(changed, dt.date(2020, 3, 1), only=only, since="2020-01-02")
    warehouse.run_all(sources(spark), dt.date(2020, 3, 1), only=only)  # the source went back
    rows = warehouse.read("fact_object_counts").orderBy("usage_date").collect()
    assert [r.total_contacts for r in rows] == [5, 6]
