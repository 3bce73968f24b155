from __future__ import annotations

import datetime as dt
import random

import pytest
from helpers import accounts, collected
from pyspark.sql import functions as F

from subsmart.operators import history as hist
from subsmart.operators.calendar import build_calendar
from subsmart.operators.staging import stage_accounts
from subsmart.plans import registry
from subsmart.sources.store import HistoryStore

DAYS = [dt.date(2002, 1, 1), dt.date(2003, 1, 1), dt.date(2004, 1, 1)]


@pytest.fixture(scope="module")
def calendar(spark):
    return build_calendar(spark, "2005-01-01", "2000-01-01").cache()


def batch(spark, calendar, rows):
    return hist.account_batch(stage_accounts(accounts(spark, rows)), calendar)


def versions(history):
    """``(account, vertical, nps, start, end, current)`` in order."""
    columns = ["account_id", "vertical", "nps", "start_date_id", "end_date_id", "is_current"]
    return collected(history.select(columns), "account_id", "start_date_id")


BASE = [(1, "Ann", "2001-05-01", "FR", "Retail", 5), (2, "Bob", "2001-06-01", "DE", None, None)]


def test_first_load_starts_at_signup(spark, calendar):
    rows = [*BASE, (3, "Late", "2050-01-01", "DE", "x", 1), (4, "None", None, "DE", "x", 1)]
    first = hist.first_versions(batch(spark, calendar, rows))
    assert versions(first) == [
        (1, "Retail", 5, 20010501, None, True),
        (2, None, None, 20010601, None, True),
    ]


def test_change_closes_and_opens(spark, calendar):
    first = hist.first_versions(batch(spark, calendar, BASE))
    moved = [
        (1, "Ann", "2001-05-01", "FR", "Bank", 5),
        BASE[1],
        (9, "New", "2001-12-01", "IT", "y", 3),
    ]
    after = hist.apply_batch(first, batch(spark, calendar, moved), DAYS[0])
    assert versions(after) == [
        (1, "Retail", 5, 20010501, 20020101, False),
        (1, "Bank", 5, 20020101, None, True),
        (2, None, None, 20010601, None, True),
        (9, "y", 3, 20011201, None, True),
    ]


def test_name_and_unchanged_nulls_open_no_version(spark, calendar):
    first = hist.first_versions(batch(spark, calendar, BASE))
    renamed = batch(spark, calendar, [(1, "Anna", *BASE[0][2:]), BASE[1]])
    assert hist.changed_rows(renamed, first).isEmpty()
    assert versions(hist.apply_batch(first, renamed, DAYS[0])) == versions(first)


def test_change_to_and_from_null_is_a_change(spark, calendar):
    first = hist.first_versions(batch(spark, calendar, BASE))
    rows = [
        (1, "Ann", "2001-05-01", "FR", "Retail", None),
        (2, "Bob", "2001-06-01", "DE", "v", None),
    ]
    swapped = batch(spark, calendar, rows)
    assert hist.changed_rows(swapped, first).count() == 2


def test_change_back_to_old_values_is_a_change(spark, calendar):
    first = hist.first_versions(batch(spark, calendar, BASE))
    moved = [(1, "Ann", "2001-05-01", "FR", "Bank", 5), BASE[1]]
    after = hist.apply_batch(first, batch(spark, calendar, moved), DAYS[0])
    back = hist.apply_batch(after, batch(spark, calendar, BASE), DAYS[1])
    assert [v[1:] for v in versions(back) if v[0] == 1] == [
        ("Retail", 5, 20010501, 20020101, False),
        ("Bank", 5, 20020101, 20030101, False),
        ("Retail", 5, 20030101, None, True),
    ]


def test_account_gone_from_the_batch_stays(spark, calendar):
    first = hist.first_versions(batch(spark, calendar, BASE))
    after = hist.apply_batch(first, batch(spark, calendar, BASE[:1]), DAYS[0])
    assert versions(after) == versions(first)


def test_change_on_the_start_day_replaces_the_version(spark, calendar):
    first = hist.first_versions(batch(spark, calendar, BASE[:1]))
    moved = batch(spark, calendar, [(1, "Ann", "2001-05-01", "FR", "Bank", 5)])
    after = hist.apply_batch(first, moved, dt.date(2001, 5, 1))
    assert versions(after) == [(1, "Bank", 5, 20010501, None, True)]


def test_repeated_account_rows_give_one_version(spark, calendar):
    rows = [(1, "Ann", "2001-05-01", "FR", "Bank", 5), (1, "Ann", "2001-07-01", "FR", "Retail", 6)]
    assert versions(hist.first_versions(batch(spark, calendar, rows))) == [
        (1, "Retail", 6, 20010501, None, True)
    ]


def test_batches_chain_and_repeat(spark, folder):
    first, *later = registry._batches(spark, folder, 3)
    later.append(later[-1])
    history = hist.first_versions(first)
    counts = [history.count()]
    for rows, day in zip(later, DAYS):
        history = hist.apply_batch(history, rows, day)
        counts.append(history.count())
    assert counts[0] < counts[1] < counts[2] == counts[3]
    current = history.filter("is_current").groupBy("account_id").count()
    assert current.filter("count <> 1").isEmpty() and current.count() == counts[0]
    chain = hist.version_chain(history.drop("end_date_id", "is_current"))
    assert chain.exceptAll(history).isEmpty() and history.exceptAll(chain).isEmpty()


def test_random_batches_equal_a_plain_computation(spark, calendar, tmp_path):
    pick = random.Random(3)
    signup = {i: f"2001-{pick.randrange(1, 13):02d}-15" for i in range(25)}
    expected, store = {}, HistoryStore(spark, str(tmp_path / "accounts"))
    for day in [dt.date(2001, 12, 31), *DAYS]:
        rows = [
            (i, "n", signup[i], pick.choice(["FR", None]), pick.choice("x"), pick.choice([1, None]))
            for i in signup
            if pick.random() < 0.8
        ]
        today = int(day.strftime("%Y%m%d"))
        for i, _, start, *values in rows:
            known = expected.setdefault(i, [])
            if not known:
                known.append([values, int(start.replace("-", "")), None])
            elif known[-1][0] != values:
                known[-1][2] = today
                known.append([values, today, None])
        store.write(hist.advance_current(store.current(), batch(spark, calendar, rows), day), day)
    actual = {}
    for r in store.read().orderBy("account_id", "start_date_id").collect():
        assert r.is_current == (r.end_date_id is None)
        actual.setdefault(r.account_id, []).append(
            [[r.country, r.vertical, r.nps], r.start_date_id, r.end_date_id]
        )
    assert actual == expected


def test_stored_history_equals_the_frames(spark, folder, tmp_path):
    first, *later = registry._batches(spark, folder, 3)
    store = HistoryStore(spark, str(tmp_path / "accounts"))
    assert store.read().isEmpty() and store.batches() == []
    expected = hist.first_versions(first)
    day = registry.FIRST_LOAD
    store.write(hist.advance_current(store.current(), first, day), day)
    for rows, day in zip(later, DAYS):
        store.write(hist.advance_current(store.current(), rows, day), day)
        expected = hist.apply_batch(expected, rows, day)
    assert store.batches() == [20011231, 20020101, 20030101]
    stored = store.read()
    assert stored.exceptAll(expected).isEmpty() and expected.exceptAll(stored).isEmpty()

    # A batch run again gives the same history; an older one is refused.
    base = store.current(before=20030101)
    store.write(hist.advance_current(base, later[1], DAYS[1]), DAYS[1])
    assert store.read().exceptAll(expected).isEmpty() and store.read().count() == expected.count()
    with pytest.raises(ValueError, match="older"):
        store.write(base, DAYS[0])

    # The history as of an earlier batch, and past a batch that never finished.
    assert store.read(upto=20011231).count() == hist.first_versions(first).count()
    (tmp_path / "accounts" / "as_of=20030101" / "_SUCCESS").unlink()
    assert store.batches() == [20011231, 20020101]
    assert store.read().filter(F.col("start_date_id") == 20030101).isEmpty()
    assert store.read().filter("is_current").count() == first.count()
