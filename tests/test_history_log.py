from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from test_history import BASE, DAYS, batch, calendar, versions  # noqa: F401

from subsmart.operators import history as hist
from subsmart.plans import registry
from subsmart.sources import history_log
from subsmart.sources.history_log import HistoryLog


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def stored_rows(spark, folder):
    """Rows in all files below ``folder``."""
    return sum(spark.read.parquet(str(p)).count() for p in folder.glob("write=*"))


def test_log_equals_the_frames(spark, folder, tmp_path):
    first, *later = registry._batches(spark, folder, 3)
    store, expected = HistoryLog(spark, str(tmp_path)), hist.first_versions(first)
    assert store.read().isEmpty() and store.current().isEmpty() and store.batches() == []
    store.apply(first, registry.FIRST_LOAD)
    assert same(store.read(), expected)
    steps = [(20011231, expected)]
    for rows, day in zip([*later, later[-1]], DAYS):
        store.apply(rows, day)
        expected = hist.apply_batch(expected, rows, day)
        steps.append((int(day.strftime("%Y%m%d")), expected))
        assert same(store.read(), expected) and same(store.current(), expected.filter("is_current"))
    assert store.batches() == [day for day, _ in steps]
    for day, history in steps:  # also across a base that is newer
        assert same(store.read(upto=day), history)

    # The last batch run again gives the same history; an older one is refused.
    store.apply(later[-1], DAYS[-1])
    assert same(store.read(), expected) and store.batches() == [day for day, _ in steps]
    store.compact()
    assert same(store.read(), expected)
    store.apply(later[-1], DAYS[-1])
    assert same(store.read(), expected)
    with pytest.raises(ValueError, match="older"):
        store.apply(first, DAYS[0])


def test_random_batches_equal_a_plain_computation(spark, calendar, tmp_path, monkeypatch):  # noqa: F811
    pick = random.Random(5)
    monkeypatch.setattr(history_log, "LOG_BATCHES", 2)
    signup = {i: f"2001-{pick.randrange(1, 13):02d}-15" for i in range(25)}
    expected, store = {}, HistoryLog(spark, str(tmp_path), buckets=4)
    for n in range(7):
        day = dt.date(2002, 1, 1) + dt.timedelta(days=40 * n)
        rows = [
            (i, "n", signup[i], pick.choice(["FR", None]), pick.choice("x"), pick.choice([1, None]))
            for i in signup
            if pick.random() < 0.5
        ]
        today = int(day.strftime("%Y%m%d"))
        for i, _, start, *values in rows:
            known = expected.setdefault(i, [])
            if not known:
                known.append([values, int(start.replace("-", "")), None])
            elif known[-1][0] != values:
                known[-1][2] = today
                known.append([values, today, None])
        store.apply(batch(spark, calendar, rows), day)
    actual = {}
    for r in store.read().orderBy("account_id", "start_date_id").collect():
        assert r.is_current == (r.end_date_id is None)
        actual.setdefault(r.account_id, []).append([[r.country, r.vertical, r.nps], r.start_date_id, r.end_date_id])
    assert actual == expected


def test_unchanged_batches_store_no_row(spark, calendar, tmp_path):  # noqa: F811
    """Fifty batches: storage follows the versions, not the batches."""
    people = [(i, "n", "2001-05-01", "FR", "Retail", 1) for i in range(200)]
    moved = [(0, "n", "2001-05-01", "FR", "Bank", 1), *people[1:]]
    before, after = batch(spark, calendar, people).cache(), batch(spark, calendar, moved).cache()
    store = HistoryLog(spark, str(tmp_path), buckets=4)
    for n in range(50):
        store.apply(before if n < 25 else after, dt.date(2002, 1, 1) + dt.timedelta(days=n))
    assert len(store.batches()) == 50
    assert store.read().count() == 201 and store.current().count() == 200
    entries = store.marker.last()[1]["log"]
    assert [n for n, e in enumerate(entries) if e["id"]] == [0, 25]
    # The first load, one base of open versions, and the version closed and opened.
    assert stored_rows(spark, tmp_path) == 200 + 200 + 2


def test_storage_is_bounded_while_accounts_change(spark, calendar, tmp_path, monkeypatch):  # noqa: F811
    monkeypatch.setattr(history_log, "LOG_BATCHES", 3)
    store = HistoryLog(spark, str(tmp_path), buckets=4)
    for n in range(12):
        rows = [(i, "n", "2001-05-01", "FR", f"v{n if i == n else 0}", 1) for i in range(40)]
        store.apply(batch(spark, calendar, rows), dt.date(2002, 1, 1) + dt.timedelta(days=n))
        store.clean(keep=1, hours=0)
    n_versions = store.read().count()
    log = [e["id"] for e in store.marker.last()[1]["log"] if e["id"]]
    in_log = sum(spark.read.parquet(str(tmp_path / f"write={w}")).count() for w in log)
    assert in_log <= 2 * n_versions  # each version opened once and closed once at most
    assert stored_rows(spark, tmp_path) <= 2 * n_versions + 40


def test_batch_reads_the_buckets_of_its_accounts(spark, calendar, tmp_path):  # noqa: F811
    people = [(i, "n", "2001-05-01", "FR", "Retail", 1) for i in range(400)]
    store = HistoryLog(spark, str(tmp_path), buckets=16)
    store.apply(batch(spark, calendar, people), DAYS[0])
    store.compact()
    read = [
        store.current_of(batch(spark, calendar, people[:n])).select(F.input_file_name()).distinct().count()
        for n in (1, 4, 400)
    ]
    assert read[0] == 1 and 1 < read[1] <= 4 and read[2] == 16
    one = batch(spark, calendar, people[:1])
    changes = hist.batch_changes(store.current_of(one), one, DAYS[1])
    text = changes._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in text and "FullOuter" not in text


def test_batch_that_dies_is_not_listed(spark, calendar, tmp_path):  # noqa: F811
    store = HistoryLog(spark, str(tmp_path))
    store.apply(batch(spark, calendar, BASE), DAYS[0])
    before = versions(store.read())
    moved = batch(spark, calendar, [(1, "Ann", "2001-05-01", "FR", "Bank", 5), BASE[1]])
    fails = F.when(F.col("account_id") == 1, F.raise_error(F.lit("lost"))).otherwise(F.col("nps")).cast("int")
    with pytest.raises(Exception, match="lost"):
        store.apply(moved.withColumn("nps", fails), DAYS[1])
    assert versions(store.read()) == before and store.batches() == [20020101]
    store.apply(moved, DAYS[1])
    assert [v[1] for v in versions(store.read()) if v[0] == 1] == ["Retail", "Bank"]


def test_change_on_the_start_day_replaces_the_version(spark, calendar, tmp_path):  # noqa: F811
    store = HistoryLog(spark, str(tmp_path))
    store.apply(batch(spark, calendar, BASE[:1]), dt.date(2001, 4, 30))
    store.compact()
    store.apply(batch(spark, calendar, [(1, "Ann", "2001-05-01", "FR", "Bank", 5)]), dt.date(2001, 5, 1))
    assert versions(store.read()) == [(1, "Bank", 5, 20010501, None, True)]
    assert versions(store.read(upto=20010430)) == [(1, "Retail", 5, 20010501, None, True)]


def test_batch_stored_meanwhile_is_reported(spark, calendar, tmp_path, monkeypatch):  # noqa: F811
    store, other = HistoryLog(spark, str(tmp_path)), HistoryLog(spark, str(tmp_path))
    write = store._write

    def slow(*args):
        other.apply(batch(spark, calendar, BASE[1:]), DAYS[0])
        return write(*args)

    monkeypatch.setattr(store, "_write", slow)
    with pytest.raises(RuntimeError, match="run it again"):
        store.apply(batch(spark, calendar, BASE[:1]), DAYS[0])
    assert [v[0] for v in versions(store.read())] == [2]
