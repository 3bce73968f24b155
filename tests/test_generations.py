from __future__ import annotations

import datetime as dt
import threading

import pytest
from helpers import collected
from pyspark.sql import functions as F
from test_store import NAME, NEW, OLD, REPLACED, fact, short

from subsmart.operators.calendar import build_calendar, extend_calendar
from subsmart.schemas import MARTS
from subsmart.sources.generations import GenerationStore, Marker


@pytest.fixture
def store(spark, tmp_path):
    return GenerationStore(spark, str(tmp_path))


def dying(df):
    """``df`` whose last row cannot be computed, so that a write of it dies half-way."""
    fails = F.raise_error(F.lit("lost"))
    return df.withColumn("total_contacts", F.when(F.col("total_contacts") == 9, fails).otherwise(F.col("total_contacts")))


def test_partitions_in_the_batch_are_replaced(spark, store):
    assert not store.exists(NAME) and store.read(NAME).isEmpty()
    store.replace(NAME, fact(spark, OLD))
    for _ in range(2):  # once or twice, the table is the same
        store.replace_partitions(NAME, fact(spark, NEW))
        assert short(store.read(NAME)) == REPLACED
    assert store.read(NAME).schema == MARTS[NAME]
    store.replace(NAME, fact(spark, NEW))
    assert short(store.read(NAME)) == NEW
    with pytest.raises(ValueError, match="no replace key"):
        store.replace_partitions("dim_tiers", fact(spark, OLD))


@pytest.mark.parametrize("write", ["replace", "replace_partitions"])
def test_write_that_dies_leaves_the_old_rows(spark, store, tmp_path, write):
    store.replace(NAME, fact(spark, OLD))
    with pytest.raises(Exception, match="lost"):
        getattr(store, write)(NAME, dying(fact(spark, NEW)).repartition(2, "account_id", "usage_date"))
    assert short(store.read(NAME)) == OLD
    getattr(store, write)(NAME, fact(spark, NEW))
    assert short(store.read(NAME)) == (NEW if write == "replace" else REPLACED)
    store.clean(NAME, keep=1, hours=0)
    assert len(list((tmp_path / NAME).glob("write=*"))) == (1 if write == "replace" else 2)
    assert short(store.read(NAME)) == (NEW if write == "replace" else REPLACED)


def test_first_write_that_dies_makes_no_table(spark, store):
    with pytest.raises(Exception, match="lost"):
        store.replace(NAME, dying(fact(spark, NEW)))
    assert not store.exists(NAME) and store.read(NAME).isEmpty()


def test_mark_that_is_not_whole_does_not_count(spark, store, tmp_path):
    store.replace(NAME, fact(spark, OLD))
    (tmp_path / NAME / "_marks" / "2.json").write_text('{"writes": [{"id"')
    assert short(store.read(NAME)) == OLD
    store.replace_partitions(NAME, fact(spark, NEW))
    assert short(store.read(NAME)) == REPLACED
    assert Marker(spark, str(tmp_path / NAME)).numbers() == [1, 2, 3]


def test_reader_of_the_old_table_goes_on(spark, store):
    store.replace(NAME, fact(spark, OLD))
    before = store.read(NAME)
    store.replace(NAME, fact(spark, NEW))
    assert short(before) == OLD
    assert store.clean(NAME, keep=2, hours=0) == 0
    assert store.clean(NAME, keep=1, hours=24) == 0  # too young
    assert store.clean(NAME, keep=1, hours=0) == 1
    assert short(store.read(NAME)) == NEW


def test_table_may_be_built_from_itself(spark, store):
    store.replace(NAME, fact(spark, OLD))
    store.replace(NAME, store.read(NAME).withColumn("total_contacts", F.col("total_contacts") * 2))
    assert [n for *_, n in short(store.read(NAME))] == [10, 12, 14, 16]


def test_rows_without_key_are_one_partition(spark, store):
    without = fact(spark, NEW[:1]).withColumn("usage_date", F.lit(None).cast("date"))
    store.replace(NAME, fact(spark, OLD).unionByName(without))
    expected = [*short(fact(spark, OLD)), *short(without)]
    for _ in range(2):
        assert sorted(short(store.read(NAME))) == sorted(expected)
        store.replace_partitions(NAME, without)
    store.replace_partitions(NAME, fact(spark, NEW))  # brings none and leaves them
    assert sorted(short(store.read(NAME))) == sorted([*REPLACED, *short(without)])
    store.drop_partitions(NAME, ["2024-01-02", "__HIVE_DEFAULT_PARTITION__"])
    assert short(store.read(NAME)) == [r for r in REPLACED if r[0] != "2024-01-02"]


def test_replaced_partitions_are_not_scanned(spark, store):
    store.replace(NAME, fact(spark, OLD))
    store.replace_partitions(NAME, fact(spark, NEW))
    text = store.read(NAME)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(" in text and "DataFilters: []" in text
    files = {row[0] for row in store.read(NAME).select(F.input_file_name()).distinct().collect()}
    assert len([f for f in files if "usage_date=2024-01-01" in f]) == 1


def test_compacted_table_is_one_write(spark, store, tmp_path):
    store.replace(NAME, fact(spark, OLD))
    for _ in range(3):
        store.replace_partitions(NAME, fact(spark, NEW))
    store.compact(NAME)
    assert short(store.read(NAME)) == REPLACED
    store.clean(NAME, keep=1, hours=0)
    assert len(list((tmp_path / NAME).glob("write=*"))) == 1
    store.replace_partitions(NAME, fact(spark, []))
    assert short(store.read(NAME)) == REPLACED


def test_writers_at_once_both_take_effect(spark, tmp_path):
    days = [("2024-02-01", 1, 5), ("2024-02-02", 2, 6), ("2024-02-03", 3, 7), ("2024-02-04", 4, 8)]
    GenerationStore(spark, str(tmp_path)).replace(NAME, fact(spark, OLD))
    writers = [
        threading.Thread(target=GenerationStore(spark, str(tmp_path)).replace_partitions, args=(NAME, fact(spark, [row])))
        for row in days
    ]
    for writer in writers:
        writer.start()
    for writer in writers:
        writer.join()
    assert short(GenerationStore(spark, str(tmp_path)).read(NAME)) == [*OLD, *days]


# ---- upsert ---------------------------------------------------------------


def days_of(store):
    return collected(store.read("dim_dates").select("full_date", "day_name"), "full_date")


def test_repeated_upsert_changes_nothing(spark, store, tmp_path):
    first = build_calendar(spark, "2020-06-01", "2020-01-01", horizon_years=0)
    store.upsert("dim_dates", first, "date_id")
    more = extend_calendar(store.read("dim_dates"), "2021-06-01", "2020-01-01", horizon_years=0)
    more.count()
    frozen = spark.createDataFrame(more.collect(), MARTS["dim_dates"])
    for _ in range(3):
        store.upsert("dim_dates", frozen, "date_id")
        assert store.read("dim_dates").count() == 366 + 365
        assert store.read("dim_dates").select("date_id").distinct().count() == 366 + 365
    assert Marker(spark, str(tmp_path / "dim_dates")).numbers() == [1, 2]


def test_upsert_replaces_known_days_and_adds_others(spark, store):
    store.replace("dim_dates", build_calendar(spark, "2020-06-01", "2020-12-29", horizon_years=0))
    changed = build_calendar(spark, "2021-06-01", "2020-12-31", horizon_years=1).filter("date_id < 20210103")
    renamed = changed.withColumn("day_name", F.lit("x"))
    store.upsert("dim_dates", renamed.unionByName(renamed), "date_id")
    assert days_of(store) == [
        (dt.date(2020, 12, 29), "Tuesday"), (dt.date(2020, 12, 30), "Wednesday"),
        (dt.date(2020, 12, 31), "x"), (dt.date(2021, 1, 1), "x"), (dt.date(2021, 1, 2), "x"),
    ]


def test_upserts_at_once_double_no_day(spark, tmp_path):
    days = build_calendar(spark, "2020-06-01", "2020-01-01", horizon_years=0)
    runs = [
        threading.Thread(target=GenerationStore(spark, str(tmp_path)).upsert, args=("dim_dates", days, "date_id"))
        for _ in range(4)
    ]
    for run in runs:
        run.start()
    for run in runs:
        run.join()
    assert GenerationStore(spark, str(tmp_path)).read("dim_dates").count() == 366


def test_upsert_that_dies_leaves_the_table(spark, store):
    days = build_calendar(spark, "2020-06-01", "2020-01-01", horizon_years=0)
    store.upsert("dim_dates", days, "date_id")
    fails = F.when(F.col("date_id") == 20200302, F.raise_error(F.lit("lost"))).otherwise(F.col("day_name"))
    with pytest.raises(Exception, match="lost"):
        store.upsert("dim_dates", days.withColumn("day_name", fails), "date_id")
    assert store.read("dim_dates").count() == 366
