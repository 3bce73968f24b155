from __future__ import annotations

import datetime as dt

import pytest
from helpers import collected, object_counts
from pyspark.sql import functions as F

from subsmart.operators.objects import object_counts_fact
from subsmart.operators.replace import replace_by_key
from subsmart.operators.staging import stage_object_counts
from subsmart.schemas import MARTS
from subsmart.sources.store import MartStore

NAME = "fact_object_counts"
OLD = [("2024-01-01", 1, 5), ("2024-01-01", 2, 6), ("2024-01-02", 1, 7), ("2024-01-03", 1, 8)]
# The batch brings day 1 without account 2, and day 4.
NEW = [("2024-01-01", 1, 50), ("2024-01-04", 1, 9)]
REPLACED = [("2024-01-01", 1, 50), ("2024-01-02", 1, 7), ("2024-01-03", 1, 8), ("2024-01-04", 1, 9)]


def fact(spark, rows):
    return object_counts_fact(stage_object_counts(object_counts(spark, rows)))


def short(df):
    keys = ["usage_date", "account_id"]
    rows = collected(df.select(*keys, "total_contacts"), *keys)
    return [(str(d), a, n) for d, a, n in rows]


def test_partitions_in_the_batch_are_replaced(spark, tmp_path):
    store = MartStore(spark, str(tmp_path))
    assert not store.exists(NAME) and store.read(NAME).isEmpty()
    store.replace(NAME, fact(spark, OLD))
    for _ in range(2):  # once or twice, the table is the same
        store.replace_partitions(NAME, fact(spark, NEW))
        assert short(store.read(NAME)) == REPLACED
    assert store.read(NAME).schema == MARTS[NAME]
    store.replace(NAME, fact(spark, NEW))
    assert short(store.read(NAME)) == NEW


def test_untouched_partitions_keep_their_files(spark, tmp_path):
    store = MartStore(spark, str(tmp_path))
    store.replace(NAME, fact(spark, OLD))
    kept = sorted((tmp_path / NAME / "usage_date=2024-01-02").glob("*.parquet"))
    store.replace_partitions(NAME, fact(spark, NEW))
    assert sorted((tmp_path / NAME / "usage_date=2024-01-02").glob("*.parquet")) == kept


def test_incremental_from_empty_equals_full(spark, tmp_path):
    full, step = MartStore(spark, str(tmp_path / "a")), MartStore(spark, str(tmp_path / "b"))
    full.replace(NAME, fact(spark, OLD))
    step.replace_partitions(NAME, fact(spark, OLD))
    assert short(full.read(NAME)) == short(step.read(NAME))


def test_unfinished_full_write_does_not_count(spark, tmp_path):
    store = MartStore(spark, str(tmp_path))
    store.replace(NAME, fact(spark, OLD))
    assert store.exists(NAME)
    (tmp_path / NAME / "_SUCCESS").unlink()
    assert not store.exists(NAME) and store.read(NAME).isEmpty()


def test_rows_without_key_are_one_partition(spark, tmp_path):
    store = MartStore(spark, str(tmp_path))
    without = fact(spark, NEW[:1]).withColumn("usage_date", F.lit(None).cast("date"))
    store.replace(NAME, fact(spark, OLD).unionByName(without))
    expected = [*short(fact(spark, OLD)), *short(without)]
    for _ in range(2):
        assert sorted(short(store.read(NAME))) == sorted(expected)
        store.replace_partitions(NAME, without)
    store.replace_partitions(NAME, fact(spark, NEW))  # brings none and leaves them
    assert sorted(short(store.read(NAME))) == sorted([*REPLACED, *short(without)])


def test_tables_without_replace_key_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="no replace key"):
        MartStore(spark, str(tmp_path)).replace_partitions("dim_tiers", fact(spark, OLD))


def test_frame_form_equals_the_table_form(spark):
    assert short(replace_by_key(fact(spark, OLD), fact(spark, NEW), "usage_date")) == REPLACED


def test_frame_form_keeps_rows_without_key(spark):
    old = fact(spark, OLD).withColumn(
        "usage_date", F.when(F.col("usage_date") > F.lit(dt.date(2024, 1, 1)), F.col("usage_date"))
    )
    kept = replace_by_key(old, fact(spark, NEW), "usage_date")
    assert kept.filter("usage_date is null").count() == 2


def test_hot_day_is_written_by_several_tasks(spark, tmp_path):
    # Half of the rows fall on one day; small targets make the split visible here.
    offset = F.greatest(F.lit(0), F.col("id") % 40 - 20).cast("int")
    rows = spark.range(200_000).select(
        F.col("id").alias("account_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), offset).alias("usage_date"),
        *(F.xxhash64("id", F.lit(c)).alias(c) for c in MARTS[NAME].names[2:]),
    )
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
        "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.2",
    }
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        MartStore(spark, str(tmp_path)).replace(NAME, rows.repartition(8))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    hot = list((tmp_path / NAME / "usage_date=2024-01-01").glob("*.parquet"))
    assert len(hot) > 1
    assert MartStore(spark, str(tmp_path)).read(NAME).count() == 200_000
