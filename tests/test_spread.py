from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from subsmart.operators import spread


def rows_with_hot_group(spark):
    """A third of the rows share one key, and some keys are NULL."""
    n = F.col("id")
    key = F.when(n % 3 == 0, 7).when(n % 100 != 1, n % 500)
    return spark.range(30_000).select(key.alias("k"), (n % 11).alias("m"), n.alias("v"))


@pytest.mark.parametrize("large", [50, 1_000, 10**6])
def test_total_equals_window(spark, monkeypatch, large):
    monkeypatch.setattr(spread, "GROUP_ROWS", large)
    df = rows_with_hot_group(spark)
    expected = df.withColumn("total", F.sum("v").over(Window.partitionBy("k", "m")))
    actual = spread.group_total(df, ["k", "m"], F.col("v"), "total", ["v"])
    assert actual.columns == expected.columns
    assert actual.exceptAll(expected).isEmpty() and expected.exceptAll(actual).isEmpty()


def test_large_groups_never_meet_in_one_window(spark, monkeypatch):
    monkeypatch.setattr(spread, "GROUP_ROWS", 500)
    seen = []
    real = Window.partitionBy
    monkeypatch.setattr(
        spread.Window, "partitionBy", lambda *keys: seen.append(keys) or real(*keys)
    )
    df = rows_with_hot_group(spark)
    total = spread.group_total(df, ["k"], F.col("v"), "total", ["v"])
    piece = seen[0][-1]
    hot = df.filter("k = 7").count()
    assert hot > 10_000 and total.count() == df.count()
    cuts = df.join(
        df.groupBy("k").count().select(
            F.struct("k").alias("_group"), F.ceil(F.col("count") / 500).alias("_cuts")
        ),
        F.struct("k") == F.col("_group"),
    )
    assert cuts.groupBy("k", piece.alias("p")).count().agg(F.max("count")).first()[0] < 750


def test_bounded_group_uses_one_window(spark):
    df = rows_with_hot_group(spark)
    plan = spread.group_total(df, ["k"], F.col("v"), "total", ["v"], rows_bound=30_000)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in text and "Join" not in text


def test_sized_counts_and_marks_only_small_sides(spark):
    df = spark.range(100).select(F.col("id"), F.lit("x" * 10).alias("text"))
    small = spread.sized(df)
    assert small.rows == 100
    assert "ResolvedHint" in small.frame._jdf.queryExecution().analyzed().toString()
    assert spread.sized(small) is small
    assert spread.sized(df, max_rows=99).rows is None
    assert spread.sized(df, max_bytes=500).rows is None
    assert spread.sized(df.limit(0)).rows == 0


def test_settled_plan_has_no_lineage(spark):
    df = spread.settle(spark.range(10).groupBy((F.col("id") % 2).alias("k")).count())
    assert "Aggregate" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert df.count() == 2
