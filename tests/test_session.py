from __future__ import annotations

import pytest

from subsmart import session
from subsmart.operators.spread import shared_folder


@pytest.fixture
def restored(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    yield spark
    spark.conf.set(key, before)


def test_shuffles_follow_the_input(restored, folder, monkeypatch):
    assert session.fit_shuffles(restored, folder) == 4  # small input keeps the setting
    monkeypatch.setattr(session, "SHUFFLE_BYTES", 10_000)
    raised = session.fit_shuffles(restored, folder)
    assert 4 < raised == int(restored.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(session, "SHUFFLE_BYTES", 1 << 30)
    assert session.fit_shuffles(restored, folder) == raised  # never lowered


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or shared_folder(spark) == configured
    assert spark.sparkContext.getCheckpointDir() is not None


def test_shuffles_follow_the_sources_of_a_run(restored, folder, monkeypatch):
    from subsmart.sources import samples

    sources = vars(samples.sample_sources(restored, folder)).values()
    assert sum(map(session.planned_bytes, sources)) > 10_000
    monkeypatch.setattr(session, "SHUFFLE_BYTES", 2_000)
    raised = session.fit_shuffles_to(restored, sources)
    assert 4 < raised == int(restored.conf.get("spark.sql.shuffle.partitions"))


def test_tasks_of_the_revenue_fact_follow_its_month_rows(spark, folder, monkeypatch):
    from pyspark.sql import functions as F

    from subsmart.operators import financials as fin
    from subsmart.operators import spread
    from subsmart.plans import registry

    monkeypatch.setattr(spread, "TASK_ROWS", 300)
    subscriptions, tiers, products, calendar = registry._financial_inputs(spark, folder)
    periods = fin.covered_periods(subscriptions, calendar)
    months = fin.month_ordinal(F.col("last_day")) - fin.month_ordinal(F.col("first_day")) + 1
    total = periods.agg(F.sum(months)).first()[0]
    assert spread.partitions_for(periods, months) == -(-total // 300) > 4
    fact = fin.financials_fact(subscriptions, tiers, products, calendar)
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(account_id#" in plan and f", {-(-total // 300)}), REPARTITION_BY_NUM" in plan
    sizes = [r["count"] for r in fact.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 4 and max(sizes) < 4 * sum(sizes) / len(sizes)
