from __future__ import annotations

from pyspark.sql import functions as F

from subsmart.operators.dimensions import build_products
from subsmart.operators.staging import stage_usage_events
from subsmart.operators.usage import product_usage_fact
from subsmart.plans import registry
from subsmart.schemas import SOURCES
from subsmart.sources.store import MartStore
from subsmart.streaming.daily_usage import stream_daily_usage, write_available


def test_stream_equals_batch(spark, folder, tmp_path):
    events = registry._events(spark, folder)
    products = build_products(events).cache()
    inbox, marts, state = (str(tmp_path / name) for name in ("inbox", "marts", "state"))
    store = MartStore(spark, marts)
    events.limit(0).write.parquet(inbox)
    stream = stage_usage_events(spark.readStream.schema(SOURCES["usage_events"]).parquet(inbox))
    middle = F.lit("2024-01-15").cast("timestamp_ntz")
    # Two deliveries, then one event far ahead that closes all days before it.
    ahead = events.limit(1).select(
        "account_id", "user_id", "event_id",
        F.lit("2030-01-01").cast("timestamp_ntz").alias("event_time"),
        F.lit("Sales").alias("product"), F.lit("Usage").alias("event_type"),
    )
    early = F.col("event_time") < middle
    for part in [events.filter(early), events.filter(~early), ahead]:
        part.coalesce(1).write.mode("append").parquet(inbox)
        write_available(stream_daily_usage(stream, products), store, state)
    streamed = store.read("fact_product_usage")
    batch = product_usage_fact(events, products)
    assert batch.count() > 0
    assert batch.exceptAll(streamed).isEmpty() and streamed.exceptAll(batch).isEmpty()
