"""The daily usage fact kept up to date from a stream of events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subsmart.functions.dates import as_date
from subsmart.operators.spread import Sized, sized
from subsmart.operators.usage import ACTIVATION, USAGE, relevant_events
from subsmart.sources.store import MartStore

FACT = "fact_product_usage"


def stream_daily_usage(
    events: DataFrame, products: DataFrame | Sized, lateness: str = "1 day"
) -> DataFrame:
    """Counts by account, product and day from staged streaming events.

    A day is emitted once, when events are ``lateness`` past its end; the state holds
    only open days. Events that come later than that are not in the stream's result. A
    batch run over the stored events finds such days by their prints, which the stream does
    not write, and rebuilds them. Needs the session time zone UTC, in which days are cut.
    """
    timed = events.withColumn("event_time", F.col("event_time").cast("timestamp"))
    day = F.window("event_time", "1 day").alias("day")
    present = F.when(F.col("account_id").isNotNull(), 1).otherwise(0)
    counts = (
        relevant_events(timed.withWatermark("event_time", lateness))
        .filter(F.col("product_name").isNotNull())
        .groupBy(day, "account_id", "product_name")
        .agg(
            F.count_if(F.col("event_type") == USAGE).alias("total_usage_events"),
            F.count_if(F.col("event_type") == ACTIVATION).alias("total_activations"),
            F.max(present).cast("long").alias("active_users"),
        )
    )
    return counts.join(sized(products).frame, "product_name").select(
        "account_id",
        "product_id",
        as_date(F.col("day.start")).alias("usage_date_day"),
        "total_usage_events",
        "total_activations",
        "active_users",
    )


def write_available(counts: DataFrame, store: MartStore, checkpoint: str) -> None:
    """Write the finished days of all input available now to the usage fact of ``store``.

    All rows of a day come in one micro-batch, which replaces the day's partition, so a
    repeated micro-batch changes nothing and batch runs may write the same table.
    """
    query = (
        counts.writeStream.outputMode("append")
        .foreachBatch(lambda days, _: store.replace_partitions(FACT, days))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
