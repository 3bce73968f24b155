"""Daily object counts per account."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subsmart.schemas import OBJECT_TOTALS


def object_counts_fact(staged: DataFrame) -> DataFrame:
    """Sum of each count by account and day; repeated snapshots of a day add up."""
    return (
        staged.groupBy("account_id", F.col("date").cast("date").alias("usage_date"))
        .agg(*(F.sum(name).alias(name) for name in OBJECT_TOTALS))
        .select("account_id", "usage_date", *OBJECT_TOTALS)
    )
