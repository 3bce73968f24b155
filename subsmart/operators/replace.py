"""Replacement by key value without a partitioned table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from subsmart.operators.spread import settle, sized


def replace_by_key(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """``target`` with the rows whose ``key`` occurs in ``batch`` replaced by ``batch``.

    Target rows with a NULL key always stay. The batch's key values are computed once;
    while they fit a broadcast the target is filtered where it lies, without a shuffle.
    """
    values = sized(settle(batch.select(key).distinct()))
    kept = target.join(values.frame, key, "left_anti")
    return kept.select(*target.columns).unionByName(batch.select(*target.columns))
