"""Mart tables as parquet folders under one root: full, append and replace-by-key writes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subsmart.schemas import MARTS, REPLACE_KEYS
from subsmart.sources.files import children, exists


class MartStore:
    """Reads and writes marts below ``root``, a folder that every executor can reach.

    Facts are partitioned by the column whose values a batch replaces, so an
    incremental write touches only the partitions in the batch and never scans
    the rest of the table. Repeating a write leaves the same table.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def exists(self, name: str) -> bool:
        """Whether a write of the mart ever finished; a full write that died does not count."""
        return exists(self.spark, self.path(name, "_SUCCESS"))

    def read(self, name: str) -> DataFrame:
        """The mart, or an empty one with its schema where none was written yet."""
        schema = MARTS[name]
        if not self.exists(name):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path(name)).select(*schema.names)

    def replace(self, name: str, df: DataFrame) -> None:
        """Write the whole table."""
        self._write(name, df, "static")

    def replace_partitions(self, name: str, df: DataFrame) -> None:
        """Replace the rows whose key value occurs in ``df``; all others stay.

        Rows without key are a partition of their own, replaced when ``df`` has such rows.
        """
        if name not in REPLACE_KEYS:
            raise ValueError(f"{name} has no replace key")
        self._write(name, df, "dynamic" if self.exists(name) else "static")

    def append(self, name: str, df: DataFrame) -> None:
        """Add rows whose keys are known to be new."""
        df.select(*MARTS[name].names).write.mode("append").parquet(self.path(name))

    def _write(self, name: str, df: DataFrame, overwrite: str) -> None:
        df = df.select(*MARTS[name].names)
        key = REPLACE_KEYS.get(name)
        if key is None:
            df.write.mode("overwrite").parquet(self.path(name))
            return
        # Rebalancing gathers small partitions into one file and splits a hot one
        # over several tasks, where repartitioning by key would use a single task.
        writer = df.hint("rebalance", key).write.mode("overwrite").partitionBy(key)
        writer.option("partitionOverwriteMode", overwrite).parquet(self.path(name))


class HistoryStore:
    """The account history, one folder per batch: ``as_of=<day id>/is_current=<flag>``.

    A batch folder holds the versions the batch closed and all versions open after
    it, written by one job. The history is the closed part of every finished batch
    plus the open part of the last one, which partition pruning picks. Closed
    versions are thus written once and never rewritten. A batch that dies
    half-way is not finished and stays invisible; running a batch again overwrites
    its own folder only.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def batches(self) -> list[int]:
        """Day ids of the finished batches, oldest first."""
        if not exists(self.spark, self.root):
            return []
        names = [n for n in children(self.spark, self.root) if n.startswith("as_of=")]
        done = [n for n in names if exists(self.spark, f"{self.root}/{n}/_SUCCESS")]
        return sorted(int(name.split("=")[1]) for name in done)

    def current(self, before: int | None = None) -> DataFrame:
        """The open versions after the last batch, or the last one before day id ``before``."""
        done = [b for b in self.batches() if before is None or b < before]
        return self._read(done[-1:], F.col("is_current"))

    def read(self, upto: int | None = None) -> DataFrame:
        """The whole history as of the last batch, or as of day id ``upto``."""
        done = [b for b in self.batches() if upto is None or b <= upto]
        return self._read(done, ~F.col("is_current") | (F.col("as_of") == (done or [0])[-1]))

    def write(self, versions: DataFrame, as_of: dt.date) -> None:
        """Store what the batch of day ``as_of`` made of the current versions."""
        day = as_of.year * 10000 + as_of.month * 100 + as_of.day
        later = [b for b in self.batches() if b > day]
        if later:
            raise ValueError(f"batch {day} is older than the stored batch {later[-1]}")
        versions.select(*MARTS["dim_accounts"].names).write.mode("overwrite").partitionBy(
            "is_current"
        ).parquet(f"{self.root}/as_of={day}")

    def _read(self, batches: list[int], part: Column) -> DataFrame:
        schema = MARTS["dim_accounts"]
        if not batches:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType([*schema.fields, T.StructField("as_of", T.IntegerType())])
        reader = self.spark.read.schema(stored).option("basePath", self.root)
        rows = reader.parquet(*(f"{self.root}/as_of={batch}" for batch in batches))
        return rows.filter(part).select(*schema.names)
