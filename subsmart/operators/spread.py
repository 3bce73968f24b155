"""Building blocks that keep hot keys and large sides off single tasks."""

from __future__ import annotations

import functools
import operator
import tempfile
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
GROUP_ROWS = 1_000_000
TASK_ROWS = 4 * GROUP_ROWS


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and intermediate tables."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="subsmart-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def settle(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, so losing executors costs nothing.

    Meant for dimensions that several joins read; facts go to tables instead.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()


@dataclass(frozen=True)
class Sized:
    """A relation with its row count, or ``rows=None`` beyond the broadcast bound."""

    frame: DataFrame
    rows: int | None


def sized(
    df: DataFrame | Sized, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> Sized:
    """Measure ``df`` and mark it for broadcast only if it is within both bounds.

    Rows and bytes are added up where they lie. A larger side stays unmarked: its join
    then shuffles both sides and adaptive execution splits skewed partitions. What was
    measured before is not measured again.
    """
    if isinstance(df, Sized):
        return df
    width = functools.reduce(
        operator.add,
        [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns],
    )
    rows, size = df.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    if rows > max_rows or size > max_bytes:
        return Sized(df, None)
    return Sized(F.broadcast(df), rows)


def split_hot(
    df: DataFrame, key: str, becomes: Column | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """``df`` without and with the rows whose ``key`` occurs more than ``GROUP_ROWS`` times.

    ``becomes`` counts the rows that a row will grow to, one without. The second frame is
    None if there are none. Keys are counted with partial
    aggregation over the key column alone, and NULL counts as a key.
    """
    hot = sized(
        settle(
            df.groupBy(F.col(key).alias("_hot"))
            .agg(F.sum(F.lit(1) if becomes is None else becomes).alias("_rows"))
            .filter(F.col("_rows") > GROUP_ROWS)
            .select("_hot")
        )
    )
    if hot.rows == 0:
        return df, None
    match = F.col(key).eqNullSafe(F.col("_hot"))
    return df.join(hot.frame, match, "left_anti"), df.join(hot.frame, match, "left_semi")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def partitions_for(df: DataFrame, becomes: Column) -> int:
    """Partitions of about ``TASK_ROWS`` rows each for what ``df`` will grow to.

    ``becomes`` counts the rows that a row will grow to; they are added up where they lie.
    Keys of more than ``GROUP_ROWS`` rows, a quarter of a task's, are expected to be split
    off, so tasks come out even. The session's number is never lowered.
    """
    grown = df.agg(F.coalesce(F.sum(becomes), F.lit(0)).cast("long")).first()[0]
    return max(shuffle_partitions(df.sparkSession), -(-grown // TASK_ROWS))


def group_total(
    df: DataFrame,
    keys: list[str],
    value: Column,
    out: str,
    spread_by: list[str],
    rows_bound: int | None = None,
) -> DataFrame:
    """``df`` with ``out`` = the sum of ``value`` over the rows sharing ``keys``.

    With a proven ``rows_bound`` per group this is a window. Otherwise the groups of
    more than ``GROUP_ROWS`` rows are looked up first: their sums come from a partial
    aggregation, there are at most rows / ``GROUP_ROWS`` of them, and their rows are then
    cut by a hash of ``spread_by`` into windows of about ``GROUP_ROWS`` rows whose own
    sums are not used.
    """
    if rows_bound is not None and rows_bound <= GROUP_ROWS:
        return df.withColumn(out, F.sum(value).over(Window.partitionBy(*keys)))
    # Fields of a struct compare NULL-safely, so plain equality also joins NULL keys.
    group = F.struct(*keys)
    large = (
        df.groupBy(*keys)
        .agg(F.sum(value).alias("_total"), F.count("*").alias("_rows"))
        .filter(F.col("_rows") > GROUP_ROWS)
        .select(group.alias("_group"), "_total", F.ceil(F.col("_rows") / GROUP_ROWS).alias("_cuts"))
    )
    looked_up = df.join(sized(settle(large)).frame, group == F.col("_group"), "left")
    piece = F.when(F.col("_cuts") > 1, F.pmod(F.xxhash64(*spread_by), F.col("_cuts")))
    window = Window.partitionBy(*keys, F.coalesce(piece, F.lit(0)))
    total = F.coalesce(F.col("_total"), F.sum(value).over(window))
    return looked_up.withColumn(out, total).select(*df.columns, out)
