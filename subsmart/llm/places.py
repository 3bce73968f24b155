"""Places of rows in one long order, without sorting in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subsmart.llm.tables import stored
from subsmart.operators.spread import settle, sized


def placed(
    df: DataFrame, order: list[Column], group: str | None = None, value: Column | None = None
) -> DataFrame:
    """``df`` with ``pos``, what precedes a row in its group, and ``n``, the group's whole.

    Both count rows, or add up ``value``. ``order`` must begin with ``group`` (no nulls),
    so that a group is a run of the order. Rows are sorted into ranges, which are stored
    and counted; what earlier ranges hold of a group is added to the count within one. A
    group may span any number of ranges, and rows equal in ``order`` stand together, so a
    last key that tells rows apart keeps ranges even. Columns ``pos`` and ``n`` are replaced.
    """
    df = df.drop("pos", "n")
    kept = stored(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    ).withColumn("_range", F.shiftright("_at", 33))
    of = [group] if group else []
    amount = F.count("*") if value is None else F.sum(value)
    # One row per range and group in it: at most the number of ranges plus that of groups.
    runs = kept.groupBy(*of, "_range").agg(
        amount.cast("long").alias("_amount"), F.min("_at").alias("_first")
    )
    whole = Window.partitionBy(*of)
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sized(
        settle(
            runs.select(
                *(F.col(name).alias(f"_{name}") for name in of),
                F.col("_range").alias("_part"),
                "_first",
                F.coalesce(F.sum("_amount").over(before), F.lit(0)).alias("_before"),
                F.sum("_amount").over(whole).alias("n"),
            )
        )
    ).frame
    same = F.col("_range") == F.col("_part")
    if group:
        same = same & (F.col(group) == F.col(f"_{group}"))
    if value is None:
        inside = F.col("_at") - F.col("_first")
    else:
        run = Window.partitionBy(*of, "_range").orderBy("_at")
        earlier = run.rowsBetween(Window.unboundedPreceding, -1)
        kept = kept.withColumn("_inside", F.coalesce(F.sum(value).over(earlier), F.lit(0)))
        inside = F.col("_inside")
    pos = (F.col("_before") + inside).cast("long").alias("pos")
    return kept.join(starts, same).select(*df.columns, pos, "n")
