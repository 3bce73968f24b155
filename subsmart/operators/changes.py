"""Prints of a source's rows by the key a fact is replaced by, to find what changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subsmart.functions.dates import as_date, month_start
from subsmart.operators.financials import calendar_months, covered_periods, subscription_events
from subsmart.operators.spread import Sized, sized
from subsmart.operators.usage import relevant_events, with_product

# A row's two 64-bit hashes are cut into pieces of so many bits, whose sums over any
# number of rows fit a long.
PIECE_BITS = 24
_PIECES = [(seed, shift) for seed in (1, 2) for shift in (0, PIECE_BITS)]


def _row_pieces(columns: list[str]) -> dict[str, Column]:
    """Numbers whose sums over rows tell sets of rows apart, copies included."""
    mask = F.lit((1 << PIECE_BITS) - 1)
    pieces = {"_n": F.lit(1).cast("long")}
    for i, (seed, shift) in enumerate(_PIECES):
        # NULLs leave a hash as it is, so which columns are NULL is hashed too.
        empty = F.concat(*(F.col(c).isNull().cast("int").cast("string") for c in columns))
        pieces[f"_s{i}"] = F.shiftright(F.xxhash64(F.lit(seed), empty, *columns), shift).bitwiseAND(mask)
    return pieces


def _print(pieces: list[str], *more: Column) -> Column:
    return F.concat_ws("-", *(F.col(p).cast("string") for p in pieces), *more).alias("print")


def row_prints(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``key`` and ``print`` of the rows of each key, whatever their order.

    Sums of numbers are added up where the rows lie, so a hot key is one row per task.
    """
    pieces = _row_pieces(columns)
    sums = rows.select(key, *(value.alias(name) for name, value in pieces.items())).groupBy(key).agg(
        *(F.sum(name).alias(name) for name in pieces)
    )
    return sums.select(F.col(key).alias("key"), _print(list(pieces)))


def period_prints(periods: DataFrame, calendar: DataFrame, columns: list[str]) -> DataFrame:
    """``key`` (a month) and ``print`` of the periods that cover a day of each calendar month.

    A period adds its numbers in its first month and takes them off after its last one; the
    running sum over months is the sum over the periods in force. So a period is two rows
    however long it lasts, and only one row per month is left before anything is sorted.
    The days that the calendar has in a month are part of the print.
    """
    pieces = _row_pieces(columns)
    numbered = periods.select("first_day", "last_day", *(value.alias(name) for name, value in pieces.items()))
    begin = [F.col(name) for name in pieces]
    after = F.add_months(month_start(F.col("last_day")), 1)
    events = numbered.select(
        F.inline(
            F.array(
                F.struct(month_start(F.col("first_day")).alias("_month"), *(c.alias(n) for n, c in zip(pieces, begin))),
                F.struct(after.alias("_month"), *((-c).alias(n) for n, c in zip(pieces, begin))),
            )
        )
    )
    steps = events.groupBy("_month").agg(*(F.sum(name).alias(name) for name in pieces))
    months = calendar_months(calendar).frame
    known = months.withColumnRenamed("_month", "key").join(
        steps.withColumnRenamed("_month", "key"), "key", "full_outer"
    )
    # One row per month.
    so_far = Window.orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    running = known.select(
        "key", "_days", *(F.coalesce(F.sum(name).over(so_far), F.lit(0)).alias(name) for name in pieces)
    )
    days = F.col("_days").cast("string")
    return running.filter("_days is not null and _n > 0").select("key", _print(list(pieces), days))


def object_prints(staged: DataFrame) -> DataFrame:
    columns = [c for c in staged.columns if c != "date"]
    return row_prints(staged.withColumn("_day", F.col("date").cast("date")), "_day", columns)


def usage_prints(
    staged: DataFrame,
    products: DataFrame | Sized,
    columns: Sequence[str] = ("account_id", "event_type"),
) -> DataFrame:
    """By day, of the ``columns`` of events that count and the product keys they get."""
    rows = with_product(relevant_events(staged), products)
    return row_prints(rows, "usage_date_day", ["product_id", *columns])


def financial_prints(
    subscriptions: DataFrame, tiers: DataFrame | Sized, products: DataFrame | Sized, calendar: DataFrame
) -> DataFrame:
    """By month, of the subscriptions that cover it and the keys they get."""
    periods = covered_periods(subscriptions, calendar)
    keyed = subscription_events(periods, tiers, products)
    return period_prints(keyed, calendar, [c for c in keyed.columns if c not in ("first_day", "last_day")])


def changed_keys(prints: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of ``prints`` whose key is new or has another print; NULL is a key.

    Keys that are in ``stored`` alone are no change: rows that a source no longer has stay in
    the fact, as they do when a batch lacks them.
    """
    old = stored.select(F.col("key").alias("_key"), F.col("print").alias("_print"))
    same = F.col("key").eqNullSafe(F.col("_key")) & (F.col("print") == F.col("_print"))
    return prints.join(old, same, "left_anti")


def only_keys(rows: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """``rows`` whose ``key`` is one of ``keys`` (``key``); their bounds reach the scan."""
    wanted = sized(keys.select(F.col("key").alias("_wanted"))).frame
    low, high, missing = wanted.agg(
        F.min("_wanted"), F.max("_wanted"), F.count_if(F.col("_wanted").isNull())
    ).first()
    if low is not None and not missing:
        rows = rows.filter((key >= as_date(low)) & (key <= as_date(high)))
    return rows.join(wanted, key.eqNullSafe(F.col("_wanted")), "left_semi")
