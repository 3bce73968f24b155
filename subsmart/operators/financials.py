"""Monthly revenue, activity and churn from subscription periods.

A subscription contributes to each calendar month it touches. In the month of
its cancellation revenue is cost * days_active / days in month; in every other
month, the first included, it is the full cost. ``days_active`` belongs to the
account and month: it adds up the days of all the account's subscriptions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subsmart.functions.dates import (
    as_date,
    days_in_month,
    days_inclusive,
    month_ordinal,
    month_start,
)
from subsmart.operators import spread
from subsmart.operators.spread import (
    Sized,
    group_total,
    partitions_for,
    settle,
    sized,
    split_hot,
)

PERIOD = ["account_id", "product", "tier", "monthly_cost", "start_date", "cancel_date"]
GRAINS = ("account", "subscription")
# Digits after the point that count in prices that are not decimals.
OTHER_SCALE = 6


def subscription_events(
    subscriptions: DataFrame, tiers: DataFrame | Sized, products: DataFrame | Sized
) -> DataFrame:
    """Subscriptions with their tier and product keys; NULL where a dimension has none."""
    return (
        subscriptions.join(
            sized(tiers).frame,
            (F.col("tier") == F.col("tier_name")) & (F.col("monthly_cost") == F.col("tier_price")),
            "left",
        )
        .drop("tier_name", "tier_price")
        .join(sized(products).frame, F.col("product") == F.col("product_name"), "left")
        .drop("product_name")
    )


def covered_periods(
    subscriptions: DataFrame,
    calendar: DataFrame,
    open_until: dt.date | str | Column | None = None,
) -> DataFrame:
    """Subscriptions with the calendar days they cover as ``first_day``..``last_day``.

    A subscription without cancel date covers nothing, unless ``open_until`` says how
    far active ones run; ``cancel_date`` itself stays NULL for the churn test.
    """
    until = F.col("cancel_date")
    if open_until is not None:
        until = F.coalesce(until, as_date(open_until))
    calendar_first = calendar.agg(F.min("full_date")).scalar()
    calendar_last = calendar.agg(F.max("full_date")).scalar()
    return (
        subscriptions.select(
            *PERIOD,
            F.greatest("start_date", calendar_first).alias("first_day"),
            F.least(until, calendar_last).alias("last_day"),
            until.alias("_until"),
        )
        .filter(calendar_first.isNotNull() & (F.col("start_date") <= F.col("_until")))
        .filter(F.col("first_day") <= F.col("last_day"))
        .drop("_until")
    )


def distinct_periods(
    subscriptions: DataFrame,
    calendar: DataFrame,
    open_until: dt.date | str | Column | None = None,
) -> DataFrame:
    """Distinct covered periods; copies collapse before anything is shuffled."""
    return covered_periods(subscriptions, calendar, open_until).distinct()


def subscription_days(periods: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """One row per distinct subscription and day it covers; days that ``calendar`` lacks drop out."""
    days = periods.withColumn(
        "full_date", F.explode(F.sequence("first_day", "last_day"))
    ).withColumn("financial_month", month_start(F.col("full_date")))
    if calendar is None:
        return days
    present = sized(calendar.select(F.col("full_date").alias("_present"))).frame
    return days.join(present, F.col("full_date") == F.col("_present"), "left_semi")


def calendar_months(calendar: DataFrame) -> Sized:
    """One row per month of the calendar, with a bit for each of its days that is there."""
    bit = F.expr("shiftleft(1L, dayofmonth(full_date) - 1)")
    months = calendar.groupBy(month_start(F.col("full_date")).alias("_month"))
    return sized(settle(months.agg(F.bit_or(bit).alias("_days"))))


def subscription_months(
    periods: DataFrame, calendar: Sized | None = None, extra: str | None = None
) -> DataFrame:
    """One row per distinct subscription and month, with the days covered in that month.

    Replaces the join of periods with calendar days: about thirty times fewer rows
    and no range join. With the ``calendar_months``, only days of the calendar count
    and a month without any is left out; without, every day between the bounds counts.
    ``extra`` names an array column with a value for each of a period's months.
    """
    if calendar is not None:
        bounds = {"_first": F.col("first_day"), "_last": F.col("last_day")}
        whole = _with_days(subscription_months(periods.withColumns(bounds), extra=extra), calendar)
        return whole.drop("_first", "_last")
    first, last = F.col("first_day"), F.col("last_day")
    spread_out = periods.withColumn("_first_month", month_start(first)).withColumn(
        "_cancel_month", month_start(F.col("cancel_date"))
    )
    if extra:
        kept = [c for c in spread_out.columns if c != extra]
        spread_out = spread_out.select(*kept, F.posexplode_outer(extra).alias("_offset", extra))
    else:
        offsets = F.sequence(F.lit(0), month_ordinal(last) - month_ordinal(first))
        spread_out = spread_out.withColumn("_offset", F.explode(offsets))
    month = F.col("financial_month")
    return (
        spread_out
        .withColumn("financial_month", F.add_months("_first_month", F.col("_offset")))
        .withColumn(
            "days_covered",
            days_inclusive(F.greatest(first, month), F.least(last, F.last_day(month))),
        )
        .withColumn("total_days", days_in_month(month))
        .withColumn("cancels_here", F.coalesce(F.col("_cancel_month") == month, F.lit(False)))
        .drop("_offset", "_first_month", "_cancel_month", "first_day", "last_day")
    )


def _with_days(months: DataFrame, calendar: Sized) -> DataFrame:
    """``months`` with the days that the calendar has between ``_first`` and ``_last``."""
    low = F.dayofmonth(F.greatest("_first", "financial_month"))
    high = F.dayofmonth(F.least("_last", F.last_day("financial_month")))
    months = months.withColumns({"_low": low, "_high": high})
    between = F.expr("shiftleft(1L, _high) - shiftleft(1L, _low - 1)")
    covered = F.bit_count(F.col("_days").bitwiseAND(between)).cast(months.schema["days_covered"].dataType)
    return (
        months.join(calendar.frame, F.col("financial_month") == F.col("_month"))
        .withColumn("days_covered", covered)
        .filter("days_covered > 0")
        .drop("_low", "_high", "_month", "_days")
    )


def with_days_active(months: DataFrame, days_grain: str = "account") -> DataFrame:
    """Adds ``days_active``: days of all the account's subscriptions in the month."""
    _check_grain(days_grain)
    days = F.col("days_covered")
    if days_grain == "subscription":
        return months.withColumn("days_active", days.cast("long"))
    return group_total(months, ["account_id", "financial_month"], days, "days_active", PERIOD)


def account_days(periods: DataFrame, calendar: Sized | None = None) -> DataFrame:
    """Days of all of an account's distinct ``periods`` by month, one row per account.

    ``first_month`` is the ordinal of the account's first month, and ``days`` has a number
    for it and for every month up to its last one, at most the months of the calendar.

    No period is spread over its months. It adds its days in its first and last month, and
    1 to the number of periods that run through whole months after the first until before
    the last; these boundary events are added up where they lie, and a running sum per
    account, over at most two rows per calendar month, gives each month's whole days.
    """
    first, last = month_start(F.col("first_day")), month_start(F.col("last_day"))
    event = lambda month, day, until, step: F.struct(
        month.alias("month"), day.alias("day"), until.alias("until"), F.lit(step).alias("step")
    )
    none = F.lit(None).cast("date")
    within = F.array(event(first, F.col("first_day"), F.col("last_day"), 0))
    across = F.array(
        event(first, F.col("first_day"), F.last_day("first_day"), 0),
        event(F.add_months(first, 1), none, none, 1),
        event(last, last, F.col("last_day"), -1),
    )
    events = periods.select("account_id", F.inline(F.when(first == last, within).otherwise(across)))
    days = F.when(F.col("day").isNull(), 0).otherwise(days_inclusive(F.col("day"), F.col("until")))
    if calendar is not None:
        events = events.join(calendar.frame, F.col("month") == F.col("_month"), "left").withColumns(
            {"_low": F.dayofmonth("day"), "_high": F.dayofmonth("until")}
        )
        between = F.expr("shiftleft(1L, _high) - shiftleft(1L, _low - 1)")
        days = F.coalesce(F.bit_count(F.col("_days").bitwiseAND(between)), F.lit(0))
    steps = events.groupBy("account_id", "month").agg(
        F.sum(days).alias("part"), F.sum("step").alias("step")
    )
    along = Window.partitionBy("account_id").orderBy("month")
    rates = steps.select(
        "account_id",
        "month",
        "part",
        F.sum("step").over(along).alias("rate"),
        F.coalesce(F.lead("month").over(along), F.add_months("month", 1)).alias("next"),
    )
    filled = rates.select(
        "account_id",
        "month",
        "part",
        "rate",
        F.explode(F.sequence(F.lit(0), month_ordinal(F.col("next")) - month_ordinal(F.col("month")) - 1)).alias("_gap"),
    ).withColumn("_at", F.add_months("month", F.col("_gap")))
    whole = days_in_month(F.col("_at")).cast("long")
    if calendar is not None:
        filled = filled.join(calendar.frame, F.col("_at") == F.col("_month"), "left")
        whole = F.coalesce(F.bit_count("_days"), F.lit(0)).cast("long")
    total = F.when(F.col("_gap") == 0, F.col("part")).otherwise(0) + F.col("rate") * whole
    listed = F.sort_array(F.collect_list(F.struct("_at", total.alias("days"))))
    return filled.groupBy("account_id").agg(listed.alias("_listed")).select(
        "account_id",
        month_ordinal(F.col("_listed")[0]["_at"]).alias("first_month"),
        F.col("_listed.days").alias("days"),
    )


def months_with_days_active(
    periods: DataFrame, calendar: Sized | None = None, days_grain: str = "account"
) -> DataFrame:
    """``subscription_months`` of distinct ``periods`` with ``days_active``.

    The account's days by month are looked up before a period is spread over its months, so
    what is shuffled are periods and one row per account, and the month rows stay where they
    are made. A hot account's periods are split by adaptive execution, as its other side is
    one row.
    """
    _check_grain(days_grain)
    if days_grain == "subscription":
        return with_days_active(subscription_months(periods, calendar), days_grain)
    known = account_days(periods, calendar).select(
        F.col("account_id").alias("_account"), "first_month", "days"
    )
    first, last = month_ordinal(F.col("first_day")), month_ordinal(F.col("last_day"))
    own = F.slice("days", first - F.col("first_month") + 1, last - first + 1)
    looked_up = periods.join(known, F.col("account_id").eqNullSafe(F.col("_account"))).withColumn("_own", own)
    months = subscription_months(looked_up.drop("_account", "first_month", "days"), calendar, extra="_own")
    return months.withColumnRenamed("_own", "days_active")


def prorated(months: DataFrame) -> DataFrame:
    """Adds ``adjusted_revenue`` to rows that have ``days_active``."""
    cost = F.col("monthly_cost").cast("double")
    share = F.col("days_active").cast("double") / F.col("total_days")
    return months.withColumn(
        "adjusted_revenue", F.when(F.col("cancels_here"), cost * share).otherwise(cost)
    )


def monthly_churn(months: DataFrame) -> DataFrame:
    """Active and churned accounts by account and month."""
    present = F.when(F.col("account_id").isNotNull(), 1).otherwise(0)
    churned = F.when(F.col("cancels_here"), present).otherwise(0)
    return months.groupBy("account_id", "financial_month").agg(
        F.max(present).cast("long").alias("active_subscriptions"),
        F.max(churned).cast("long").alias("churned_subscriptions"),
    )


def financials_fact(
    subscriptions: DataFrame,
    tiers: DataFrame | Sized,
    products: DataFrame | Sized,
    calendar: DataFrame,
    open_until: dt.date | str | Column | None = None,
    days_grain: str = "account",
) -> DataFrame:
    """Revenue, active and churned subscriptions by account, product, tier and month.

    Nearly all accounts are small, so their periods are shuffled by account once, as
    they come from the scan. Removing copies, exploding months, adding up and the
    window over an account's month then all happen where the rows lie, and the month
    rows, the bulk of the data, never move.

    Accounts of more than ``GROUP_ROWS`` month rows would fill a task. They are
    split off and take the way through partial aggregation, in which such an account
    shrinks to its product-tier-month groups before each shuffle.
    """
    _check_grain(days_grain)
    tiers, products = _without_copies(tiers), _without_copies(products)
    periods = covered_periods(subscriptions, calendar, open_until)
    months = month_ordinal(F.col("last_day")) - month_ordinal(F.col("first_day")) + 1
    small, large = split_hot(periods, "account_id", months)
    # A fixed number, as partitions must not be merged: what they hold grows after this shuffle.
    by_account = small.repartition(partitions_for(periods, months), "account_id")
    present = calendar_months(calendar)
    fact = _monthly_revenue(
        by_account.distinct(), tiers, products, present, days_grain, spread.GROUP_ROWS
    )
    if large is None:
        return fact
    bound = _combinations(tiers, products)
    return fact.unionByName(
        _monthly_revenue(large.distinct(), tiers, products, present, days_grain, bound)
    )


def _monthly_revenue(
    periods: DataFrame,
    tiers: Sized,
    products: Sized,
    calendar: Sized,
    days_grain: str,
    rows_bound: int | None,
) -> DataFrame:
    """The fact of distinct ``periods``, at most ``rows_bound`` groups per account and month.

    ``days_active`` is the same for all rows of an account and month, so costs are
    summed per group first, prorated and full ones apart, and the ratio is applied to
    the sums.
    """
    # Whole units of the price's scale: exact in any order, and cheaper to add up than decimals.
    kind, exact = periods.schema["monthly_cost"].dataType, F.col("monthly_cost")
    if not isinstance(kind, T.DecimalType):
        kind = T.DecimalType(18, OTHER_SCALE)
        exact = exact.cast(kind)
    units = 10**kind.scale
    priced = subscription_events(periods, tiers, products).withColumn(
        "cents", (exact * units).cast("long")
    )
    months = subscription_months(priced, calendar)
    cents, here = F.col("cents"), F.col("cancels_here")
    # A cancelled row weighs its own days, or 1 while the account's days are yet to come.
    part_cents = cents * F.col("days_covered") if days_grain == "subscription" else cents
    groups = months.groupBy("account_id", "financial_month", "product_id", "tier_id").agg(
        F.sum(F.when(~here, cents)).alias("full_cents"),
        F.sum(F.when(here, part_cents)).alias("cancelled_cents"),
        F.sum("days_covered").alias("days_covered"),
        F.max(here).alias("churns"),
    )
    if days_grain == "account":
        groups = group_total(
            groups,
            ["account_id", "financial_month"],
            F.col("days_covered"),
            "days_active",
            ["product_id", "tier_id"],
            rows_bound,
        )
        weight = F.col("days_active").cast("double")
    else:
        weight = F.lit(1.0)
    full = F.col("full_cents") / units
    share = weight / days_in_month(F.col("financial_month"))
    part = F.col("cancelled_cents") / units * share
    zero, present = F.lit(0.0), F.when(F.col("account_id").isNotNull(), 1).otherwise(0)
    return groups.select(
        "account_id",
        "product_id",
        "tier_id",
        "financial_month",
        F.when(full.isNotNull() | part.isNotNull(), F.coalesce(full, zero) + F.coalesce(part, zero))
        .alias("total_revenue"),
        present.cast("long").alias("active_subscriptions"),
        F.when(F.col("churns"), present).otherwise(0).cast("long").alias("churned_subscriptions"),
    )


def _without_copies(dimension: DataFrame | Sized) -> Sized:
    """Repeated dimension rows must not multiply subscriptions; measured ones are trusted."""
    return dimension if isinstance(dimension, Sized) else sized(dimension.distinct())


def _combinations(tiers: Sized, products: Sized) -> int | None:
    """Most product-tier groups an account can have in a month, NULL keys included."""
    if tiers.rows is None or products.rows is None:
        return None
    return (tiers.rows + 1) * (products.rows + 1)


def _check_grain(days_grain: str) -> None:
    if days_grain not in GRAINS:
        raise ValueError(f"days_grain must be one of {GRAINS}, not {days_grain!r}")
