"""The account dimension with full version history.

A version is valid from ``start_date_id`` up to ``end_date_id`` (NULL while it is
current). The first version of an account starts at its signup; a later one starts
on the day of the batch that brought the change. Country, vertical and nps are
tracked; a change of the name alone opens no version.
"""

from __future__ import annotations

import datetime as dt
import functools
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subsmart.functions.dates import as_date, date_id
from subsmart.operators.spread import Sized, sized
from subsmart.schemas import MARTS

ATTRIBUTES = ["name", "country", "vertical", "nps"]
TRACKED = ["country", "vertical", "nps"]
COLUMNS = MARTS["dim_accounts"].names


def latest_accounts(staged: DataFrame) -> DataFrame:
    """First signup by account and attribute values."""
    return staged.groupBy("account_id", *ATTRIBUTES).agg(
        F.min("signup_date").alias("first_signup_date")
    )


def one_per_account(staged: DataFrame) -> DataFrame:
    """One row per account: the first signup, and the attributes of the last one.

    Ties are broken by the attribute values, so the choice is repeatable.
    """
    row = F.struct("signup_date", *ATTRIBUTES)
    return (
        staged.filter(F.col("account_id").isNotNull())
        .groupBy("account_id")
        .agg(F.min("signup_date").alias("first_signup_date"), F.max(row).alias("_row"))
        .select("account_id", "first_signup_date", *(f"_row.{name}" for name in ATTRIBUTES))
    )


def signup_days(calendar: DataFrame) -> Sized:
    """Calendar days as a signup joins them; measure once, use for any number of batches."""
    return sized(
        calendar.select(
            F.col("date_id").alias("signup_date_id"), F.col("full_date").alias("first_signup_date")
        )
    )


def with_signup_date_id(accounts: DataFrame, calendar: DataFrame | Sized) -> DataFrame:
    """Accounts whose first signup is a calendar day, with that day's id."""
    days = calendar if isinstance(calendar, Sized) else signup_days(calendar)
    return accounts.join(days.frame, "first_signup_date").select(
        "account_id", "name", "signup_date_id", "country", "vertical", "nps"
    )


def account_batch(staged: DataFrame, calendar: DataFrame | Sized) -> DataFrame:
    """The account rows of one batch, ready to be applied to a history."""
    return with_signup_date_id(one_per_account(staged), calendar)


def _same(left: str, right: str) -> Column:
    """Whether two versions agree in every tracked attribute; NULL equals NULL."""
    pairs = (F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in TRACKED)
    return functools.reduce(operator.and_, pairs)


def changed_rows(batch: DataFrame, history: DataFrame) -> DataFrame:
    """Batch rows that differ from the current version, new accounts included.

    An anti join that hashes the account alone: both sides have one row per account, so
    the batch keeps the partitioning it was deduplicated in.
    """
    current = history.filter("is_current").select(
        F.col("account_id").alias("_key"), F.struct(*TRACKED).alias("old")
    )
    known = batch.withColumn("new", F.struct(*TRACKED)).join(
        current, F.col("account_id") == F.col("_key"), "left"
    )
    return known.filter(F.col("_key").isNull() | ~_same("old", "new")).select(*batch.columns)


def first_versions(batch: DataFrame) -> DataFrame:
    """The history after a first load: one open version per account."""
    return batch.select(
        *batch.columns,
        F.col("signup_date_id").alias("start_date_id"),
        F.lit(None).cast("int").alias("end_date_id"),
        F.lit(True).alias("is_current"),
    ).select(*COLUMNS)


def advance_current(
    current: DataFrame, batch: DataFrame, as_of: dt.date | str | Column
) -> DataFrame:
    """What the batch makes of the current versions: kept, closed and newly opened ones.

    Both sides have one row per account, so the join key is unique and cannot be
    hot. Closed history takes no part. Where the current version already started on
    or after ``as_of``, the change replaces it, which keeps one version per account and
    start day.
    """
    old = current.select(
        F.col("account_id").alias("_key"), F.struct(*COLUMNS).alias("old")
    )
    new = batch.select("account_id", F.struct(*batch.columns).alias("new"))
    pair = old.join(new, F.col("_key") == F.col("account_id"), "full_outer")
    kept = F.when(F.col("_key").isNotNull() & ~_differs(), F.col("old"))
    return pair.select(F.inline(_present(kept, *_closed_and_opened(as_of)))).select(*COLUMNS)


def batch_changes(
    current: DataFrame, batch: DataFrame, as_of: dt.date | str | Column
) -> DataFrame:
    """Only the versions that the batch closes and opens; none where nothing changed.

    ``current`` needs the open versions of the batch's accounts; others are not looked at.
    """
    old = current.select(
        F.col("account_id").alias("_key"), F.struct(*COLUMNS).alias("old")
    )
    new = batch.select("account_id", F.struct(*batch.columns).alias("new"))
    pair = new.join(old, F.col("_key") == F.col("account_id"), "left")
    changed = pair.filter(F.col("_key").isNull() | _differs())
    return changed.select(F.inline(_present(*_closed_and_opened(as_of)))).select(*COLUMNS)


def _differs() -> Column:
    return F.col("new").isNotNull() & F.col("old").isNotNull() & ~_same("old", "new")


def _closed_and_opened(as_of: dt.date | str | Column) -> tuple[Column, Column]:
    """What becomes of a pair of ``old`` (with ``_key``) and ``new``; NULL where nothing does."""
    today, is_new = date_id(as_date(as_of)), F.col("_key").isNull()
    replaces = F.col("old.start_date_id") >= today
    closed = F.when(_differs() & ~replaces, _version("old", end=today))
    opened = F.when(
        is_new, _version("new", start=F.col("new.signup_date_id"))
    ).when(_differs(), _version("new", start=F.greatest(today, F.col("old.start_date_id"))))
    return closed, opened


def _present(*versions: Column) -> Column:
    return F.filter(F.array(*versions), lambda version: version.isNotNull())


def _version(side: str, start: Column | None = None, end: Column | None = None) -> Column:
    values = {
        "start_date_id": F.col(f"{side}.start_date_id") if start is None else start,
        "end_date_id": F.lit(None) if end is None else end,
        "is_current": F.lit(end is None),
    }
    kinds = {field.name: field.dataType for field in MARTS["dim_accounts"]}
    return F.struct(
        *(
            values.get(name, F.col(f"{side}.{name}") if name not in values else None)
            .cast(kinds[name])
            .alias(name)
            for name in COLUMNS
        )
    )


def apply_batch(history: DataFrame, batch: DataFrame, as_of: dt.date | str | Column) -> DataFrame:
    """The whole history after the batch. Closed versions pass through unshuffled.

    For one batch; a history store keeps a sequence of them from piling up one plan.
    """
    closed = history.filter(~F.col("is_current")).select(*COLUMNS)
    return closed.unionByName(advance_current(history.filter("is_current"), batch, as_of))


def version_chain(versions: DataFrame) -> DataFrame:
    """Ends and current flags recomputed from start days alone.

    A group holds the versions of one account, at most one per calendar day, which
    bounds it by the length of the calendar.
    """
    following = F.lead("start_date_id").over(
        Window.partitionBy("account_id").orderBy("start_date_id")
    )
    return versions.withColumn("end_date_id", following).withColumn(
        "is_current", F.col("end_date_id").isNull()
    ).select(*COLUMNS)
