"""One query per operator over the sample sources, ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

import dataclasses
import datetime as dt
import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subsmart.functions import keys
from subsmart.operators import financials as fin
from subsmart.operators import history as hist
from subsmart.operators import quality, staging, usage, user_sets
from subsmart.operators.calendar import build_calendar, calendar_days, extend_calendar
from subsmart.operators.dimensions import build_products, build_tiers
from subsmart.operators.objects import object_counts_fact
from subsmart.operators.replace import replace_by_key
from subsmart.operators.spread import settle, shared_folder, sized
from subsmart.plans.build import Warehouse, stage_all
from subsmart.plans.checks import CHECKS
from subsmart.session import fit_shuffles
from subsmart.sources import rejects, samples
from subsmart.sources.generations import GenerationStore
from subsmart.sources.history_log import HistoryLog

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FIRST_LOAD = dt.date(2001, 12, 31)
BATCH_DAYS = [dt.date(2002, 1, 1), dt.date(2003, 1, 1), dt.date(2004, 1, 1)]


def query(build: Query) -> Query:
    """Register ``build``; running it first fits the shuffles to the input folder."""

    @functools.wraps(build)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        fit_shuffles(spark, folder)
        return build(spark, folder)

    QUERIES[build.__name__] = run
    return run


def scratch_folder(spark: SparkSession) -> str:
    """A new folder in the cluster's shared folder."""
    return f"{shared_folder(spark)}/subsmart-{uuid.uuid4().hex}"


# ---- inputs ---------------------------------------------------------------


def _accounts(spark, folder):
    return staging.stage_accounts(samples.sample_accounts(spark, folder))


def _subscriptions(spark, folder):
    return staging.stage_subscriptions(samples.sample_subscriptions(spark, folder))


def _events(spark, folder):
    return staging.stage_usage_events(samples.sample_usage_events(spark, folder))


def _objects(spark, folder):
    return staging.stage_object_counts(samples.sample_object_counts(spark, folder))


def _first_year(spark, folder):
    """January 1 of the first order's year, as a scalar subquery."""
    first = F.trunc(F.min(F.to_date("o_orderdate")), "year")
    return samples.table(spark, folder, "orders").agg(first).scalar()


def _last_order_day(spark, folder):
    return samples.table(spark, folder, "orders").agg(F.max(F.to_date("o_orderdate"))).scalar()


def _last_event_day(spark, folder):
    return samples.table(spark, folder, "events").agg(F.max(F.to_date("ts"))).scalar()


def _calendar(spark, folder):
    return build_calendar(spark, _last_event_day(spark, folder), _first_year(spark, folder))


def _tiers(subscriptions):
    return sized(settle(build_tiers(subscriptions)))


def _products(events):
    return sized(settle(build_products(events)))


def changed_accounts(accounts: DataFrame, batch: int) -> DataFrame:
    """The staged accounts as later batches deliver them; batch 0 is the first load."""
    account = F.col("account_id")
    if batch >= 1:
        moved = F.when(account % 10 == 0, "SOFTWARE").otherwise(F.col("vertical"))
        accounts = accounts.withColumn("vertical", moved)
    if batch >= 2:
        accounts = accounts.withColumn("nps", F.when(account % 15 != 0, F.col("nps")))
    return accounts


def _batches(spark, folder, count):
    """The first ``count`` account batches over one calendar."""
    days = hist.signup_days(settle(_calendar(spark, folder)))
    accounts = _accounts(spark, folder)
    return [hist.account_batch(changed_accounts(accounts, i), days) for i in range(count)]


# ---- staging and keys -----------------------------------------------------


@query
def stg_accounts(spark, folder):
    return _accounts(spark, folder)


@query
def stg_subscriptions(spark, folder):
    return _subscriptions(spark, folder)


@query
def stg_usage_events(spark, folder):
    return _events(spark, folder)


@query
def stg_object_counts_daily(spark, folder):
    return _objects(spark, folder)


@query
def surrogate_key(spark, folder):
    return _subscriptions(spark, folder).select(
        "account_id",
        "start_date",
        keys.surrogate_key("product").alias("product_key"),
        keys.surrogate_key("tier", "monthly_cost").alias("offer_key"),
    )


# ---- calendar and dimensions ----------------------------------------------


@query
def calendar_rows(spark, folder):
    """One row per day from the first to the last shipment."""
    shipped = F.to_date("l_shipdate")
    bounds = samples.table(spark, folder, "lineitem").agg(
        F.min(shipped).alias("first_day"), F.max(shipped).alias("last_day")
    )
    return calendar_days(bounds)


@query
def dim_dates(spark, folder):
    return _calendar(spark, folder)


@query
def calendar_extend(spark, folder):
    """A calendar built as of the last order, extended as of the last event."""
    store = GenerationStore(spark, scratch_folder(spark))
    start = _first_year(spark, folder)
    store.replace("dim_dates", build_calendar(spark, _last_order_day(spark, folder), start))
    existing = store.read("dim_dates")
    days = extend_calendar(existing, _last_event_day(spark, folder), start)
    for _ in range(2):  # repeated after a failure, it adds nothing
        store.upsert("dim_dates", days, "date_id")
    return store.read("dim_dates")


@query
def calendar_upsert(spark, folder):
    """Weekends of the last year are delivered again as holidays, together with a new year."""
    store, last = GenerationStore(spark, scratch_folder(spark)), _last_event_day(spark, folder)
    start = _first_year(spark, folder)
    store.upsert("dim_dates", build_calendar(spark, last, start, horizon_years=2), "date_id")
    later = build_calendar(spark, last, start).filter(F.col("year") >= F.year(last) + 2)
    days = later.withColumn("is_holiday", F.col("is_weekend"))
    for _ in range(2):
        store.upsert("dim_dates", days, "date_id")
    return store.read("dim_dates")


@query
def dim_tiers(spark, folder):
    return build_tiers(_subscriptions(spark, folder))


@query
def dim_tiers_faithful(spark, folder):
    return build_tiers(_subscriptions(spark, folder), dedupe=False)


@query
def dim_products(spark, folder):
    return build_products(_events(spark, folder))


# ---- account history ------------------------------------------------------


@query
def latest_accounts(spark, folder):
    return hist.latest_accounts(_accounts(spark, folder))


@query
def account_signup_date_id(spark, folder):
    (batch,) = _batches(spark, folder, 1)
    return batch.select("account_id", "name", "signup_date_id")


@query
def scd2_first_load(spark, folder):
    (batch,) = _batches(spark, folder, 1)
    return hist.first_versions(batch)


@query
def scd2_changed_rows(spark, folder):
    """Rows of the second batch that differ from the state after the first."""
    first, second = _batches(spark, folder, 2)
    return hist.changed_rows(second, hist.first_versions(first))


@query
def scd2_version_chain(spark, folder):
    """Ends recomputed by ``lead`` from the start days of a stored history."""
    history = _stored_history(spark, folder).read()
    return hist.version_chain(history.drop("end_date_id", "is_current"))


@query
def scd2_second_batch(spark, folder):
    """First load and two batches through the stored history."""
    return _stored_history(spark, folder).read()


@query
def scd2_changed_accounts(spark, folder):
    """Batches that bring the changed accounts alone, over a base in buckets."""
    store, account = HistoryLog(spark, scratch_folder(spark)), F.col("account_id")
    first, second, third = _batches(spark, folder, 3)
    store.apply(first, FIRST_LOAD)
    store.compact()
    store.apply(second.filter(account % 10 == 0), BATCH_DAYS[0])
    store.apply(third.filter(account % 15 == 0), BATCH_DAYS[1])
    return store.read()


def _stored_history(spark, folder):
    store = HistoryLog(spark, scratch_folder(spark))
    _load_history(store, _batches(spark, folder, 3))
    return store


def _load_history(store, batches):
    for batch, day in zip(batches, [FIRST_LOAD, *BATCH_DAYS]):
        store.apply(batch, day)


# ---- facts ----------------------------------------------------------------


@query
def fact_object_counts(spark, folder):
    return object_counts_fact(_objects(spark, folder))


@query
def usage_event_filter(spark, folder):
    return usage.relevant_events(_events(spark, folder))


@query
def usage_with_product(spark, folder):
    events = _events(spark, folder)
    return usage.with_product(usage.relevant_events(events), _products(events))


@query
def fact_product_usage(spark, folder):
    events = _events(spark, folder)
    return usage.product_usage_fact(events, _products(events))


@query
def fact_product_usage_users(spark, folder):
    events = _events(spark, folder)
    return usage.product_usage_fact(events, _products(events), user_col="user_id")


def _user_sets(spark, folder):
    events = _events(spark, folder)
    return user_sets.daily_user_sets(events, _products(events))


@query
def usage_user_sets(spark, folder):
    """How many users the set of each day, product and bucket of user numbers holds."""
    count = F.bitmap_count("users").alias("n_users")
    return _user_sets(spark, folder).select(*user_sets.BY_DAY, count)


@query
def monthly_active_users(spark, folder):
    """Distinct users by month and product, from stored sets of days of which some came late."""
    warehouse = Warehouse(spark, scratch_folder(spark))
    sources, marts = samples.sample_sources(spark, folder), ["dim_products", "usage_user_sets"]
    early = sources.usage_events.filter(F.dayofmonth("event_time") % 9 != 0)
    for delivered in (dataclasses.replace(sources, usage_events=early), sources):
        warehouse.run_all(delivered, as_of=BATCH_DAYS[0], only=marts)
    return user_sets.monthly_users(warehouse.read("usage_user_sets"))


@query
def product_active_users(spark, folder):
    """Distinct users by product over all days."""
    return user_sets.distinct_users(_user_sets(spark, folder), "product_id")


@query
def weekly_trailing_users(spark, folder):
    """Distinct users by product over the seven days up to each day."""
    return user_sets.trailing_users(_user_sets(spark, folder), 7)


def _text_subscriptions(spark, folder):
    """Subscriptions as CSV files with faults, routed: accepted rows and rejects."""
    scratch = scratch_folder(spark)
    rows = samples.sample_subscriptions(spark, folder)
    number = F.crc32(F.concat_ws("/", "account_id", "start_date", "product"))
    text = {name: F.col(name).cast("string") for name in rows.columns}
    text["monthly_cost"] = F.when(number % 17 == 0, "n/a").otherwise(text["monthly_cost"])
    text["start_date"] = F.when(number % 29 == 0, "1997-02-30").otherwise(text["start_date"])
    text["account_id"] = F.when(number % 31 != 0, text["account_id"])
    text["touchless_conversion"] = F.when(number % 23 == 0, "maybe").otherwise(text["touchless_conversion"])
    rows.select(*(value.alias(name) for name, value in text.items())).write.csv(f"{scratch}/raw")
    texts = rejects.read_text(spark, "subscriptions", f"{scratch}/raw")
    return rejects.route(spark, "subscriptions", texts, f"{scratch}/routed")


@query
def accepted_subscriptions(spark, folder):
    return _text_subscriptions(spark, folder)[0]


@query
def rejected_subscriptions(spark, folder):
    """Rejected rows by account and product as they came, with their reasons."""
    found = _text_subscriptions(spark, folder)[1]
    raw = lambda name: F.get_json_object("raw", f"$.{name}").alias(name)
    return found.groupBy(raw("account_id"), raw("product"), F.array_join("reasons", "; ").alias("reasons")).agg(
        F.count("*").alias("n")
    )


@query
def dq_rejects(spark, folder):
    """Rejected rows by reason, in the form of the quality report."""
    return rejects.reject_report(_text_subscriptions(spark, folder)[1], "subscriptions")


@query
def subscription_events(spark, folder):
    subscriptions, products = _subscriptions(spark, folder), _products(_events(spark, folder))
    return fin.subscription_events(subscriptions, _tiers(subscriptions), products).drop(
        "touchless_conversion"
    )


def _periods(spark, folder):
    return fin.distinct_periods(_subscriptions(spark, folder), _calendar(spark, folder))


@query
def subscription_days(spark, folder):
    return fin.subscription_days(_periods(spark, folder)).select(*fin.PERIOD, "full_date")


@query
def subscription_months(spark, folder):
    return fin.subscription_months(_periods(spark, folder)).select(
        *fin.PERIOD, "financial_month", "days_covered", "total_days"
    )


@query
def financials_days_active(spark, folder):
    months = fin.months_with_days_active(_periods(spark, folder))
    return months.select(*fin.PERIOD, "financial_month", "days_active", "total_days")


@query
def financials_prorated(spark, folder):
    months = fin.months_with_days_active(_periods(spark, folder))
    return fin.prorated(months).select(
        *fin.PERIOD, "financial_month", F.round("adjusted_revenue", 4).alias("adjusted_revenue")
    )


@query
def financials_churn(spark, folder):
    return fin.monthly_churn(fin.subscription_months(_periods(spark, folder)))


@query
def financials_churn_by_offer(spark, folder):
    """Active and churned subscriptions by account, product, tier and month, from the fact itself."""
    return fin.financials_fact(*_financial_inputs(spark, folder)).drop("total_revenue")


def _gapped_calendar(spark, folder):
    """The calendar without 1997's summer, the last days of months and all days before 1996."""
    day = F.col("full_date")
    summer = (F.col("year") == 1997) & F.col("month").isin(6, 7, 8)
    return _calendar(spark, folder).filter(
        ~summer & (F.dayofmonth(day) <= 28) & (F.col("year") >= 1996)
    )


@query
def fact_financials_gapped_calendar(spark, folder):
    """Days that the calendar lacks bring no revenue and count as no day of activity."""
    subscriptions, tiers, products, _ = _financial_inputs(spark, folder)
    calendar = _gapped_calendar(spark, folder)
    return _rounded(fin.financials_fact(subscriptions, tiers, products, calendar))


@query
def subscription_days_gapped_calendar(spark, folder):
    """Covered days of subscriptions where the calendar has gaps."""
    calendar = _gapped_calendar(spark, folder)
    periods = fin.distinct_periods(_subscriptions(spark, folder), calendar)
    return fin.subscription_days(periods, calendar).select(*fin.PERIOD, "full_date")


@query
def days_active_gapped_calendar(spark, folder):
    """Days of activity by subscription and month where the calendar has gaps."""
    calendar = _gapped_calendar(spark, folder)
    periods = fin.distinct_periods(_subscriptions(spark, folder), calendar)
    months = fin.months_with_days_active(periods, fin.calendar_months(calendar))
    return months.select(*fin.PERIOD, "financial_month", "days_active")


def _financial_inputs(spark, folder):
    """Staged subscriptions, tiers, products and calendar."""
    subscriptions, events = _subscriptions(spark, folder), _events(spark, folder)
    return subscriptions, _tiers(subscriptions), _products(events), _calendar(spark, folder)


def _rounded(fact):
    """Sums of doubles depend on row order in their last bits."""
    return fact.withColumn("total_revenue", F.round("total_revenue", 4))


@query
def fact_financials(spark, folder):
    return _rounded(fin.financials_fact(*_financial_inputs(spark, folder)))


@query
def fact_financials_open(spark, folder):
    """Active subscriptions run up to the last order day."""
    until = _last_order_day(spark, folder)
    return _rounded(fin.financials_fact(*_financial_inputs(spark, folder), open_until=until))


@query
def fact_financials_per_subscription(spark, folder):
    inputs = _financial_inputs(spark, folder)
    return _rounded(fin.financials_fact(*inputs, days_grain="subscription"))


# ---- incremental replacement ----------------------------------------------


@query
def replace_object_counts(spark, folder):
    """Days from 2000 on are delivered again, each with one more contact per row."""
    objects = _objects(spark, folder)
    corrected = objects.filter(F.col("date") >= F.lit(dt.date(2000, 1, 1))).withColumn(
        "total_contacts", F.col("total_contacts") + 1
    )
    return replace_by_key(
        object_counts_fact(objects), object_counts_fact(corrected), "usage_date"
    )


@query
def replace_product_usage(spark, folder):
    """From 2024-01-16 on every usage event turns out to be an activation."""
    events, store = _events(spark, folder), GenerationStore(spark, scratch_folder(spark))
    products = _products(events)
    store.replace("fact_product_usage", usage.product_usage_fact(events, products))
    corrected = events.filter(
        F.col("event_time") >= F.lit(dt.date(2024, 1, 16)).cast("timestamp_ntz")
    ).replace("Usage", "Activation", subset="event_type")
    store.replace_partitions("fact_product_usage", usage.product_usage_fact(corrected, products))
    return store.read("fact_product_usage")


@query
def replace_financials(spark, folder):
    """Months touched by subscriptions started from 2000 on are replaced by those alone."""
    subscriptions, *dimensions = _financial_inputs(spark, folder)
    store = GenerationStore(spark, scratch_folder(spark))
    store.replace("fact_financials", fin.financials_fact(subscriptions, *dimensions))
    recent = subscriptions.filter(F.col("start_date") >= F.lit(dt.date(2000, 1, 1)))
    store.replace_partitions("fact_financials", fin.financials_fact(recent, *dimensions))
    return _rounded(store.read("fact_financials"))


def _run_twice(spark, folder, source, day_column, since, fact):
    """``fact`` after a full run without the rows of ``source`` from ``since`` on, and an incremental one."""
    warehouse = Warehouse(spark, scratch_folder(spark))
    warehouse.store.replace("dim_dates", _calendar(spark, folder))
    sources, marts = samples.sample_sources(spark, folder), ["dim_tiers", "dim_products", fact]
    early = getattr(sources, source).filter(F.to_date(day_column) < F.lit(since))
    warehouse.run_all(dataclasses.replace(sources, **{source: early}), as_of=since, only=marts)
    warehouse.run_all(sources, as_of=since, only=marts, since=since)
    return warehouse.read(fact)


@query
def incremental_product_usage(spark, folder):
    since = dt.date(2024, 1, 16)
    return _run_twice(spark, folder, "usage_events", "event_time", since, "fact_product_usage")


@query
def incremental_financials(spark, folder):
    since = dt.date(2000, 1, 1)
    return _rounded(
        _run_twice(spark, folder, "subscriptions", "start_date", since, "fact_financials")
    )


def _run_after_late_changes(spark, folder, source, late, fact):
    """``fact`` after a run that lacks the rows ``late`` of ``source``, and one that finds them."""
    warehouse = Warehouse(spark, scratch_folder(spark))
    warehouse.store.replace("dim_dates", _calendar(spark, folder))
    sources, marts = samples.sample_sources(spark, folder), ["dim_tiers", "dim_products", fact]
    early = getattr(sources, source).filter(~F.coalesce(late, F.lit(False)))
    for delivered in (dataclasses.replace(sources, **{source: early}), sources, sources):
        warehouse.run_all(delivered, as_of=BATCH_DAYS[0], only=marts)
    return warehouse.read(fact)


@query
def detected_object_counts(spark, folder):
    """One account's counts come late for every third day."""
    late = (F.col("account_id") % 5 == 1) & (F.dayofyear("date") % 3 == 0)
    return _run_after_late_changes(spark, folder, "object_counts_daily", late, "fact_object_counts")


@query
def detected_product_usage(spark, folder):
    """The first days' activations and the last days come late."""
    day = F.to_date("event_time")
    late = (F.dayofmonth(day) <= 3) & (F.col("event_type") == "Activation") | (F.dayofmonth(day) >= 28)
    return _run_after_late_changes(spark, folder, "usage_events", late, "fact_product_usage")


@query
def detected_financials(spark, folder):
    """Subscriptions of some accounts in old months and all recent ones come late."""
    old = (F.year("start_date") <= 1996) & (F.col("account_id") % 7 == 0)
    late = old | (F.col("start_date") >= F.lit(dt.date(2000, 1, 1)))
    return _rounded(_run_after_late_changes(spark, folder, "subscriptions", late, "fact_financials"))


# ---- quality --------------------------------------------------------------


def _built_warehouse(spark, folder) -> Warehouse:
    """The checked marts as tables, built from the sources as they are now."""
    warehouse = Warehouse(spark, scratch_folder(spark))
    warehouse.store.replace("dim_dates", _calendar(spark, folder))
    _load_history(warehouse.history, _batches(spark, folder, 3))
    warehouse.run_all(
        samples.sample_sources(spark, folder),
        as_of=BATCH_DAYS[-1],
        only=["dim_tiers", "dim_products", "fact_product_usage", "fact_financials"],
    )
    return warehouse


def _report(spark, folder, kinds=quality.KINDS):
    warehouse = _built_warehouse(spark, folder)
    sources = samples.sample_sources(spark, folder)
    marts = sorted({c.table for c in CHECKS if not hasattr(sources, c.table)} | {"dim_dates"})
    tables = {name: warehouse.read(name) for name in marts} | vars(sources)
    return quality.run_checks(tables, [c for c in CHECKS if c.kind in kinds])


@query
def dq_unique(spark, folder):
    return _report(spark, folder, [quality.UNIQUE])


@query
def dq_not_null(spark, folder):
    return _report(spark, folder, [quality.NOT_NULL])


@query
def dq_not_null_where(spark, folder):
    return _report(spark, folder, [quality.NOT_NULL_WHERE])


@query
def dq_relationships(spark, folder):
    return _report(spark, folder, [quality.RELATIONSHIPS])


@query
def dq_expression_is_true(spark, folder):
    return _report(spark, folder, [quality.EXPRESSION])


@query
def dq_report(spark, folder):
    return _report(spark, folder)
