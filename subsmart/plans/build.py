"""Builds the marts in dependency order, in full or incrementally."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subsmart.functions.dates import as_date, month_start
from subsmart.operators import changes, staging
from subsmart.operators.calendar import FIRST_DAY, build_calendar, extend_calendar
from subsmart.operators.dimensions import build_products, build_tiers
from subsmart.operators.financials import financials_fact
from subsmart.operators.history import account_batch
from subsmart.operators.objects import object_counts_fact
from subsmart.operators.spread import settle
from subsmart.operators.usage import product_usage_fact
from subsmart.operators.user_sets import daily_user_sets
from subsmart.schemas import PRINTS
from subsmart.session import fit_shuffles_to
from subsmart.sources.generations import GenerationStore
from subsmart.sources.history_log import HistoryLog
from subsmart.sources.samples import RawSources


class Warehouse:
    """The marts below one root folder, built from raw sources."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.store = GenerationStore(spark, root)
        self.history = HistoryLog(spark, self.store.path("dim_accounts"))

    def read(self, name: str) -> DataFrame:
        return self.history.read() if name == "dim_accounts" else self.store.read(name)

    def _upstream(self, name: str) -> DataFrame:
        """A mart that another one is built from; it must have been written."""
        if not self.store.exists(name):
            raise ValueError(f"{name} must be built first")
        return self.store.read(name)

    def create_views(self) -> None:
        """Temporary views over all marts, for SQL."""
        for name in ORDER:
            self.read(name).createOrReplaceTempView(name)

    def run_all(
        self,
        sources: RawSources,
        as_of: dt.date,
        start: dt.date | str | Column = FIRST_DAY,
        full_refresh: bool = False,
        only: Iterable[str] | None = None,
        since: dt.date | str | None = None,
    ) -> None:
        """Build every mart, or those in ``only``, with the calendar reaching past ``as_of``.

        Marts of ``EXTRA`` are built only where ``only`` names them.

        The number of shuffle partitions follows the size of the sources, and that of the
        revenue fact the number of month rows that its subscriptions grow to.

        A fact that exists already gets the keys replaced whose source rows are not those it
        was built from, however old; ``full_refresh`` rewrites it. ``since`` trusts the
        caller instead and replaces the days from then on, or whole months for financials.
        The account history always advances by one batch; its versions cannot be rebuilt
        from the current sources.
        """
        wanted = set(ORDER if only is None else only)
        unknown = wanted - set(BUILDERS)
        if unknown:
            raise ValueError(f"no such mart: {', '.join(sorted(unknown))}")
        fit_shuffles_to(self.spark, vars(sources).values())
        staged = stage_all(sources)
        for name in (n for n in BUILDERS if n in wanted):
            BUILDERS[name](self, staged, as_of, start, full_refresh, since)

    def _dates(self, staged, as_of, start, full_refresh, since) -> None:
        if full_refresh or not self.store.exists("dim_dates"):
            self.store.replace("dim_dates", build_calendar(self.spark, as_of, start))
        else:
            days = extend_calendar(self.store.read("dim_dates"), as_of, start)
            self.store.upsert("dim_dates", days, "date_id")

    def _tiers(self, staged, as_of, start, full_refresh, since) -> None:
        self.store.replace("dim_tiers", build_tiers(staged["subscriptions"]))

    def _products(self, staged, as_of, start, full_refresh, since) -> None:
        self.store.replace("dim_products", build_products(staged["usage_events"]))

    def _accounts(self, staged, as_of, start, full_refresh, since) -> None:
        batch = account_batch(staged["accounts"], self._upstream("dim_dates"))
        self.history.apply(batch, as_of)

    def _objects(self, staged, as_of, start, full_refresh, since) -> None:
        rows = staged["object_counts_daily"]

        def build(keys):
            return object_counts_fact(self._input(rows, "date", keys, since))

        self._fact("fact_object_counts", changes.object_prints(rows), build, full_refresh, since)

    def _usage(self, staged, as_of, start, full_refresh, since) -> None:
        rows, products = staged["usage_events"], self._upstream("dim_products")

        def build(keys):
            return product_usage_fact(self._input(rows, "event_time", keys, since), products)

        prints = changes.usage_prints(rows, products)
        self._fact("fact_product_usage", prints, build, full_refresh, since)

    def _user_sets(self, staged, as_of, start, full_refresh, since) -> None:
        rows, products = staged["usage_events"], self._upstream("dim_products")

        def build(keys):
            return daily_user_sets(self._input(rows, "event_time", keys, since), products)

        prints = changes.usage_prints(rows, products, ["user_id"])
        self._fact("usage_user_sets", prints, build, full_refresh, since)

    def _financials(self, staged, as_of, start, full_refresh, since) -> None:
        calendar = self._upstream("dim_dates")
        inputs = staged["subscriptions"], self._upstream("dim_tiers"), self._upstream("dim_products")

        def build(keys):
            days, month = calendar, month_start(F.col("full_date"))
            if keys is not None:
                days = changes.only_keys(calendar, month, keys)
            elif since is not None:
                days = calendar.filter(F.col("full_date") >= month_start(as_date(since)))
            return financials_fact(*inputs, days)

        prints = changes.financial_prints(*inputs, calendar)
        self._fact("fact_financials", prints, build, full_refresh, since)

    def _input(self, rows: DataFrame, column: str, keys: DataFrame | None, since) -> DataFrame:
        """The rows of the days in ``keys``, or from ``since`` on."""
        if keys is not None:
            return changes.only_keys(rows, F.to_date(column), keys)
        return rows if since is None else rows.filter(F.col(column) >= as_date(since))

    def _fact(self, name: str, prints: DataFrame, build, full_refresh: bool, since) -> None:
        """Write a fact, then the prints of what it was built from.

        Should a run die in between, the next one finds the same keys changed again.
        """
        state = PRINTS[name]
        if full_refresh or not self.store.exists(name):
            prints = settle(prints)
            self.store.replace(name, build(None))
            self.store.replace(state, prints)
        elif since is None:
            changed = settle(changes.changed_keys(prints, self.store.read(state)))
            if not changed.isEmpty():
                self.store.replace_partitions(name, build(changed))
                self.store.upsert(state, changed, "key")
        else:
            # Nothing is known any more of what the rows from then on are built from.
            first = month_start(as_date(since))
            self.store.replace(state, self.store.read(state).filter(F.col("key") < first))
            self.store.replace_partitions(name, build(None))


BUILDERS = {
    "dim_dates": Warehouse._dates,
    "dim_tiers": Warehouse._tiers,
    "dim_products": Warehouse._products,
    "dim_accounts": Warehouse._accounts,
    "fact_object_counts": Warehouse._objects,
    "fact_product_usage": Warehouse._usage,
    "fact_financials": Warehouse._financials,
    "usage_user_sets": Warehouse._user_sets,
}
EXTRA = ["usage_user_sets"]
ORDER = [name for name in BUILDERS if name not in EXTRA]


STAGING_VIEWS = {
    "accounts": "stg_accounts",
    "subscriptions": "stg_subscriptions",
    "usage_events": "stg_usage_events",
    "object_counts_daily": "stg_object_counts_daily",
}


def create_staging_views(sources: RawSources) -> None:
    """Temporary views over the staged sources, for SQL."""
    for source, df in stage_all(sources).items():
        df.createOrReplaceTempView(STAGING_VIEWS[source])


def stage_all(sources: RawSources) -> dict[str, DataFrame]:
    """The four staging views."""
    return {
        "accounts": staging.stage_accounts(sources.accounts),
        "subscriptions": staging.stage_subscriptions(sources.subscriptions),
        "usage_events": staging.stage_usage_events(sources.usage_events),
        "object_counts_daily": staging.stage_object_counts(sources.object_counts_daily),
    }
