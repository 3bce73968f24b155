"""The account history as a log of changed versions over bucketed open ones."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subsmart.operators.history import COLUMNS, batch_changes
from subsmart.operators.spread import sized
from subsmart.schemas import MARTS
from subsmart.sources.files import children, delete_folder, folder_bytes
from subsmart.sources.generations import Marker, clean_folder

# A version is known by its account and first day.
VERSION = ["account_id", "start_date_id"]
BUCKETS = 16
BUCKET_BYTES = 64 << 20
# The log since the last base is merged into a new base beyond this share of the base, or
# this number of batches that brought changes.
LOG_SHARE = 0.5
LOG_BATCHES = 32


class HistoryLog:
    """``as_of`` batches of account versions below ``root``.

    A batch stores what it changed and nothing else: versions it closed and versions it
    opened. The closed row of a version stands against its open row of an earlier batch and
    is final. The last row of a version, by batch, is the valid one.

    From time to time the open versions are merged into a base, spread over buckets by a
    hash of the account. A batch is compared only with the buckets of its own accounts and
    with the log since that base. Closed versions stay in the log, are never rewritten or
    shuffled, and are skipped when the open ones are looked for. Storage is thus bounded by
    the versions, however many batches there are.

    A marker lists the batches and the base. A batch that dies is not listed; running the
    last batch again replaces it. Readers that resolved an earlier mark keep their folders
    until ``clean``.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.marker = Marker(spark, self.root)

    def batches(self) -> list[int]:
        """Day ids of the batches, oldest first."""
        return [entry["as_of"] for entry in self._state()["log"]]

    def read(self, upto: int | None = None) -> DataFrame:
        """The whole history as of the last batch, or as of day id ``upto``."""
        state = self._state(upto)
        base, recent = self._split(state)
        merged = [entry for entry in state["log"] if base and entry["as_of"] <= base["upto"]]
        final = self._log(merged).filter(~F.col("is_current"))
        return final.select(*COLUMNS).unionByName(self._merged(base, recent))

    def current(self) -> DataFrame:
        """The open versions."""
        return self._current(self._state())

    def current_of(self, accounts: DataFrame, before: int | None = None) -> DataFrame:
        """The open versions in the buckets of ``accounts`` (``account_id``).

        The buckets, at most their fixed number, are looked up first, so that the scan of
        the base skips all others.
        """
        state = self._state(None if before is None else before - 1)
        if not state["base"]:
            return self._current(state)
        rows = accounts.select(_bucket(state["base"]["buckets"]).alias("bucket")).distinct().collect()
        return self._current(state, sorted(row[0] for row in rows if row[0] is not None))

    def apply(self, batch: DataFrame, as_of: dt.date) -> None:
        """Store what ``batch``, one row per account, changes on the day ``as_of``."""
        day = as_of.year * 10000 + as_of.month * 100 + as_of.day
        if later := [b for b in self.batches() if b > day]:
            raise ValueError(f"batch {day} is older than the stored batch {later[-1]}")
        self._compact_if_due(day)
        number = self.marker.last()[0]
        state = self._state(day - 1)
        changes = batch_changes(self.current_of(batch, before=day), batch, as_of)
        entry = {"as_of": day, **self._write(changes.withColumn("as_of", F.lit(day)), "is_current")}
        state["log"].append(entry)
        if not self.marker.switch(number, state):
            raise RuntimeError(f"another batch was stored while batch {day} ran; run it again")

    def compact(self) -> None:
        """Merge the log into a new base, in buckets of at most ``BUCKET_BYTES`` or so."""
        number, state = self.marker.last()[0], self._state()
        self._compact(number, state)

    def clean(self, keep: int = 2, hours: float = 24.0) -> int:
        """Delete folders that none of the last ``keep`` states lists; how many there were."""
        return clean_folder(self.spark, self.root, self.marker, keep, hours)

    def _state(self, upto: int | None = None) -> dict:
        """The listed batches, those up to day id ``upto`` only, and a base if it is not later."""
        state = self.marker.last()[1] or {"log": [], "base": None}
        if upto is None:
            return state
        base = state["base"]
        return {
            "log": [entry for entry in state["log"] if entry["as_of"] <= upto],
            "base": base if base and base["upto"] <= upto else None,
        }

    def _split(self, state: dict) -> tuple[dict | None, list[dict]]:
        base = state["base"]
        return base, [e for e in state["log"] if not base or e["as_of"] > base["upto"]]

    def _current(self, state: dict, buckets: list[int] | None = None) -> DataFrame:
        return self._merged(*self._split(state), buckets).filter("is_current")

    def _merged(
        self, base: dict | None, recent: list[dict], buckets: list[int] | None = None
    ) -> DataFrame:
        """Open versions of the base that the log left alone, and the last row of the others."""
        values = [c for c in COLUMNS if c not in VERSION]
        last = (
            self._log(recent)
            .groupBy(*VERSION)
            .agg(F.max_by(F.struct(*values), "as_of").alias("_row"))
            .select(*VERSION, "_row.*")
            .select(*COLUMNS)
        )
        if not base:
            return last
        kept = self._base(base)
        if buckets is not None:
            kept = kept.filter(F.col("bucket").isin(buckets))
        if recent and any(entry["id"] for entry in recent):
            # Every log row, so that a version closed and one replaced are left out alike.
            kept = kept.join(sized(self._log(recent).select(*VERSION).distinct()).frame, VERSION, "left_anti")
        return kept.select(*COLUMNS).unionByName(last)

    def _log(self, entries: list[dict]) -> DataFrame:
        return self._scan([e["id"] for e in entries if e["id"]], "as_of")

    def _base(self, base: dict) -> DataFrame:
        return self._scan([base["id"]], "bucket")

    def _scan(self, writes: list[str], extra: str) -> DataFrame:
        stored = T.StructType([*MARTS["dim_accounts"].fields, T.StructField(extra, T.IntegerType())])
        if not writes:
            return self.spark.createDataFrame([], stored)
        by_write = T.StructType([*stored.fields, T.StructField("write", T.StringType())])
        reader = self.spark.read.schema(by_write).option("basePath", self.root)
        return reader.parquet(*(f"{self.root}/write={w}" for w in writes)).drop("write")

    def _write(self, rows: DataFrame, by: str) -> dict:
        """Store ``rows``; the id is None, and nothing stored, where there are none."""
        write = uuid.uuid4().hex
        path = f"{self.root}/write={write}"
        rows.hint("rebalance", by).write.partitionBy(by).parquet(path)
        if not any(name.startswith(f"{by}=") for name in children(self.spark, path)):
            delete_folder(self.spark, path)
            return {"id": None, "bytes": 0}
        return {"id": write, "bytes": folder_bytes(self.spark, path)}

    def _compact_if_due(self, day: int) -> None:
        number, state = self.marker.last()[0], self._state(day - 1)
        base, recent = self._split(state)
        changed = [entry for entry in recent if entry["id"]]
        log_bytes = sum(entry["bytes"] for entry in changed)
        if changed and (
            not base or log_bytes > LOG_SHARE * base["bytes"] or len(changed) > LOG_BATCHES
        ):
            # A batch run again is compared with what was before it; it stays listed meanwhile.
            self._compact(number, state, self._state())

    def _compact(self, number: int, state: dict, listed: dict | None = None) -> None:
        if not state["log"]:
            return
        base, recent = self._split(state)
        size = (base["bytes"] if base else 0) + sum(entry["bytes"] for entry in recent)
        buckets = max(self.buckets, -(-size // BUCKET_BYTES))
        rows = self._current(state).withColumn("bucket", _bucket(buckets))
        written = self._write(rows, "bucket")
        if written["id"] is None:
            return
        new = {"upto": state["log"][-1]["as_of"], "buckets": buckets, **written}
        # Where another writer was faster, its state stays; the next batch tries again.
        self.marker.switch(number, {**(listed or state), "base": new})


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("account_id"), F.lit(buckets)).cast("int")
