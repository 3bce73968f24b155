"""Marts that are built aside and switched by one marker file."""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subsmart.operators.spread import sized
from subsmart.schemas import MARTS, REPLACE_KEYS, STATE
from subsmart.sources.files import (
    children,
    create_text,
    delete_folder,
    exists,
    hours_old,
    read_text,
)
from subsmart.sources.store import MartStore

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
TABLES = MARTS | STATE


class Marker:
    """The numbered marks of a folder. The last whole one says what the folder's table is.

    A mark is made under a number that must not exist yet, so of two writers that start
    from one state only one can switch it. A mark that is not whole, its writer having
    died, counts as absent but keeps its number.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = f"{folder}/_marks"

    def numbers(self) -> list[int]:
        if not exists(self.spark, self.folder):
            return []
        names = [n.removesuffix(".json") for n in children(self.spark, self.folder) if n.endswith(".json")]
        return sorted(int(n) for n in names if n.isdigit())

    def states(self, most: int) -> list[dict]:
        """The last ``most`` states, newest first."""
        found: list[dict] = []
        for number in reversed(self.numbers()):
            if len(found) == most:
                break
            try:
                found.append(json.loads(read_text(self.spark, f"{self.folder}/{number}.json")))
            except ValueError:
                continue
        return found

    def last(self) -> tuple[int, dict | None]:
        """The last number given, whole or not, and the state."""
        return (self.numbers() or [0])[-1], next(iter(self.states(1)), None)

    def switch(self, after: int, state: dict) -> bool:
        """Make ``state`` the table unless another one was made since number ``after``."""
        return create_text(self.spark, f"{self.folder}/{after + 1}.json", json.dumps(state))


class GenerationStore(MartStore):
    """Marts whose every write goes to a folder of its own and counts once it is marked.

    ``<mart>/write=<id>`` holds what one write brought. A mark lists the writes that make
    up the table and, for marts with a replace key, the key values of each that later
    writes replaced. Readers resolve the last mark and read its folders only, so they never
    meet a half-written table, and a table read before a switch stays readable after it
    until ``clean``. A write that dies leaves an unlisted folder. Two writers at once
    both take effect, one after the other.
    """

    def _marker(self, name: str) -> Marker:
        return Marker(self.spark, self.path(name))

    def exists(self, name: str) -> bool:
        return self._marker(name).last()[1] is not None

    def read(self, name: str) -> DataFrame:
        return self._rows(name, self._marker(name).last()[1])

    def replace(self, name: str, df: DataFrame) -> None:
        write = self._aside(name, df)
        self._switch(name, lambda old: [{"id": write}])

    def replace_partitions(self, name: str, df: DataFrame) -> None:
        if name not in REPLACE_KEYS:
            raise ValueError(f"{name} has no replace key")
        write = self._aside(name, df)
        brought = self._key_values(name, write)
        if not brought and self.exists(name):
            delete_folder(self.spark, self.path(name, f"write={write}"))
            return
        self._switch(name, lambda old: [*self._without(name, old, brought), {"id": write}])

    def drop_partitions(self, name: str, values: list[str]) -> None:
        """Remove the rows whose key, as text, is one of ``values``."""
        self._switch(name, lambda old: self._without(name, old, values))

    def append(self, name: str, df: DataFrame) -> None:
        """Add rows whose keys are known to be new; ``upsert`` needs no such knowledge."""
        write = self._aside(name, df)
        self._switch(name, lambda old: [*old, {"id": write}])

    def upsert(self, name: str, df: DataFrame, key: str) -> None:
        """Rows of ``df`` replace those with their ``key``; the others are added.

        Repeating it changes nothing, and neither does a second run at the same time: who
        switches second starts again from the new table. Of rows with one key in ``df`` the
        greatest stays; NULL is a key. Only new keys are a small added write; otherwise the
        table, without the rows to be replaced, is built anew aside.
        """
        others = [c for c in TABLES[name].names if c != key]
        unique = df.groupBy(key).agg(F.max(F.struct(*others)).alias("_row")).select(key, "_row.*")
        write = self._aside(name, unique)
        batch = self._rows(name, {"writes": [{"id": write}]})
        keys = sized(batch.select(F.col(key).alias("_key"))).frame
        same = F.col(key).eqNullSafe(F.col("_key"))
        while True:
            number, state = self._marker(name).last()
            table = self._rows(name, state)
            old = table.join(keys, same, "left_semi")
            if old.isEmpty():
                writes = [*_writes(state), {"id": write}]
            elif state and batch.subtract(old).isEmpty():
                delete_folder(self.spark, self.path(name, f"write={write}"))
                return
            else:
                rest = table.join(keys, same, "left_anti").unionByName(batch)
                writes = [{"id": self._aside(name, rest)}]
            if self._marker(name).switch(number, {"writes": writes}):
                return

    def compact(self, name: str) -> None:
        """Write the table as one write, where many small ones piled up."""
        number, state = self._marker(name).last()
        if state and len(_writes(state)) > 1:
            write = self._aside(name, self._rows(name, state))
            # Where another writer was faster, its table stays.
            self._marker(name).switch(number, {"writes": [{"id": write}]})

    def clean(self, name: str, keep: int = 2, hours: float = 24.0) -> int:
        """Delete the folders that none of the last ``keep`` states lists; how many there were.

        Folders changed in the last ``hours`` stay: their write may be running.
        """
        return clean_folder(self.spark, self.path(name), self._marker(name), keep, hours)

    def _switch(self, name: str, change) -> None:
        while True:
            number, state = self._marker(name).last()
            if self._marker(name).switch(number, {"writes": change(_writes(state))}):
                return

    def _aside(self, name: str, df: DataFrame) -> str:
        """Write ``df`` to a folder that no mark lists yet."""
        write = uuid.uuid4().hex
        df = df.select(*TABLES[name].names)
        key = REPLACE_KEYS.get(name)
        path = self.path(name, f"write={write}")
        if key is None:
            df.write.parquet(path)
        else:
            df.hint("rebalance", key).write.partitionBy(key).parquet(path)
        return write

    def _key_values(self, name: str, write: str) -> list[str]:
        """The key values of a write, as text, from its folders."""
        prefix = REPLACE_KEYS[name] + "="
        found = children(self.spark, self.path(name, f"write={write}"))
        return sorted(unquote(n.removeprefix(prefix)) for n in found if n.startswith(prefix))

    def _without(self, name: str, writes: list[dict], values: list[str]) -> list[dict]:
        """``writes`` less the key ``values``; a write that has none left drops out."""
        out = []
        for write in writes:
            own = set(self._key_values(name, write["id"]))
            gone = set(write.get("gone", [])) | (own & set(values))
            if own - gone:
                out.append({"id": write["id"], "gone": sorted(gone)})
        return out

    def _rows(self, name: str, state: dict | None) -> DataFrame:
        schema, writes = TABLES[name], _writes(state)
        if not writes:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType([*schema.fields, T.StructField("write", T.StringType())])
        reader = self.spark.read.schema(stored).option("basePath", self.path(name))
        rows = reader.parquet(*(self.path(name, f"write={w['id']}") for w in writes))
        for write in writes:
            if write.get("gone"):
                rows = rows.filter(_live(REPLACE_KEYS[name], write))
        return rows.select(*schema.names)


def _live(key: str, write: dict) -> str:
    """A condition on partition columns alone, so the scan skips replaced partitions."""
    values = [v for v in write["gone"] if v != NO_VALUE]
    listed = ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)
    tests = [f"coalesce(cast(`{key}` as string) in ({listed}), false)"] if values else []
    if NO_VALUE in write["gone"]:
        tests.append(f"`{key}` is null")
    return f"not (write = '{write['id']}' and ({' or '.join(tests)}))"


def _writes(state: dict | None) -> list[dict]:
    return list(state["writes"]) if state else []


def listed_ids(state) -> set[str]:
    """Every write id anywhere in a state."""
    if isinstance(state, dict):
        own = {state["id"]} if state.get("id") else set()
        return own.union(*(listed_ids(value) for value in state.values()))
    if isinstance(state, list):
        return set().union(*(listed_ids(value) for value in state))
    return set()


def clean_folder(spark: SparkSession, folder: str, marker: Marker, keep: int, hours: float) -> int:
    wanted = listed_ids(marker.states(keep))
    names = [n for n in children(spark, folder) if n.startswith("write=")]
    old = [n for n in names if n.removeprefix("write=") not in wanted]
    old = [n for n in old if hours_old(spark, f"{folder}/{n}") >= hours]
    for name in old:
        delete_folder(spark, f"{folder}/{name}")
    return len(old)
