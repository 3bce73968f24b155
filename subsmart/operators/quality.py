"""Declarative data-quality checks as Spark jobs.

Every check yields one report row ``(table, column, check, status, failures)``.
All checks of a table share one scan, and all key checks one shuffle: uniqueness and
referential checks count by key before anything moves, so a key that holds a third of
the rows travels as one row per task.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NOT_NULL, NOT_NULL_WHERE = "not_null", "not_null_where"
UNIQUE, RELATIONSHIPS, EXPRESSION = "unique", "relationships", "expression_is_true"
KINDS = (UNIQUE, NOT_NULL, NOT_NULL_WHERE, RELATIONSHIPS, EXPRESSION)
KEY_KINDS = (UNIQUE, RELATIONSHIPS)
# Where a uniqueness check finds its count among a set's values.
REPEATED = 0


@dataclass(frozen=True)
class Check:
    """``argument``: the row filter, the parent ``table.column`` or the condition on the column.

    A uniqueness check without a row filter covers all rows.
    """

    table: str
    column: str
    kind: str
    argument: str = ""

    @property
    def label(self) -> str:
        return f"{self.kind}: {self.argument}" if self.argument else self.kind


def run_checks(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """The report of ``checks`` over ``tables``; nothing runs until it is read.

    A check on a column or parent that is not there gets the status ``missing_column``.
    Each table is scanned once: a table without key checks by one aggregate, all others by
    the pass that tags their keys.
    """
    checks = list(checks)
    present, absent = [], []
    for check in checks:
        (present if _applies(tables, check) else absent).append(check)
    keyed = {c.table for c in present if c.kind in KEY_KINDS} | {
        _parent(c)[0] for c in present if c.kind == RELATIONSHIPS
    }
    parts = []
    for table in dict.fromkeys(c.table for c in present if c.table not in keyed):
        parts.append(_scan_report(tables[table], [c for c in present if c.table == table]))
    if keyed:
        parts.append(_tagged_report(tables, [c for c in present if c.table in keyed]))
    if absent:
        parts.append(_missing_report(next(iter(tables.values())), absent))
    return functools.reduce(DataFrame.unionByName, parts)


def _parent(check: Check) -> tuple[str, str]:
    table, column = check.argument.split(".")
    return table, column


def _applies(tables: Mapping[str, DataFrame], check: Check) -> bool:
    if check.table not in tables or check.column not in tables[check.table].columns:
        return False
    if check.kind != RELATIONSHIPS:
        return True
    table, column = _parent(check)
    return table in tables and column in tables[table].columns


def _labels(check: Check) -> list[Column]:
    return [
        F.lit(check.table).alias("table"),
        F.lit(check.column).alias("column"),
        F.lit(check.label).alias("check"),
    ]


def _status(failures: Column) -> Column:
    return F.when(failures == 0, "pass").otherwise("fail").alias("status")


def _violation(check: Check) -> Column:
    column = F.col(check.column)
    if check.kind == NOT_NULL:
        return column.isNull()
    if check.kind == NOT_NULL_WHERE:
        return F.expr(check.argument) & column.isNull()
    if check.kind == EXPRESSION:
        return ~F.expr(f"`{check.column}` {check.argument}")
    raise ValueError(f"unknown check {check.kind!r}, expected one of {KINDS}")


def _scan_report(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All row-level checks of a table from one aggregate."""
    counts = df.agg(*(F.count_if(_violation(c)).alias(f"n{i}") for i, c in enumerate(checks)))
    rows = [
        F.struct(*_labels(c), _status(F.col(f"n{i}")), F.col(f"n{i}").alias("failures"))
        for i, c in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*rows)))


def _tagged_report(tables: Mapping[str, DataFrame], checks: list[Check]) -> DataFrame:
    """Key checks, and the row checks of the same tables, from one aggregate.

    Every table becomes rows of ``(set, key, slot)``: a set holds the values of a uniqueness
    check, the values of a parent column (slot 0) with those of all the columns that refer
    to it (a slot each), or, for the rows that violate row checks of a table, which ones.
    Counting by set and key where the rows lie leaves one row per task of a hot key, and a
    parent is made distinct once however many columns refer to it.
    """
    tags: dict[str, list[Column]] = {}
    sets: dict[tuple, int] = {}
    slots: dict[int, int] = {}
    places: list[tuple[Check, int, int]] = []

    def tag(table: str, number: int, slot: int, key: Column, when: Column) -> None:
        row = F.struct(
            F.lit(number).alias("set"), key.cast("string").alias("key"), F.lit(slot).alias("slot")
        )
        tags.setdefault(table, []).append(F.when(when, row))

    def number_of(name: tuple) -> int:
        return sets.setdefault(name, len(sets))

    for check in checks:
        column = F.col(check.column)
        if check.kind == UNIQUE:
            number = number_of((check,))
            where = F.expr(check.argument) if check.argument else F.lit(True)
            tag(check.table, number, 0, column, column.isNotNull() & where)
            places.append((check, number, REPEATED))
        elif check.kind == RELATIONSHIPS:
            table, field = _parent(check)
            kind = tables[table].schema[field].dataType
            if (table, field) not in sets:
                tag(table, number_of((table, field)), 0, F.col(field), F.col(field).isNotNull())
            number = sets[table, field]
            slots[number] = slot = slots.get(number, 0) + 1
            tag(check.table, number, slot, column.try_cast(kind), column.isNotNull())
            places.append((check, number, slot))
    most = max([*slots.values(), 0])
    row_checks: dict[str, list[Check]] = {}
    for check in checks:
        if check.kind not in KEY_KINDS:
            row_checks.setdefault(check.table, []).append(check)
    for table, own in row_checks.items():
        # The places of the violated checks are the key, so there are few keys.
        flags = [F.coalesce(_violation(c), F.lit(False)) for c in own]
        mask = F.concat(*(F.when(flag, "1").otherwise("0") for flag in flags))
        number = number_of((table,))
        tag(table, number, 0, mask, functools.reduce(operator.or_, flags))
        places.extend((c, number, most + 1 + i) for i, c in enumerate(own))
    longest = max([len(own) for own in row_checks.values()] or [0])
    first_rows = min((sets[(table,)] for table in row_checks), default=len(sets))

    tagged = functools.reduce(
        DataFrame.unionByName,
        [tables[t].select(F.inline(F.array(*rows))).filter("set is not null") for t, rows in tags.items()],
    )
    counts = tagged.groupBy("set", "key").agg(
        *(F.count_if(F.col("slot") == i).alias(f"n{i}") for i in range(most + 1))
    )
    is_rows = F.col("set") >= first_rows
    violated = lambda i: F.substring("key", i + 1, 1) == "1"
    found = counts.groupBy("set").agg(
        F.count_if(~is_rows & (F.col("n0") > 1)).alias("v0"),
        *(F.sum(F.when(F.col("n0") == 0, F.col(f"n{i}"))).alias(f"v{i}") for i in range(1, most + 1)),
        *(
            F.sum(F.when(is_rows & violated(i), F.col("n0"))).alias(f"v{most + 1 + i}")
            for i in range(longest)
        ),
    )
    values = found.select(
        F.col("set").alias("_set"), F.array(*(F.col(f"v{i}") for i in range(most + 1 + longest))).alias("_values")
    )
    rows = [(c.table, c.column, c.label, number, place) for c, number, place in places]
    listed = tagged.sparkSession.createDataFrame(
        rows, "`table` string, `column` string, `check` string, set int, place int"
    )
    # At most one row of values per set.
    joined = listed.join(F.broadcast(values), F.col("set") == F.col("_set"), "left")
    failures = F.coalesce(F.get("_values", F.col("place")), F.lit(0)).cast("long")
    return joined.select("table", "column", "check", _status(failures), failures.alias("failures"))


def _missing_report(any_table: DataFrame, checks: list[Check]) -> DataFrame:
    rows = [(c.table, c.column, c.label, "missing_column", None) for c in checks]
    schema = "table string, column string, check string, status string, failures long"
    return any_table.sparkSession.createDataFrame(rows, schema)
