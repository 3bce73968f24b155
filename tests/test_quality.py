from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from subsmart.operators.quality import Check, run_checks
from subsmart.plans.checks import CHECKS


@pytest.fixture(scope="module")
def tables(spark):
    child = spark.sql(
        "select * from values (1, 10, 5, true), (2, 10, -1, true), (2, 30, null, false),"
        " (null, null, 0, true) as t(id, parent_id, amount, is_current)"
    )
    parent = spark.sql("select * from values (10), (10), (20) as t(id)")
    return {"child": child, "parent": parent}


def failures(tables, *checks, **options):
    rows = run_checks(tables, checks, **options).collect()
    return {(r.table, r.column, r.check): (r.status, r.failures) for r in rows}


def test_each_kind_counts_failing_rows(tables):
    report = failures(
        tables,
        Check("child", "id", "unique"),
        Check("child", "parent_id", "unique"),
        Check("parent", "id", "unique"),
        Check("child", "id", "not_null"),
        Check("child", "is_current", "not_null"),
        Check("child", "amount", "not_null_where", "is_current"),
        Check("child", "amount", "not_null_where", "amount IS NOT NULL"),
        Check("child", "parent_id", "relationships", "parent.id"),
        Check("parent", "id", "relationships", "child.parent_id"),
        Check("child", "amount", "expression_is_true", ">= 0"),
        Check("child", "amount", "expression_is_true", "< 100"),
    )
    assert report == {
        ("child", "id", "unique"): ("fail", 1),
        ("child", "parent_id", "unique"): ("fail", 1),
        ("parent", "id", "unique"): ("fail", 1),
        ("child", "id", "not_null"): ("fail", 1),
        ("child", "is_current", "not_null"): ("pass", 0),
        ("child", "amount", "not_null_where: is_current"): ("pass", 0),
        ("child", "amount", "not_null_where: amount IS NOT NULL"): ("pass", 0),
        ("child", "parent_id", "relationships: parent.id"): ("fail", 1),
        ("parent", "id", "relationships: child.parent_id"): ("fail", 1),
        ("child", "amount", "expression_is_true: >= 0"): ("fail", 1),
        ("child", "amount", "expression_is_true: < 100"): ("pass", 0),
    }


def test_orphans_are_counted_by_row(spark, tables):
    many = tables["child"].unionByName(tables["child"]).unionByName(tables["child"])
    check = Check("child", "parent_id", "relationships", "parent.id")
    report = failures({**tables, "child": many}, check)
    assert list(report.values()) == [("fail", 3)]


def test_row_filter_narrows_uniqueness(tables):
    check = Check("child", "id", "unique", "is_current")
    assert failures(tables, check) == {("child", "id", "unique: is_current"): ("pass", 0)}


def test_missing_columns_are_reported(tables):
    report = failures(
        tables,
        Check("child", "absent", "not_null"),
        Check("nowhere", "id", "unique"),
        Check("child", "id", "relationships", "parent.absent"),
    )
    assert set(report.values()) == {("missing_column", None)}


def test_empty_tables_pass(tables):
    empty = {name: df.limit(0) for name, df in tables.items()}
    report = failures(
        empty,
        Check("child", "id", "unique"),
        Check("child", "id", "not_null"),
        Check("child", "parent_id", "relationships", "parent.id"),
    )
    assert set(report.values()) == {("pass", 0)}


def test_row_checks_of_a_table_share_one_scan(tables):
    checks = [Check("child", c, "not_null") for c in ("id", "parent_id", "amount")]
    plan = run_checks(tables, checks)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_declared_checks():
    kinds = [c.kind for c in CHECKS]
    expected = {"unique": 6, "not_null": 37, "not_null_where": 2, "relationships": 15}
    assert {k: kinds.count(k) for k in expected} == expected
    assert kinds.count("expression_is_true") == 6 and len(set(CHECKS)) == 66


def plain_failures(tables, check):
    rows = [r.asDict() for r in tables[check.table].collect()]
    values = [r[check.column] for r in rows if r[check.column] is not None]
    if check.kind == "unique":
        return sum(values.count(v) > 1 for v in set(values))
    if check.kind == "not_null":
        return len(rows) - len(values)
    table, field = check.argument.split(".")
    parents = {r[field] for r in tables[table].collect()}
    return sum(v not in parents for v in values)


@pytest.mark.parametrize("seed", range(2))
def test_random_tables_equal_a_plain_count(spark, seed):
    pick = random.Random(seed)
    some = lambda n: None if pick.random() < 0.2 else pick.randrange(n)
    tables = {
        name: spark.createDataFrame(
            [(some(30), some(9), some(9)) for _ in range(pick.randrange(5, 60))], "id int, a int, b int"
        )
        for name in ("x", "y", "z")
    }
    checks = [Check(t, c, kind) for t in tables for c in ("id", "a") for kind in ("unique", "not_null")]
    checks += [
        Check(t, c, "relationships", parent)
        for t in tables
        for c in ("a", "b")
        for parent in ("x.a", "y.id", "z.b")
    ]
    report = failures(tables, *checks)
    expected = {(c.table, c.column, c.label): plain_failures(tables, c) for c in checks}
    assert {key: n for key, (_, n) in report.items()} == expected
    assert all((status == "pass") == (n == 0) for status, n in report.values())


def test_each_table_is_scanned_once_and_keys_move_once(spark, tables, tmp_path):
    stored = {}
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    checks = [
        Check("child", "id", "unique"),
        Check("child", "amount", "not_null"),
        Check("parent", "id", "unique"),
        Check("child", "parent_id", "relationships", "parent.id"),
        Check("child", "id", "relationships", "parent.id"),
        Check("parent", "id", "relationships", "child.parent_id"),
    ]
    report = run_checks(stored, checks)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2
    assert plan.count("Exchange hashpartitioning") == 2
    assert sorted(r.failures for r in report.collect()) == [1, 1, 1, 1, 1, 3]


def test_hot_key_is_counted_before_it_moves(spark):
    child = spark.range(0, 100_000, 1, 4).select(F.lit(7).alias("parent_id"))
    parent = spark.range(0, 1000, 1, 4).select((F.col("id") * 2).cast("int").alias("id"))
    report = run_checks({"c": child, "p": parent}, [Check("c", "parent_id", "relationships", "p.id")])
    assert [tuple(r)[3:] for r in report.collect()] == [("fail", 100_000)]
    plan = report._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange hashpartitioning(set") :]
    assert "partial_count" in below or "partial_count_if" in below
