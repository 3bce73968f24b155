from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest
from helpers import collected

from subsmart.schemas import SOURCES
from subsmart.sources import rejects

HEADER = "account_id,start_date,cancel_date,product,tier,monthly_cost,touchless_conversion"
GOOD = ["1,2020-01-01,,Sales,Pro,12.50,true", "2,2020-02-29,2020-03-01,,,,", '3,2020-01-01,,"a,b",Pro,7,false']
BAD = [
    ("x,2020-01-01,,Sales,Pro,1.00,true", ["account_id: not a bigint"]),
    ("4,2019-02-30,soon,Sales,Pro,1.00,true", ["start_date: not a date", "cancel_date: not a date"]),
    (",,,Sales,Pro,1.00,true", ["account_id: missing", "start_date: missing"]),
    ("5,2020-01-01,,Sales,Pro,free,maybe", ["monthly_cost: not a decimal(10,2)", "touchless_conversion: not a boolean"]),
    ("6,2020-01-01,,Sales,Pro,123456789.00,true", ["monthly_cost: not a decimal(10,2)"]),
    ("7,2020-01-01,,Sales,Pro,1.005,true", ["monthly_cost: not a decimal(10,2)"]),
    ("8,2020-01-01,,Sales,Pro,1.00,true,more,still more", ["malformed row"]),
]


@pytest.fixture
def routed(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    lines = [*GOOD, *(line for line, _ in BAD)]
    for i in range(2):
        (tmp_path / "raw" / f"part{i}.csv").write_text("\n".join([HEADER, *lines[i::2]]) + "\n")
    texts = rejects.read_text(spark, "subscriptions", str(tmp_path / "raw"), header="true")
    return rejects.route(spark, "subscriptions", texts, str(tmp_path / "out"))


def test_every_row_comes_out_once(routed):
    accepted, rejected = routed
    assert accepted.count() == len(GOOD) and rejected.count() == len(BAD)
    assert accepted.schema == SOURCES["subscriptions"] and rejected.schema == rejects.REJECTS
    assert collected(accepted, "account_id") == [
        (1, dt.date(2020, 1, 1), None, "Sales", "Pro", Decimal("12.50"), True),
        (2, dt.date(2020, 2, 29), dt.date(2020, 3, 1), None, None, None, None),
        (3, dt.date(2020, 1, 1), None, "a,b", "Pro", Decimal("7.00"), False),
    ]


def test_rejects_say_why_and_whence(routed):
    rows = {}
    for r in routed[1].collect():
        assert r.source == "subscriptions" and r.file.split("/")[-1].startswith("part")
        rows[r.raw if r.reasons == ["malformed row"] else tuple(json.loads(r.raw).values())] = r.reasons
    expected = {}
    for line, reasons in BAD:
        cells = tuple(cell or None for cell in line.split(","))
        expected[line if reasons == ["malformed row"] else cells] = reasons
    assert rows == expected


def test_report_counts_rows_by_reason(routed):
    report = {(r.column, r.check): (r.table, r.status, r.failures) for r in rejects.reject_report(routed[1], "subscriptions").collect()}
    assert report[("monthly_cost", "schema: monthly_cost: not a decimal(10,2)")] == ("subscriptions", "fail", 3)
    assert report[("", "schema: malformed row")] == ("subscriptions", "fail", 1)
    assert sum(n for _, _, n in report.values()) == sum(len(reasons) for _, reasons in BAD)


def test_sources_without_faults(spark, tmp_path):
    (tmp_path / "raw.csv").write_text("\n".join([HEADER, *GOOD]) + "\n")
    texts = rejects.read_text(spark, "subscriptions", str(tmp_path / "raw.csv"), header="true")
    accepted, rejected = rejects.route(spark, "subscriptions", texts, str(tmp_path / "out"))
    assert accepted.count() == 3 and rejected.isEmpty()
    assert [tuple(r) for r in rejects.reject_report(rejected, "subscriptions").collect()] == [
        ("subscriptions", "", "schema", "pass", 0)
    ]
    none = texts.limit(0)
    accepted, rejected = rejects.route(spark, "subscriptions", none, str(tmp_path / "none"))
    assert accepted.isEmpty() and rejected.isEmpty() and accepted.schema == SOURCES["subscriptions"]


def test_json_lines(spark, tmp_path):
    lines = ['{"id": 1, "name": "Ann", "signup_date": "2020-01-01", "nps": "5"}', '{"id": "one", "signup_date": "2020-01-01"}', '{"id": 2, ']
    (tmp_path / "raw.json").write_text("\n".join(lines))
    texts = rejects.read_text(spark, "accounts", str(tmp_path / "raw.json"), "json")
    accepted, rejected = rejects.route(spark, "accounts", texts, str(tmp_path / "out"))
    assert [(r.id, r.name, r.nps) for r in accepted.collect()] == [(1, "Ann", 5)]
    assert sorted(r.reasons for r in rejected.collect()) == [["id: not a bigint"], ["malformed row"]]


def test_typed_formats_are_refused(spark):
    with pytest.raises(ValueError, match="types of its own"):
        rejects.read_text(spark, "accounts", "nowhere", "parquet")


def test_routing_scans_once(spark, tmp_path, monkeypatch):
    (tmp_path / "raw.csv").write_text("\n".join([HEADER, *GOOD, *(line for line, _ in BAD)]) + "\n")
    texts = rejects.read_text(spark, "subscriptions", str(tmp_path / "raw.csv"), header="true")
    accepted, rejected = rejects.route(spark, "subscriptions", texts, str(tmp_path / "out"))
    for df in (accepted, rejected):
        assert "csv" not in df._jdf.queryExecution().executedPlan().toString().lower().replace("raw.csv", "")
