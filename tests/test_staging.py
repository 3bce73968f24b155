from __future__ import annotations

import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from helpers import collected

from subsmart.functions.keys import NULL_TEXT, surrogate_key
from subsmart.operators import staging
from subsmart.schemas import SOURCES
from subsmart.sources.raw import read_source, require_columns, source_table


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_key_is_md5_of_joined_texts(spark):
    df = spark.sql("select 'Pro' as t, cast(50 as decimal(10,2)) as c, cast(null as string) as n")
    row = df.select(surrogate_key("t", "c"), surrogate_key("n"), surrogate_key("t", "n")).first()
    assert tuple(row) == (md5("Pro-50.00"), md5(NULL_TEXT), md5(f"Pro-{NULL_TEXT}"))
    with pytest.raises(ValueError):
        surrogate_key()


def text_subscriptions(spark, cancel, cost):
    return spark.createDataFrame(
        [(1, "2020-01-01", cancel, "A", "Pro", cost, True)],
        "account_id long, start_date string, cancel_date string, product string, tier string,"
        " monthly_cost string, touchless_conversion boolean",
    )


def test_text_is_cast(spark):
    row = staging.stage_subscriptions(text_subscriptions(spark, "2020-02-02", "12.345")).first()
    assert (row.cancel_date, row.monthly_cost) == (dt.date(2020, 2, 2), Decimal("12.35"))


def test_bad_text_fails_unless_lenient(spark):
    raw = text_subscriptions(spark, "soon", "free")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stage_subscriptions(raw).collect()
    row = staging.stage_subscriptions(raw, lenient=True).first()
    assert (row.cancel_date, row.monthly_cost) == (None, None)


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="nps"):
        staging.stage_accounts(
            spark.sql("select 1L id, 'n' name, current_date signup_date, 'c' country, 'v' vertical")
        )
    with pytest.raises(ValueError, match="lacks columns"):
        require_columns(spark.range(1), "accounts")


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_sources_are_read_with_their_schema(spark, tmp_path, fmt):
    rows = [(1, "Ann", dt.date(2001, 5, 1), "FR", "Retail", 5), (2, None, None, None, None, None)]
    df = spark.createDataFrame(rows, SOURCES["accounts"])
    path = str(tmp_path / fmt)
    df.write.format(fmt).save(path)
    read = read_source(spark, "accounts", path, fmt)
    assert read.schema == SOURCES["accounts"]
    assert collected(read, "id") == rows


def test_source_from_a_catalog_name(spark):
    spark.createDataFrame([], SOURCES["accounts"]).createOrReplaceTempView("raw_accounts")
    assert source_table(spark, "accounts", "raw_accounts").columns == SOURCES["accounts"].names
