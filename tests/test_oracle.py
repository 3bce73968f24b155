from __future__ import annotations

import pytest
from oracle_compare import compare, connect

import __spark_entry__ as contract
from subsmart.plans.oracle import ORACLES
from subsmart.plans.registry import QUERIES


@pytest.fixture(scope="module")
def connection(folder):
    return connect(folder)


@pytest.mark.parametrize("key", list(contract.oracle_sql()))
def test_query_equals_sql(spark, folder, connection, key):
    sql = contract.oracle_sql()[key]
    assert compare(spark, connection, key, contract.queries()[key], sql, folder) == ""


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[:4] == ["account_id", "product_id", "tier_id", "financial_month"]
    assert df.count() > 0
