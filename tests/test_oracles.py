"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from cashweave.registry import registered
from compare import connect, difference
from oracle import sql

DIRECTORY = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    with connect(DIRECTORY) as con:
        yield con


def test_every_query_has_sql():
    assert set(registered()) == set(sql.oracles())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(registered()))
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, DIRECTORY)
    assert difference(df, duck, contract.oracle_sql()[name]) is None


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[:3] == ["sku_id", "account_number", "merchant"]
    assert df.count() > 0
