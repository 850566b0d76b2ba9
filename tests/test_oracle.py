"""Every query of the lakehouse against its SQL on DuckDB."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from oracle import compare, connect
from tillhouse.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    difference = compare(contract.queries()[name](spark, SF_DIR), con, contract.oracle_sql()[name])
    assert difference is None, difference


def test_entry_has_rows(spark):
    assert not contract.entry(spark).isEmpty()
