"""Every registered query with SQL equals that SQL on the same tables."""

from __future__ import annotations

import os

import parity
import pytest

import __spark_entry__ as contract

FOLDER = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.01")
SQL = contract.oracle_sql()
QUERIES = contract.queries()


@pytest.fixture(scope="module")
def con():
    return parity.connect(FOLDER)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_parity(spark, con, name):
    assert parity.compare(spark, con, FOLDER, name, QUERIES[name], SQL[name]) > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0
