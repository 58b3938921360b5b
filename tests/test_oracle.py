"""Every query with a SQL counterpart must return the same rows; the others must return rows."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from tests.compare import differences, duck

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = contract.oracle_sql()
SLOW = {"train_rf", "train_gbt", "model_comparison"}


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, connection, name):
    assert differences(contract.queries()[name](spark, FOLDER), connection, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(SQL) - SLOW))
def test_returns_rows(spark, name):
    assert contract.queries()[name](spark, FOLDER).count() > 0


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(contract.queries())


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"category", "n"}
