"""Every catalog query against its SQL oracle."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__
from cartwright.plans import catalog, oracle

QUERIES = catalog.queries()
ORACLES = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck(data):
    return compare.connect(data)


def test_each_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_every_query_is_registered():
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, data, duck, name):
    assert compare.difference(QUERIES[name](spark, data), duck, ORACLES[name]) is None


def test_entry_has_one_row(spark):
    assert __spark_entry__.entry(spark).count() == 1
