"""Every query against its SQL counterpart on the smallest data set."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from starwright.catalog.queries import QUERIES
from tests.conftest import SMALL
from tools.check_oracles import compare, connect

WAREHOUSE = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_a_statement():
    assert set(WAREHOUSE) <= set(oracle_sql()) and set(WAREHOUSE) <= set(queries())


@pytest.mark.parametrize("name", WAREHOUSE)
def test_query_equals_statement(spark, duck, name):
    agreed, note = compare(spark, duck, SMALL, name)
    assert agreed, note


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
