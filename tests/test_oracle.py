"""Every registered query equals its SQL on the smallest benchmark tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle_check import DEFAULT_FOLDER, compare, connect
from tidemark.plans.catalog import QUERIES
from tidemark.plans.oracle import statements

pytestmark = pytest.mark.skipif(not os.path.isdir(DEFAULT_FOLDER), reason="benchmark tables are not here")


def test_every_query_of_the_operators_has_sql():
    assert set(QUERIES) == set(statements())
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(DEFAULT_FOLDER), DEFAULT_FOLDER, queries()[name], oracle_sql()[name]) is None
