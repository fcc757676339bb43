"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check import compare, duck
from lakestrata import queries as registered

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_sql():
    assert set(registered.queries()) == set(registered.oracle_sql())


def test_entry(spark):
    found = entry.entry(spark)
    assert found.columns == ["state", "purchases"]
    found.collect()


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query(spark, con, name):
    verdict = compare(spark, con, SMALL, entry.queries()[name], entry.oracle_sql()[name])
    assert verdict is None
