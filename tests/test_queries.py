"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from checks import oracle, queries as registered
from checks.compare import connect, differences

SMALL = "/root/testdata/sf0.001"
NAMES = list(registered.build())


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(registered.build()) == set(oracle.build())
    assert set(registered.build()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    got = entry.queries()[name](spark, SMALL).toPandas()
    assert len(got) > 0
    assert differences(got, duck.execute(entry.oracle_sql()[name]).df()) == ""


def test_entry(spark):
    assert entry.entry(spark).count() == 16
