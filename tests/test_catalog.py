"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import oracle

import __spark_entry__ as contract
from cotejo.plans import catalog

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(FOLDER)


def test_every_query_has_sql():
    assert set(catalog.ORACLES) == set(catalog.QUERIES)
    assert set(catalog.QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, connection, name):
    found = oracle.compare(contract.queries()[name](spark, FOLDER), contract.oracle_sql()[name], connection)
    assert found == []


def test_entry(spark):
    assert contract.entry(spark).count() > 0
