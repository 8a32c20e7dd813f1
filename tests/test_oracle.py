"""Every query of the catalog against its SQL on the smallest test data."""

import pytest
from check import compare, database

import __spark_entry__ as entry
from transit_engine.catalog.oracle import sql
from transit_engine.catalog.queries import registered

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return database(SF)


@pytest.mark.parametrize("name", sorted(registered()))
def test_query_equals_sql(spark, connection, name):
    equal, message = compare(spark, connection, name, SF)
    assert equal, message


def test_every_query_has_sql():
    assert set(registered()) == set(sql())
    assert set(registered()) <= set(entry.queries())


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0
