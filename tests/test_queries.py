"""Every registered query against its SQL, on the smallest sample."""

import pytest
from comparing import connect, spark_rows, sql_rows

import __spark_entry__ as entry
from catalog.oracle import ORACLE
from catalog.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    got = spark_rows(entry.queries()[name](spark, SF))
    expected = sql_rows(duck, entry.oracle_sql()[name])
    assert got[0] == expected[0]
    assert len(got[1]) == len(expected[1])
    assert got[1] == expected[1]
