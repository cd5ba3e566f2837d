"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from peerglass.plans import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    diff, rows = differences(spark, duck, FOLDER, QUERIES[name], ORACLES[name])
    assert diff == ""
    assert rows > 0


def test_entry_gives_the_flagship(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["t", "company_id", "stage_reached"]
    assert df.count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_lists_all_queries():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())
