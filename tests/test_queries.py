"""Every registered query against its SQL, over the smallest test tables."""

import compare
import pytest

import __spark_entry__ as entry
from lakecat.bindings import TABLES

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(FOLDER, TABLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    assert compare.same(name, QUERIES[name](spark, FOLDER), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 5


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
