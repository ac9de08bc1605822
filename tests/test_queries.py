"""Every registered query against its SQL, over whole tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, duck

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, sf_dir, name):
    assert compare(spark, connection, sf_dir, name, QUERIES, ORACLES) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
