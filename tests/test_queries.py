"""Every registered query against its SQL twin on the smallest data set."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from shelfmark.plans import registry
from tests.conftest import TESTDATA

FOLDER = f"{TESTDATA}/sf0.001"
QUERIES, TWINS = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(TWINS)
    assert set(contract.queries()) >= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_twin(spark, connection, compare, name):
    compare(QUERIES[name](spark, FOLDER), connection, TWINS[name])


def test_entry(spark):
    assert contract.entry(spark).count() > 1
