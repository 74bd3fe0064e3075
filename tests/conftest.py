import datetime as dt
import decimal
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfmark.session import local_session

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folders = {
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    session = local_session(cpus=4, memory="6g", name="tests", more=folders)
    yield session
    session.stop()


def plain(value):
    """A value in a form that compares equal across engines (floats to nine digits)."""
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, float):
        return f"{value:.9g}" if value else "0"
    if isinstance(value, decimal.Decimal):
        return str(value.normalize())
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return str(value)


def sorted_rows(columns, rows):
    order = sorted(columns)
    index = [columns.index(c) for c in order]
    return order, sorted(tuple(plain(row[i]) for i in index) for row in rows)


@pytest.fixture
def compare():
    """Assert that a DataFrame and a DuckDB statement give the same columns and rows."""

    def check(df, connection, sql):
        result = connection.execute(sql)
        expected_columns = [c[0] for c in result.description]
        got = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
        expected = sorted_rows(expected_columns, result.fetchall())
        assert got[0] == expected[0]
        assert got[1] == expected[1]

    return check


class TableWarehouse:
    """Hand-made input tables."""

    def __init__(self, spark, tables):
        self.spark = spark
        self.tables = tables

    def table(self, name, columns):
        return self.tables[name].select(*columns)
