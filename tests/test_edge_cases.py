"""Reports over hostile hand-made tables, against the SQL twins on the same tables."""

import duckdb
import pytest

from shelfmark import Conventions
from shelfmark.operators.scorecard import scorecard
from shelfmark.oracle import line_report, reports, scorecards, views
from shelfmark.plans.registry import all_reports
from shelfmark.plans.scorecards import SCORECARDS
from shelfmark.sources.fixtures import FIXTURE_CALENDAR
from tests.conftest import TableWarehouse
from tests.edge_tables import make_tables, to_duckdb, to_spark

CONV = Conventions()
MEMBER_REPORTS = (
    "repurchase_gap_distribution member_line_count_distribution member_frequency_distribution "
    "member_sku_count_distribution portfolio_line_age portfolio_line_novelty portfolio_line_price "
    "lifetime_rank order_rank_counts basket_pairs basket_totals top_bundled initial_repurchase "
    "top_repurchased prior_purchase top_previous nth_purchase_shoppers member_base kid_age_flags "
    "member_profile city_maturity canonical_member_ids multi_item_orders"
).split()


def on_edge_tables(sql):
    """A twin with the derivations of its input tables replaced by the hand-made tables."""
    for name, (_, definition) in views.VIEWS.items():
        table = {"member": "member_view", "order_lines": "order_lines_view"}.get(name, name)
        sql = sql.replace(f"{name} AS (\n{definition}\n)", f"{name} AS (SELECT * FROM edge_{table})")
    return sql


@pytest.fixture(scope="module", params=[1, 2])
def edge(request, spark):
    tables = make_tables(request.param)
    connection = duckdb.connect()
    to_duckdb(connection, tables)
    yield TableWarehouse(spark, {n: df.cache() for n, df in to_spark(spark, tables).items()}), connection
    connection.close()


@pytest.mark.parametrize("name", [n for n in SCORECARDS if n != "store_by_line"])
def test_scorecards(edge, compare, name):
    warehouse, connection = edge
    df = scorecard(warehouse, FIXTURE_CALENDAR, CONV, SCORECARDS[name])
    compare(df, connection, on_edge_tables(scorecards.scorecard_twin(name)))


def test_line_scorecard(edge, compare):
    warehouse, connection = edge
    df = all_reports()["store_by_line"](warehouse, FIXTURE_CALENDAR, CONV)
    compare(df, connection, on_edge_tables(line_report.store_by_line_twin()))


@pytest.mark.parametrize("name", MEMBER_REPORTS)
def test_other_reports(edge, compare, name):
    warehouse, connection = edge
    df = all_reports()[name](warehouse, FIXTURE_CALENDAR, CONV)
    compare(df, connection, on_edge_tables(reports.ORACLE_SQL[name]))
