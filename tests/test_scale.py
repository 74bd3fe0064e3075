"""Plans and results under conditions that only large data brings."""

import re

import pytest

from shelfmark import Conventions
from shelfmark.operators.lifetime import first_paid_time, lifetime_order_rank
from shelfmark.operators.scorecard import ScorecardRun, valid_store_lines
from shelfmark.plans.registry import all_reports, queries
from shelfmark.plans.scorecards import STORE_BY_PRICE
from shelfmark.sources.fixtures import FIXTURE_CALENDAR, FixtureWarehouse
from tests.conftest import TESTDATA

FOLDER = f"{TESTDATA}/sf0.001"
ALWAYS_SPLIT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
}


@pytest.fixture
def big_table_plans(spark):
    """Nothing is small enough to broadcast and ordinary partitions count as skewed."""
    before = {k: spark.conf.get(k, None) for k in ALWAYS_SPLIT}
    for key, value in ALWAYS_SPLIT.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def executed_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["store_by_price", "store_by_line", "line_similarity_top5", "repurchase_gap_distribution"])
def test_results_do_not_depend_on_join_sides(spark, request, name):
    small = sorted(map(str, queries()[name](spark, FOLDER).collect()))
    request.getfixturevalue("big_table_plans")
    df = queries()[name](spark, FOLDER)
    plan = executed_plan(df)
    assert sorted(map(str, df.collect())) == small
    assert "BroadcastHashJoin" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scorecards_need_no_expand_and_no_sort_aggregate(spark):
    """Distinct counts of several columns neither multiply rows nor sort them to aggregate."""
    for name in ("store_by_price", "store_by_line_sku", "order_rank_counts", "multi_item_orders"):
        plan = executed_plan(queries()[name](spark, FOLDER))
        assert "Expand " not in plan and "SortAggregate" not in plan, name


def test_no_python_in_any_plan(spark):
    for name, query in queries().items():
        plan = query(spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan), name


def test_dates_and_columns_reach_the_scan(spark):
    plan = queries()["member_frequency_distribution"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    orders = next(line for line in plan.split("\n") if "FileScan" in line and "o_orderkey" in line)
    assert "LessThan(o_orderdate,2001-07-01" in orders
    lines = next(line for line in plan.split("\n") if "FileScan" in line and "l_orderkey" in line)
    assert "l_extendedprice" not in lines and "l_discount" not in lines


def test_rank_of_a_dominant_member(spark):
    """One member (and the unidentified ones) hold most orders, many at the same instant."""
    rows = spark.range(3000).selectExpr(
        "CAST(id AS STRING) AS parent_order_id",
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE CAST(id % 50 AS STRING) END AS member_id",
        "TIMESTAMP_NTZ'2001-01-01 00:00:00' + make_dt_interval(0, 0, 0, id % 7 * 1800) AS first_paid_time",
    )
    ranked = lifetime_order_rank(rows)
    expected = rows.selectExpr(
        "*",
        "row_number() OVER (PARTITION BY member_id ORDER BY first_paid_time,"
        " substring(md5(parent_order_id), 1, 8), parent_order_id) AS rk",
    )
    columns = ["parent_order_id", "member_id", "first_paid_time", "rk"]
    assert sorted(map(str, ranked.select(columns).collect())) == sorted(map(str, expected.select(columns).collect()))


def test_totals_cover_all_rows(spark):
    """Sales of all dimension rows, the unknown one included, add up to the total row."""
    for name in ("store_by_age", "store_by_price", "store_by_segment"):
        rows = queries()[name](spark, FOLDER).select("*").collect()
        total = [r for r in rows if r[0] == "TTL"]
        assert len(total) == 1
        assert sum(r.sales_rrp for r in rows if r[0] != "TTL") == total[0].sales_rrp
        for row in rows:
            for column, value in row.asDict().items():
                if column.endswith("shopper_share") and value is not None:
                    assert 0 <= value <= 1


def test_no_orders_at_all(spark):
    """Empty facts give an empty scorecard, not an error."""
    fixtures = FixtureWarehouse(spark, FOLDER)

    class Empty:
        def __init__(self):
            self.spark = spark

        def table(self, name, columns):
            df = fixtures.table(name, columns)
            return df.limit(0) if name in ("store_sales", "order_lines") else df

    report = all_reports()["store_by_price"](Empty(), FIXTURE_CALENDAR, Conventions())
    assert report.count() == 0
    assert first_paid_time(valid_store_lines(Empty(), FIXTURE_CALENDAR, Conventions())).count() == 0
