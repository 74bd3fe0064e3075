import datetime as dt

import pytest

from shelfmark import Conventions
from shelfmark.operators.similarity import top_by_stored_rank
from shelfmark.plans.registry import all_reports
from shelfmark.plans.reports import REPORTS
from shelfmark.plans.scorecards import SCORECARDS
from shelfmark.sources.fixtures import FIXTURE_CALENDAR, FixtureWarehouse
from shelfmark.sources.sinks import create_table_as, full_refresh
from shelfmark.sources.staging import has_shared_folder, stage
from shelfmark.sources.tables import SCHEMAS, CatalogWarehouse, check_unique, latest_snapshot, load_table
from tests.conftest import TESTDATA

FOLDER = f"{TESTDATA}/sf0.001"


@pytest.mark.parametrize("name", sorted(SCHEMAS))
def test_fixture_tables_follow_the_schemas(spark, name):
    columns = [c.strip().split(" ")[0] for c in SCHEMAS[name].replace("(18,2)", "").split(",")]
    assert FixtureWarehouse(spark, FOLDER).table(name, columns).columns == columns


def test_full_refresh_replaces_rows_by_name(spark):
    spark.sql("DROP TABLE IF EXISTS refreshed")
    full_refresh(spark.sql("SELECT 1 AS a, 'x' AS b"), "refreshed")
    full_refresh(spark.sql("SELECT 'y' AS b, 2 AS a UNION ALL SELECT 'z', 3"), "refreshed")
    assert sorted(map(tuple, spark.table("refreshed").select("a", "b").collect())) == [(2, "y"), (3, "z")]


def test_full_refresh_of_a_folder(spark, tmp_path):
    target = str(tmp_path / "report")
    for n in (3, 2):
        full_refresh(spark.range(n), target)
    assert load_table(spark, target).count() == 2


def test_create_table_as_replaces_the_definition(spark):
    create_table_as(spark.sql("SELECT 1 AS a"), "created")
    create_table_as(spark.sql("SELECT 'x' AS b"), "created")
    assert [tuple(r) for r in load_table(spark, "created").collect()] == [("x",)]


def test_catalog_warehouse_renames_and_dates(spark, tmp_path):
    spark.sql("SELECT 'o1' AS order_no, '2001-02-03' AS date_id").write.parquet(str(tmp_path / "sales"))
    wh = CatalogWarehouse(
        spark, {"store_sales": str(tmp_path / "sales")}, {"store_sales": {"order_no": "parent_order_id"}}
    )
    row = wh.table("store_sales", ["parent_order_id", "sale_date"]).first()
    assert tuple(row) == ("o1", dt.date(2001, 2, 3))


def test_full_refresh_refuses_other_columns(spark):
    create_table_as(spark.sql("SELECT 1 AS a, 2 AS b"), "guarded")
    for other in ("SELECT 3 AS a", "SELECT 3 AS a, 4 AS b, 5 AS extra"):
        with pytest.raises(ValueError, match="guarded is not refreshed"):
            full_refresh(spark.sql(other), "guarded")
    assert [tuple(r) for r in spark.table("guarded").collect()] == [(1, 2)]


def test_sales_dates_reach_the_scan(spark, tmp_path):
    rows = "VALUES ('o1', '2001-02-03', 1.5D), ('o2', 'no date', 2D), ('o3', '1990-01-01', 3D)"
    spark.sql(f"SELECT * FROM {rows} AS t(parent_order_id, date_id, order_amt)").write.parquet(str(tmp_path / "s"))
    wh = CatalogWarehouse(spark, {"store_sales": str(tmp_path / "s")}, calendar=FIXTURE_CALENDAR)
    df = wh.table("store_sales", ["parent_order_id", "sale_date", "order_amt"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date_id,2000-01-0" in plan or "GreaterThanOrEqual(date_id,1999-1" in plan
    assert [(r[0], r[1], str(r[2])) for r in df.collect()] == [("o1", dt.date(2001, 2, 3), "1.50")]


def test_check_unique(spark):
    rows = spark.sql("SELECT * FROM VALUES ('a'), ('b'), (NULL), (NULL) AS t(sku_id)")
    check_unique(rows, ["sku_id"])
    with pytest.raises(ValueError, match="'a'"):
        check_unique(rows.union(rows), ["sku_id"])


@pytest.fixture(scope="module")
def stored_tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stored")
    fixtures = FixtureWarehouse(spark, FOLDER)
    for name, schema in SCHEMAS.items():
        columns = [c.strip().split(" ")[0] for c in schema.replace("(18,2)", "").split(",")]
        fixtures.table(name, columns).write.parquet(str(folder / name))
    return {name: str(folder / name) for name in SCHEMAS}


@pytest.mark.parametrize("name", sorted({**REPORTS, **SCORECARDS, "store_by_line": None}))
def test_reports_run_on_stored_tables(spark, stored_tables, name):
    """The same report from derived tables and from tables written to Parquet."""
    report = all_reports()[name]
    expected = report(FixtureWarehouse(spark, FOLDER), FIXTURE_CALENDAR, Conventions())
    stored = CatalogWarehouse(spark, stored_tables, calendar=FIXTURE_CALENDAR)
    got = report(stored, FIXTURE_CALENDAR, Conventions())
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_latest_snapshot(spark):
    old, new = dt.date(2001, 1, 1), dt.date(2001, 2, 1)
    df = spark.createDataFrame([("a", old), ("b", new), ("c", new)], "k string, d date")
    assert sorted(r.k for r in latest_snapshot(df, "d").collect()) == ["b", "c"]
    other = spark.createDataFrame([(old,)], "d date")
    assert [r.k for r in latest_snapshot(df, "d", other).collect()] == ["a"]


def test_top_needs_a_first_neighbour(spark):
    rows = [("a", "x", 1), ("a", "y", 3), ("a", "z", 9), ("b", "x", 2)]
    df = spark.createDataFrame(rows, "i string, o string, rank int")
    assert [tuple(r) for r in top_by_stored_rank(df, "i", "o").collect()] == [("a", "x", None, "y", None, None)]


def test_stage_writes_to_the_shared_folder(spark):
    assert has_shared_folder(spark)
    staged = stage(spark.range(10).selectExpr("id", "id % 2 AS k"))
    assert "FileScan parquet" in staged._jdf.queryExecution().executedPlan().toString()
    assert staged.groupBy("k").count().count() == 2
