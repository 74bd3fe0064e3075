"""The refresh job, its targets and what it shares; plans that only stored tables show."""

import datetime as dt

import pytest

from shelfmark import Conventions
from shelfmark.operators.conform import matching_key
from shelfmark.operators.lifetime import first_orders, order_rank_flags
from shelfmark.operators.scorecard import scorecard
from shelfmark.plans.refresh import TARGETS, refresh_reports
from shelfmark.plans.registry import all_reports
from shelfmark.plans.scorecards import STORE_BY_PRICE
from shelfmark.sources.fixtures import FIXTURE_CALENDAR, FixtureWarehouse
from shelfmark.sources.sinks import create_table_as, ordered_refresh, refresh_together
from shelfmark.sources.tables import CatalogWarehouse, latest_snapshot, source_quality
from tests.conftest import TESTDATA, TableWarehouse
from tests.test_scale import ALWAYS_SPLIT, big_table_plans, executed_plan  # noqa: F401

FOLDER = f"{TESTDATA}/sf0.001"
CONV = Conventions()


@pytest.fixture(scope="module")
def wh(spark):
    return FixtureWarehouse(spark, FOLDER)


def test_refresh_of_all_reports(spark, wh, tmp_path):
    """18 targets, folders and tables; the order fact is ranked once, whatever the number of readers."""
    targets = {name: str(tmp_path / name) for name in TARGETS}
    for name in ("store_by_price", "member_frequency_distribution"):
        spark.sql(f"DROP TABLE IF EXISTS refreshed_{name}")
        targets[name] = f"refreshed_{name}"
    asked = []

    class Counting(FixtureWarehouse):
        def table(self, name, columns):
            asked.append((name, "order_paid_time" in columns))
            return super().table(name, columns)

    result = refresh_reports(Counting(spark, FOLDER), FIXTURE_CALENDAR, CONV, targets)
    assert len(TARGETS) == 18 and set(result.shared) == {"member_fact", "order_member_lines", "member_base"}
    # Lines with their payment time: once for the ranks of all scorecards, once for the line report's journeys.
    assert asked.count(("order_lines", True)) == 2
    assert result.quality["order_lines"] > 0 and result.quality["lines_without_order"] == 0
    for name, target in targets.items():
        stored = spark.read.parquet(target) if "/" in target else spark.table(target)
        expected = all_reports()[name](wh, FIXTURE_CALENDAR, CONV)
        assert sorted(map(str, stored.collect())) == sorted(map(str, expected.collect())), name
    left = [p.name for p in tmp_path.iterdir() if "__" in p.name]
    assert left == [] and not [t.name for t in spark.catalog.listTables() if "__" in t.name]


def test_a_failing_report_leaves_all_targets(spark, wh, tmp_path):
    """The tenth of twelve fails while it is written: every target, new ones too, is as it was."""
    simple = lambda n: lambda *_: spark.range(n)
    broken = lambda *_: spark.range(5).selectExpr("CASE WHEN id = 3 THEN raise_error('tenth') ELSE id END AS id")
    first = {f"r{i}": simple(2) for i in range(11)}
    targets = {f"r{i}": str(tmp_path / f"r{i}") if i % 2 else f"together_{i}" for i in range(12)}
    for target in targets.values():
        if "/" not in target:
            spark.sql(f"DROP TABLE IF EXISTS {target}")
    refresh_reports(wh, FIXTURE_CALENDAR, CONV, {n: targets[n] for n in first}, first)
    second = {f"r{i}": broken if i == 9 else simple(4) for i in range(12)}
    with pytest.raises(Exception, match="tenth"):
        refresh_reports(wh, FIXTURE_CALENDAR, CONV, targets, second)
    read = lambda t: spark.read.parquet(t) if "/" in t else spark.table(t)
    assert [read(targets[f"r{i}"]).count() for i in range(11)] == [2] * 11
    assert not (tmp_path / "r11").exists()
    assert [p.name for p in tmp_path.iterdir() if "__" in p.name] == []
    refresh_reports(wh, FIXTURE_CALENDAR, CONV, targets, {n: simple(4) for n in targets})
    assert [read(t).count() for t in targets.values()] == [4] * 12


def test_a_failing_swap_is_taken_back(spark, tmp_path, monkeypatch):
    from shelfmark.sources import sinks

    targets = [str(tmp_path / f"t{i}") for i in range(4)]
    refresh_together(spark, {t: lambda: spark.range(1) for t in targets})
    swap, done = sinks._Replacement.swap, []

    def fails_third(self):
        if len(done) == 2:
            raise OSError("no rename")
        done.append(swap(self))

    monkeypatch.setattr(sinks._Replacement, "swap", fails_third)
    with pytest.raises(OSError, match="no rename"):
        refresh_together(spark, {t: lambda: spark.range(7) for t in targets})
    assert [spark.read.parquet(t).count() for t in targets] == [1] * 4
    assert len(list(tmp_path.iterdir())) == 4


def test_tables_keep_their_definition(spark):
    spark.sql("DROP TABLE IF EXISTS defined")
    create_table_as(spark.sql("SELECT 1 AS a, 'x' AS b"), "defined")
    refresh_together(spark, {"defined": lambda: spark.sql("SELECT 'y' AS b, 2 AS a")})
    assert [tuple(r) for r in spark.table("defined").collect()] == [(2, "y")]
    with pytest.raises(ValueError, match="defined"):
        refresh_together(spark, {"defined": lambda: spark.sql("SELECT 3 AS a")})
    assert [tuple(r) for r in spark.table("defined").collect()] == [(2, "y")]


def test_order_survives_storage(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "CAST(id * 37 % 100 AS INT) AS sold", "concat('n', id % 7) AS name")
    target = str(tmp_path / "ordered")
    ordered_refresh(rows, target, "sold DESC, name, id", files=5)
    stored = spark.read.parquet(target)
    assert len(list((tmp_path / "ordered").glob("*.parquet"))) > 1
    got = [(r.sold, r.name, r.id) for r in stored.orderBy("row_rank").collect()]
    assert got == sorted(got, key=lambda r: (-r[0], r[1], r[2]))
    assert sorted(r.row_rank for r in stored.collect()) == list(range(1, 1001))
    ordered_refresh(rows.limit(0), str(tmp_path / "none"), "sold DESC")
    assert spark.read.parquet(str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize(("table", "key", "report"), [("product", "sku_id", "store_by_price"), ("city_type", "city", "store_by_line")])
def test_a_repeated_master_key_stops_the_report(spark, wh, tmp_path, table, key, report):
    from shelfmark.sources.tables import SCHEMAS

    locations = {}
    for name, schema in SCHEMAS.items():
        columns = [c.strip().split(" ")[0] for c in schema.replace("(18,2)", "").split(",")]
        df = wh.table(name, columns)
        df = df.unionAll(df.orderBy(key).limit(1)) if name == table else df
        df.write.parquet(str(tmp_path / name))
        locations[name] = str(tmp_path / name)
    repeated = wh.table(table, [key]).agg({key: "min"}).first()[0]
    stored = CatalogWarehouse(spark, locations, calendar=FIXTURE_CALENDAR)
    with pytest.raises(Exception, match=f"{table}: repeated {key} {repeated}"):
        all_reports()[report](stored, FIXTURE_CALENDAR, CONV).collect()
    with pytest.raises(Exception, match="repeated"):
        refresh_reports(stored, FIXTURE_CALENDAR, CONV, {report: str(tmp_path / "target")})
    assert not (tmp_path / "target").exists()


def test_source_quality(spark, wh):
    fixtures = wh

    class Dirty:
        def __init__(self):
            self.spark = spark

        def table(self, name, columns):
            df = fixtures.table(name, columns)
            if name == "store_sales":
                df = df.limit(10).unionAll(spark.sql("SELECT CAST(NULL AS STRING), CAST(NULL AS DATE)"))
            if name == "order_lines":
                df = df.limit(20).unionAll(spark.sql("SELECT NULL, NULL, TIMESTAMP_NTZ'2001-01-01' UNION ALL SELECT 'o', 'm', NULL"))
            if name == "member":
                df = df.limit(5).unionAll(spark.sql("SELECT 'M-7' UNION ALL SELECT NULL"))
            return df

    figures = source_quality(Dirty(), FIXTURE_CALENDAR).first().asDict()
    assert figures == {
        "sales_rows": 11, "sales_without_date": 1, "sales_without_order": 1,
        "order_lines": 22, "lines_without_date": 1, "lines_without_order": 1, "lines_without_member": 1,
        "members": 7, "members_without_number": 1,
    }


def test_only_the_newest_partition_is_read(spark, tmp_path):
    rows = spark.range(300).selectExpr("id", "date_add(DATE'2001-01-01', CAST(id % 30 AS INT)) AS update_date")
    rows.write.partitionBy("update_date").parquet(str(tmp_path / "snapshots"))
    df = latest_snapshot(spark.read.parquet(str(tmp_path / "snapshots")), "update_date")
    assert {r.update_date for r in df.collect()} == {dt.date(2001, 1, 30)} and df.count() == 10
    plan = df._jdf.queryExecution().executedPlan()
    scans = [s for s in plan.toString().split("\n") if "FileScan" in s and "PartitionFilters: [isnotnull(update_date" in s]
    assert scans and "Subquery" in scans[0]


def test_gaps_scan_the_lines_once(spark):
    plan = executed_plan(all_reports()["repurchase_gap_distribution"](FixtureWarehouse(spark, FOLDER), FIXTURE_CALENDAR, CONV))
    assert sum("FileScan" in line and "l_orderkey" in line for line in plan.split("\n")) == 1


def entries(spark):
    """A dominant member, unidentified ones, equal instants, orders of several members, unknown times."""
    return spark.range(4000).selectExpr(
        "CAST(id % 2900 AS STRING) AS parent_order_id",
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE CAST(id % 90 AS STRING) END AS member_id",
        "CASE WHEN id % 41 <> 5 THEN TIMESTAMP_NTZ'2001-01-01 23:59:30.25' + make_dt_interval(0, 0, 0, id % 7 * 1800) END AS order_paid_time",
    ).groupBy("parent_order_id", "member_id").agg({"order_paid_time": "min"}).toDF("parent_order_id", "member_id", "first_paid_time")


def test_first_orders(spark):
    rows = entries(spark)
    ranked = rows.selectExpr(
        "*",
        "row_number() OVER (PARTITION BY member_id ORDER BY first_paid_time,"
        " substring(md5(parent_order_id), 1, 8), parent_order_id) AS rk",
    )
    columns = ["parent_order_id", "member_id"]
    expected = ranked.filter("rk = 1").select(columns).collect()
    assert sorted(map(str, first_orders(rows).select(columns).collect())) == sorted(map(str, expected))
    flags = ranked.groupBy("parent_order_id").agg({"*": "count"}).count()
    assert order_rank_flags(rows).count() == flags
    assert order_rank_flags(rows).agg({"n_first": "sum"}).first()[0] == len(expected)


@pytest.mark.parametrize("column", ["parent_order_id", "member_ref"])
def test_lines_without_a_key_are_spread(spark, wh, request, column):
    """A third of the lines without order or member: the figures of the twin's rule, whatever the join,
    and no task that gets them all."""
    from shelfmark.sources.tables import SCHEMAS

    columns = [c.strip().split(" ")[0] for c in SCHEMAS["order_lines"].replace("(18,2)", "").split(",")]
    gone = f"CASE WHEN crc32(CAST(concat(parent_order_id, sku_id) AS BINARY)) % 3 > 0 THEN {column} END"
    lines = wh.table("order_lines", columns).selectExpr(*[f"{gone} AS {c}" if c == column else c for c in columns]).cache()

    class Gaps(TableWarehouse):
        def table(self, name, wanted):
            return lines.select(*wanted) if name == "order_lines" else wh.table(name, wanted)

    def run():
        return scorecard(Gaps(spark, {}), FIXTURE_CALENDAR, CONV, STORE_BY_PRICE)

    plain = sorted(map(str, run().collect()))
    request.getfixturevalue("big_table_plans")
    assert sorted(map(str, run().collect())) == plain
    spread = {"parent_order_id": ("sku_id", "order_paid_date"), "member_ref": ("parent_order_id", "type_value", "order_paid_date")}
    keyed = lines.filter(f"{column} IS NULL").selectExpr(f"pmod(hash({matching_key(column, spread[column])}), 20) AS p")
    sizes = [r["count"] for r in keyed.groupBy("p").count().collect()]
    assert len(sizes) == 20 and max(sizes) < 2 * sum(sizes) / 20
