"""Derives every input table from the generic order/part/customer Parquet tables.

Only the joins that feed a requested column are made, so each report reads what it needs.
No size is assumed for any of these tables: Catalyst broadcasts a side only when its
measured size is below the session's threshold and shuffles otherwise.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfmark.calendar import ReportCalendar
from shelfmark.functions import segments
from shelfmark.operators.lifetime import item_range

FIXTURE_CALENDAR = ReportCalendar.for_date(
    dt.date(2001, 7, 1),
    novelty_cutoff_ty=dt.date(2000, 12, 27),
    novelty_cutoff_ly=dt.date(1999, 12, 27),
)

# The columns of each derived table as expressions over the Parquet tables.
_BU_LAUNCH = """CASE WHEN p_partkey % 13 = 0 THEN NULL
  WHEN p_partkey % 4 = 0 THEN date_add(DATE'2000-12-20', CAST(p_partkey % 180 AS INT))
  WHEN p_partkey % 4 = 1 THEN date_add(DATE'1999-12-20', CAST(p_partkey % 180 AS INT))
  ELSE date_add(DATE'1996-01-01', CAST(p_partkey % 900 AS INT)) END"""

PRODUCT = {
    "sku_id": "CAST(p_partkey AS STRING)",
    "sku_name": "concat('SKU ', p_name)",
    "product_line": "CASE WHEN p_partkey % 97 <> 0 THEN p_brand END",
    "age_mark": """CASE WHEN p_size % 10 = 0 THEN NULL WHEN p_size % 10 = 1 THEN '1 1/2'
      WHEN p_size % 10 = 2 THEN 'all ages' WHEN p_size < 6 THEN concat(p_size, ' 1/2+')
      WHEN p_size < 20 THEN concat(p_size, '+') ELSE concat(' ', p_size, '-99 ') END""",
    "rsp": "CAST((p_retailprice - 900) * 12 AS DECIMAL(18,2))",
    "bu_launch_date": _BU_LAUNCH,
    "store_launch_date": f"date_add({_BU_LAUNCH}, 14)",
}

ORDER_LINES = {
    "order_paid_date": "o_orderdate",
    "order_paid_time": "o_orderdate + make_dt_interval(0, 0, 0, l_orderkey % 86400)",
    "type_name": "CASE o_custkey % 4 WHEN 0 THEN 'CRM' WHEN 1 THEN 'DY' WHEN 2 THEN 'TM' ELSE 'ANON' END",
    "type_value": "concat('ext-', o_custkey)",
    "parent_order_id": "CAST(l_orderkey AS STRING)",
    "sku_id": "CAST(l_partkey AS STRING)",
    "sales_qty": "CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END",
    "is_effective": "l_returnflag <> 'R'",
    "is_member_order": "o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')",
    "order_amt": "CAST(l_extendedprice AS DECIMAL(18,2))",
    "source_channel": """CASE WHEN o_orderkey % 10 = 9 THEN 'OTHER'
      WHEN o_orderstatus IN ('F', 'P') THEN 'STORE' WHEN o_orderkey % 2 = 0 THEN 'WEB_A' ELSE 'WEB_B' END""",
    "sales_type": "CASE WHEN l_linenumber = 7 THEN 3 ELSE 1 END",
    "order_type": "CASE WHEN l_linenumber = 6 THEN 'refund' ELSE 'normal' END",
    "city_tier": "CASE WHEN n_nationkey % 7 <> 0 THEN concat('Tier ', 1 + n_nationkey % 6) END",
    "city": "n_name",
    "member_ref": "CAST(o_custkey AS STRING)",
}

STORE_SALES = {
    "date_id": "date_format(order_paid_date, 'yyyy-MM-dd')",
    "sale_date": "CAST(order_paid_date AS DATE)",
}

_BIRTHDAY = """CASE WHEN c_custkey % 11 <> 0
  THEN date_add(DATE'1940-01-01', CAST(c_custkey * 97 % 21900 AS INT)) END"""

MEMBER = {
    "member_detail_id": "CAST(100000 + c_custkey AS STRING)",
    "join_time": "CAST(date_add(DATE'1999-07-01', CAST(c_custkey * 7 % 731 AS INT)) AS TIMESTAMP_NTZ)",
    "reg_channel": "CASE WHEN c_custkey % 3 <> 0 THEN 'STORE-APP' ELSE 'WEB' END",
    "tier_code": "c_mktsegment",
    "gender": "CAST(CASE WHEN c_custkey % 4 <> 3 THEN c_custkey % 4 END AS INT)",
    "birthday": _BIRTHDAY,
    "beneficiary_birthday": f"CASE WHEN c_custkey % 2 = 0 THEN {_BIRTHDAY} END",
    "has_kid": "CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END",
}

BIRTHDAY_HISTORY = {
    "member_detail_id": "CAST(100000 + c_custkey AS STRING)",
    "birthday_year": "CAST(CASE WHEN c_custkey % 3 = 0 THEN 1980 + c_custkey % 21 ELSE 1970 END AS INT)",
    "person_type": "CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 1 END",
}

SKU_PLAN = {
    "sku_id": "CAST(p_partkey AS STRING)",
    "plan_year": "2001",
    "plan_month": "plan_month",
    "plan_qty": "CAST(1 + (p_partkey * plan_month) % 20 AS BIGINT)",
    "review_channel": "CASE WHEN p_partkey % 3 = 0 THEN 'WEB' ELSE 'STORE,WEB' END",
    "plan_version": "CASE WHEN p_partkey % 10 = 1 THEN 'DP02' ELSE 'DP03' END",
}

CITY_TYPE = {
    "city": "n_name",
    "city_type": "CASE n_regionkey WHEN 0 THEN '1_mature' WHEN 1 THEN '2_core' ELSE '3_uprising' END",
}

PROFILE_EVENTS = {
    "profile_id": "user_id",
    "prop_key": "event_type",
    "prop_value": "CASE WHEN value < 50 THEN 'yes' ELSE 'no' END",
    "update_time": "ts",
    "event_id": "event_id",
}

# The two similarity snapshots.
SNAPSHOT_NEW, SNAPSHOT_OLD = "DATE'2001-06-30'", "DATE'2001-06-01'"


# Schemas read from Parquet footers, kept so that the same files are not inspected per query.
_FILE_SCHEMAS: dict[str, StructType] = {}


def _pick(made: dict[str, str], columns: Sequence[str]) -> list[str]:
    return [f"{made[c]} AS {c}" if c in made else c for c in columns]


class FixtureWarehouse:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._opened: dict[str, DataFrame] = {}

    def table(self, name: str, columns: Sequence[str]) -> DataFrame:
        return getattr(self, f"_{name}")(list(columns))

    def _read(self, name: str) -> DataFrame:
        if name not in self._opened:
            path = f"{self.folder}/{name}.parquet"
            if path not in _FILE_SCHEMAS:
                _FILE_SCHEMAS[path] = self.spark.read.parquet(path).schema
            self._opened[name] = self.spark.read.schema(_FILE_SCHEMAS[path]).parquet(path)
        return self._opened[name]

    def _product(self, columns: Sequence[str]) -> DataFrame:
        return self._read("part").selectExpr(*_pick(PRODUCT, columns))

    def _sku_plan(self, columns: Sequence[str]) -> DataFrame:
        months = self._read("part").selectExpr("p_partkey", "explode(sequence(1, 12)) AS plan_month")
        return months.selectExpr(*_pick(SKU_PLAN, columns))

    def _order_lines(self, columns: Sequence[str]) -> DataFrame:
        lines, orders = self._read("lineitem"), self._read("orders")
        base = lines.join(orders, F.expr("l_orderkey = o_orderkey"))
        from_product = [c for c in columns if c in PRODUCT and c not in ORDER_LINES]
        if from_product:
            product = self._product(["sku_id", *from_product]).withColumnRenamed("sku_id", "p_sku")
            base = base.join(product, F.expr("CAST(l_partkey AS STRING) = p_sku"), "left")
        if "city" in columns or "city_tier" in columns:
            customer = self._read("customer").select("c_custkey", "c_nationkey")
            nation = self._read("nation").select("n_nationkey", "n_name")
            base = base.join(customer, F.expr("o_custkey = c_custkey"), "left").join(
                nation, F.expr("c_nationkey = n_nationkey"), "left"
            )
        return base.selectExpr(*_pick(ORDER_LINES, columns))

    def _store_sales(self, columns: Sequence[str]) -> DataFrame:
        kept = [c for c in columns if c not in STORE_SALES]
        lines = self._order_lines([*kept, "order_paid_date", "source_channel", "sales_type"])
        return lines.filter("source_channel = 'STORE' AND sales_type <> 3").selectExpr(
            *_pick(STORE_SALES, columns)
        )

    def _member_bridge(self, columns: Sequence[str]) -> DataFrame:
        made = {"id": "100000 + c_custkey", "member_id": "CAST(c_custkey AS STRING)"}
        return self._member_customers().selectExpr(*_pick(made, columns))

    def _member_customers(self) -> DataFrame:
        return self._read("customer").filter("c_custkey % 10 <> 0")

    def _member(self, columns: Sequence[str]) -> DataFrame:
        return self._member_customers().selectExpr(*_pick(MEMBER, columns))

    def _birthday_history(self, columns: Sequence[str]) -> DataFrame:
        related = self._member_customers().filter("c_custkey % 3 <> 2")
        return related.selectExpr(*_pick(BIRTHDAY_HISTORY, columns))

    def _store(self, columns: Sequence[str]) -> DataFrame:
        nation = self._read("nation").filter("n_nationkey % 8 <> 5")
        located = self._read("supplier").join(nation, F.expr("s_nationkey = n_nationkey"))
        return located.selectExpr("n_name AS city").distinct()

    def _city_type(self, columns: Sequence[str]) -> DataFrame:
        return self._read("nation").filter("n_regionkey IN (0, 1, 2)").selectExpr(*_pick(CITY_TYPE, columns))

    def _line_similarity(self, columns: Sequence[str]) -> DataFrame:
        if list(columns) == ["update_date"]:
            # Both dates exist where any order has two different lines; no score is needed to tell.
            sold = self._store_sales(["parent_order_id", "product_line"]).selectExpr("parent_order_id", *item_range("product_line", "line"))
            pairs = sold.groupBy("parent_order_id").agg(F.expr("min(low_line) < max(high_line) AS paired")).filter("paired")
            dates = f"inline(array(named_struct('update_date', {SNAPSHOT_NEW}), named_struct('update_date', {SNAPSHOT_OLD})))"
            return pairs.selectExpr(dates).distinct()
        sales = self._store_sales(["parent_order_id", "product_line"])
        items = sales.selectExpr("parent_order_id", "product_line AS item").filter("item IS NOT NULL")
        return _similarity(items, "line1", "line2").select(*columns)

    def _line_age_similarity(self, columns: Sequence[str]) -> DataFrame:
        labels = (
            self._product(["sku_id", "product_line", "age_mark"])
            .filter(segments.is_rated("age_mark"))
            .selectExpr("sku_id", "product_line", f"{segments.min_age('age_mark')} AS years")
            .selectExpr("sku_id", f"product_line || ' ' || {segments.age_band('years')} AS item")
            .filter("item IS NOT NULL")
        )
        items = self._store_sales(["parent_order_id", "sku_id"]).join(labels, "sku_id")
        return _similarity(items, "line_age1", "line_age2").select(*columns)

    def _profile_events(self, columns: Sequence[str]) -> DataFrame:
        return self._read("events").selectExpr(*_pick(PROFILE_EVENTS, columns))


def _similarity(sales: DataFrame, left: str, right: str) -> DataFrame:
    """Cosine of shared orders for every pair of items, ranked, in two dated snapshots.

    Orders with the same set of items are counted first, so pairs are made once per distinct
    set rather than once per order.
    """
    patterns = (
        sales.groupBy("parent_order_id")
        .agg(F.expr("array_sort(collect_set(item)) AS items"))
        .groupBy("items")
        .agg(F.expr("count(*) AS n"))
    )
    pairs = (
        patterns.selectExpr("explode(items) AS a", "items", "n")
        .selectExpr("a", "explode(items) AS b", "n")
        .filter("a <> b")
        .groupBy("a", "b")
        .agg(F.expr("sum(n) AS shared"))
    )
    own = (
        patterns.selectExpr("explode(items) AS item", "n").groupBy("item").agg(F.expr("sum(n) AS orders"))
    )
    scored = (
        pairs.join(own.selectExpr("item AS a", "orders AS orders_a"), "a")
        .join(own.selectExpr("item AS b", "orders AS orders_b"), "b")
        .selectExpr("a", "b", "shared / sqrt(CAST(orders_a * orders_b AS DOUBLE)) AS cosine_similarity")
    )
    return scored.selectExpr(
        "*",
        "row_number() OVER (PARTITION BY a ORDER BY cosine_similarity DESC, b) AS new_rank",
        "row_number() OVER (PARTITION BY a ORDER BY cosine_similarity, b DESC) AS old_rank",
    ).selectExpr(
        f"a AS {left}",
        f"b AS {right}",
        "cosine_similarity",
        f"inline(array(named_struct('rank', new_rank, 'update_date', {SNAPSHOT_NEW}),"
        f" named_struct('rank', old_rank, 'update_date', {SNAPSHOT_OLD})))",
    )
