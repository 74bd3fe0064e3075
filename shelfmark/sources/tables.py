"""Input tables and how they are read."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfmark.calendar import ReportCalendar

# Columns each input table must offer, with their types.
SCHEMAS: dict[str, str] = {
    "store_sales": (
        "parent_order_id string, sku_id string, sku_name string, product_line string, "
        "date_id string, sale_date date, sales_qty double, order_amt decimal(18,2), "
        "bu_launch_date date, store_launch_date date"
    ),
    "order_lines": (
        "order_paid_time timestamp_ntz, order_paid_date timestamp_ntz, type_name string, "
        "type_value string, parent_order_id string, sku_id string, product_line string, "
        "sales_qty double, is_effective boolean, is_member_order boolean, "
        "order_amt decimal(18,2), source_channel string, sales_type int, order_type string, "
        "city_tier string, city string, member_ref string"
    ),
    "member_bridge": "id bigint, member_id string",
    "member": (
        "member_detail_id string, join_time timestamp_ntz, reg_channel string, tier_code string, "
        "gender int, birthday date, beneficiary_birthday date, has_kid int"
    ),
    "birthday_history": "member_detail_id string, birthday_year int, person_type int",
    "product": (
        "sku_id string, sku_name string, product_line string, age_mark string, "
        "rsp decimal(18,2), bu_launch_date date, store_launch_date date"
    ),
    "store": "city string",
    "city_type": "city string, city_type string",
    "sku_plan": (
        "sku_id string, plan_year int, plan_month int, plan_qty bigint, "
        "review_channel string, plan_version string"
    ),
    "line_similarity": "line1 string, line2 string, cosine_similarity double, rank int, update_date date",
    "line_age_similarity": (
        "line_age1 string, line_age2 string, cosine_similarity double, rank int, update_date date"
    ),
    "profile_events": "event_id bigint, profile_id bigint, prop_key string, prop_value string, update_time timestamp_ntz",
}


#: Masters and the key that must be unique, or joins to them would repeat lines.
UNIQUE = {"product": "sku_id", "city_type": "city"}


class Warehouse(Protocol):
    """Anything that hands out the tables of ``SCHEMAS`` by name."""

    spark: SparkSession

    def table(self, name: str, columns: Sequence[str]) -> DataFrame:
        """The named table, reduced to ``columns``."""
        ...


def load_table(spark: SparkSession, location: str) -> DataFrame:
    """A catalog table, or a Parquet folder when ``location`` is a path."""
    if "/" in location:
        return spark.read.parquet(location)
    return spark.table(location)


class CatalogWarehouse:
    """Tables of a real deployment: table name -> catalog name or Parquet path.

    ``renames`` maps a table's own column names to ours, per table. Columns of another type
    than ``SCHEMAS`` declares are cast to it (money to decimal, whatever the table stores).

    Where a sales table has only the ISO text ``date_id``, ``sale_date`` is derived from it; a
    malformed text gives NULL, which lies in no window. ISO text sorts like dates, so with a
    ``calendar`` the two years its reports can touch also become a range on the text itself,
    which reaches the scan.

    Reports join their lines to ``UNIQUE`` masters; a repeated key there stops the query and is named.
    """

    def __init__(
        self,
        spark: SparkSession,
        locations: Mapping[str, str],
        renames: Mapping[str, Mapping[str, str]] | None = None,
        calendar: ReportCalendar | None = None,
    ):
        self.spark = spark
        self._locations = dict(locations)
        self._renames = dict(renames or {})
        self._calendar = calendar

    def table(self, name: str, columns: Sequence[str]) -> DataFrame:
        df = load_table(self.spark, self._locations[name])
        df = df.withColumnsRenamed(dict(self._renames.get(name, {})))
        if name == "store_sales" and "sale_date" in columns and "sale_date" not in df.columns:
            if self._calendar is not None:
                first = min(self._calendar.ly_start, dt.date(self._calendar.year - 1, 1, 1))
                end = dt.date(self._calendar.year + 1, 1, 1)
                df = df.filter(f"date_id >= '{first}' AND date_id < '{end}'")
            df = df.withColumn("sale_date", F.expr("CAST(try_to_timestamp(date_id, 'yyyy-MM-dd') AS DATE)"))
        if name in UNIQUE and UNIQUE[name] in columns:
            df = with_unique(df, UNIQUE[name], name)
        return _typed(df.select(*columns), name)


def _typed(df: DataFrame, name: str) -> DataFrame:
    """Columns as ``SCHEMAS`` types them; those that already are stay bare, so that filters reach the scan."""
    declared = {f.name: f.dataType for f in StructType.fromDDL(SCHEMAS[name])}
    return df.select(
        *[
            F.col(f.name).cast(declared[f.name]).alias(f.name)
            if declared.get(f.name, f.dataType) != f.dataType
            else F.col(f.name)
            for f in df.schema
        ]
    )


def check_unique(df: DataFrame, keys: Sequence[str], table: str = "", show: int = 10) -> None:
    """Raise if rows of ``df`` share a (known) key, naming the first such keys."""
    known = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    repeated = df.filter(known).groupBy(*keys).count().filter("count > 1").orderBy(*keys).limit(show).collect()
    if repeated:
        raise ValueError(f"repeated keys {keys} {table}: {[tuple(r)[: len(keys)] for r in repeated]}")


def with_unique(df: DataFrame, key: str, table: str) -> DataFrame:
    """``df``, whose plan stops with an error that names a (known) key if rows share one.

    The repeated key is a scalar subquery over the keys alone: it is found once a query, before the rows
    are read, and leaves the rows' own partitioning as it is.
    """
    repeated = df.filter(f"{key} IS NOT NULL").groupBy(key).count().filter("count > 1").agg(F.min(key)).scalar()
    message = F.concat(F.lit(f"{table}: repeated {key} "), repeated.cast("string"))
    return df.filter(F.when(repeated.isNull(), True).otherwise(F.raise_error(message).cast("boolean")))


def source_quality(wh: Warehouse, cal: ReportCalendar) -> DataFrame:
    """One row of counts over the source tables: rows a report cannot place, by reason."""
    sales = wh.table("store_sales", ["parent_order_id", "sale_date"]).agg(
        F.expr("count(*) AS sales_rows"),
        F.expr("count_if(sale_date IS NULL) AS sales_without_date"),
        F.expr("count_if(parent_order_id IS NULL) AS sales_without_order"),
    )
    lines = wh.table("order_lines", ["parent_order_id", "member_ref", "order_paid_date"]).agg(
        F.expr("count(*) AS order_lines"),
        F.expr("count_if(order_paid_date IS NULL) AS lines_without_date"),
        F.expr("count_if(parent_order_id IS NULL) AS lines_without_order"),
        F.expr("count_if(member_ref IS NULL) AS lines_without_member"),
    )
    number = "member_detail_id IS NOT NULL AND try_cast(member_detail_id AS BIGINT) IS NULL"
    members = wh.table("member", ["member_detail_id"]).agg(
        F.expr("count(*) AS members"), F.expr(f"count_if({number}) AS members_without_number")
    )
    return sales.join(lines, F.lit(True)).join(members, F.lit(True))


def latest_snapshot(df: DataFrame, date_col: str, by: DataFrame | None = None) -> DataFrame:
    """Rows of the newest snapshot; ``by`` names another table that supplies the date.

    The date is an uncorrelated scalar subquery, evaluated once on the executors.
    """
    source = df if by is None else by
    newest = source.agg(F.max(date_col)).scalar()
    return df.filter(F.col(date_col) == newest)
