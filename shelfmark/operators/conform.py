"""The member order fact: eligible order lines with canonical member ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.calendar import ReportCalendar
from shelfmark.conventions import Conventions
from shelfmark.functions import segments
from shelfmark.functions.windows import paid_before
from shelfmark.sources.tables import Warehouse

_ELIGIBILITY = ("source_channel", "sales_type", "order_type", "order_paid_date")
_IDENTITY = ("type_name", "type_value", "member_ref", "parent_order_id")

VALID_MEMBER_ORDER = "is_member_order AND is_effective"


def eligible_channels(conv: Conventions, channels: Sequence[str]) -> str:
    """Listed channels; store lines of a countable sales type, online lines of normal orders.
    An unknown sales type is not countable."""
    listed = f"source_channel IN ({segments.text_list(channels)})"
    store = f"(source_channel = '{conv.store_channel}' AND sales_type <> {conv.excluded_store_sales_type})"
    online = (
        f"(source_channel IN ({segments.text_list(conv.online_channels)})"
        f" AND order_type = '{conv.normal_order_type}')"
    )
    return f"{listed} AND ({store} OR {online})"


def eligible_channel_filter(lines: DataFrame, conv: Conventions, channels: Sequence[str]) -> DataFrame:
    return lines.filter(eligible_channels(conv, channels))


def valid_member_order_filter(lines: DataFrame) -> DataFrame:
    return lines.filter(VALID_MEMBER_ORDER)


def matching_key(column: str, spread: Sequence[str]) -> str:
    """SQL for a join key in which rows without ``column`` match nothing and spread evenly.

    As NULL keys they would all hash to one task of an outer join, which AQE cannot split beside an
    aggregated side. They get a key no row has (a NUL byte and a hash of ``spread``, columns that the
    report reads anyway, so that none is read for this alone).
    """
    return f"coalesce(CAST({column} AS STRING), concat(chr(0), CAST(xxhash64({', '.join(spread)}) AS STRING)))"


def attach_member_bridge(lines: DataFrame, bridge: DataFrame) -> DataFrame:
    """Left join on the member reference; lines without one are spread."""
    keyed = bridge.withColumn("bridge_member_id", F.expr("CAST(member_id AS STRING)")).drop("member_id")
    own_key = matching_key("member_ref", ("parent_order_id", "type_value", "order_paid_date"))
    return lines.join(keyed, F.expr(f"{own_key} = bridge_member_id"), "left").drop("bridge_member_id")


def city_maturity(wh: Warehouse) -> DataFrame:
    """Distinct (city, maturity) of the cities that have a store.

    A city without a store and a store city without a maturity look the same to the caller
    (no maturity known), so a semi join is enough. It keeps the estimated size at that of the
    city list, by which Catalyst decides whether to broadcast it to the order lines.
    """
    kinds = wh.table("city_type", ["city", "city_type"])
    located = kinds.join(wh.table("store", ["city"]), "city", "left_semi")
    return located.selectExpr("city AS store_city", "city_type AS known_maturity").distinct()


def attach_city_maturity(lines: DataFrame, wh: Warehouse) -> DataFrame:
    """Maturity of the order's city and its tier, unknown values labelled."""
    kept = [c for c in lines.columns if c != "city_tier"]
    return lines.join(city_maturity(wh), F.expr("city = store_city"), "left").selectExpr(
        *kept,
        f"{segments.fill_city_tier('city_tier')} AS city_tier",
        f"{segments.fill_city_maturity('known_maturity')} AS city_maturity",
    )


def conform_order_lines(
    wh: Warehouse,
    cal: ReportCalendar,
    conv: Conventions,
    channels: Sequence[str],
    columns: Sequence[str],
    bridge: DataFrame | None = None,
    where: str = "TRUE",
) -> DataFrame:
    """Eligible lines paid before ``as_of`` with ``member_id`` (canonical) and
    ``member_detail_id``, plus the requested source columns and ``paid_date``.

    ``bridge`` may carry further per-member columns; they come along. ``where`` is a further
    condition on the source columns, applied before any join.
    """
    needed = list(dict.fromkeys([*_ELIGIBILITY, *_IDENTITY, *columns]))
    if bridge is None:
        bridge = wh.table("member_bridge", ["id", "member_id"])
    carried = [c for c in bridge.columns if c not in ("id", "member_id")]
    lines = wh.table("order_lines", needed).filter(
        f"{eligible_channels(conv, channels)} AND {paid_before('order_paid_date', cal)} AND {where}"
    )
    canonical = segments.canonical_member_id("type_name", "type_value", "id", conv.known_identity_types)
    return attach_member_bridge(lines, bridge).selectExpr(
        f"{canonical} AS member_id",
        "CAST(id AS STRING) AS member_detail_id",
        "CAST(order_paid_date AS DATE) AS paid_date",
        *dict.fromkeys(["parent_order_id", "order_paid_date", *columns]),
        *carried,
    )
