"""Lifetime order ranks, first orders and gaps between purchases.

Ranks order a member's orders by first payment. Ties are broken by the first eight digits of
``md5(order id)``, then the id: an arbitrary but fixed choice that also cuts equal instants
into evenly sized, correctly ordered slots, so that no member has to be ranked in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIE = "substring(md5(parent_order_id), 1, 8)"
SLOT_DIGITS = 3  # 4,096 slots per instant


# Numbers that order as time and tie do, so that an extremum needs no text in an aggregation buffer.
_TIE_NUMBER = f"CAST(conv({TIE}, 16, 10) AS BIGINT)"
_MICROS = (
    "(CAST(unix_date(CAST(first_paid_time AS DATE)) AS BIGINT) * 86400000000L + hour(first_paid_time) * 3600000000L"
    " + minute(first_paid_time) * 60000000L + CAST(extract(SECOND FROM first_paid_time) * 1000000L AS BIGINT))"
)
_PLACE = (
    f"CAST(coalesce({_MICROS}, -9000000000000000000) AS DECIMAL(20,0)) * CAST(4294967296 AS DECIMAL(10,0))"
    f" + CAST(coalesce({_TIE_NUMBER}, -1) AS DECIMAL(10,0))"
)


def first_paid_time(valid: DataFrame, items: Sequence[str] = ()) -> DataFrame:
    """One row per (order, member): earliest payment.

    Each of ``items`` (columns ``low_x`` and ``high_x`` of numbers, as ``item_range`` makes them) is
    carried along as the range over the rows.
    """
    ranges = [e for i in items for e in (f"min(low_{i}) AS low_{i}", f"max(high_{i}) AS high_{i}")]
    return valid.groupBy("parent_order_id", "member_id").agg(
        *map(F.expr, ["min(order_paid_time) AS first_paid_time", *ranges])
    )


def item_range(item: str, name: str) -> list[str]:
    """SQL for a 64-bit number of an item as ``low_`` and ``high_`` column: rows hold two different known
    items where the lowest number is below the highest (equal numbers of different items: one in 10^19)."""
    number = f"CASE WHEN {item} IS NOT NULL THEN xxhash64({item}) END"
    return [f"{number} AS low_{name}", f"{number} AS high_{name}"]


def first_orders(entries: DataFrame) -> DataFrame:
    """The first order of each member, as ``(parent_order_id, member_id)``.

    Time and tie are one number, whose minimum per member combines map-side in a hash aggregation, so a
    member (or the group of unidentified members) with a large share of all orders costs no more than any
    other. Only the entries that have that number, nearly always one a member, are sorted by order id.
    """
    placed = entries.selectExpr("parent_order_id", "member_id", f"{_PLACE} AS place")
    lowest = placed.groupBy(F.expr("member_id AS of_member")).agg(F.expr("min(place) AS lowest"))
    candidates = placed.join(lowest, F.expr("member_id <=> of_member AND place = lowest"))
    best = "row_number() OVER (PARTITION BY member_id, place ORDER BY parent_order_id) AS turn"
    return candidates.selectExpr("parent_order_id", "member_id", best).filter("turn = 1").drop("turn")


def order_rank_flags(entries: DataFrame, items: Sequence[str] = ()) -> DataFrame:
    """Per order: how many members have it ranked, and for how many it is the first order.

    Only "first or later" is needed by the scorecards, and the first order is a minimum.
    """
    ranges = [f"{side}_{i}" for i in items for side in ("low", "high")]
    none = [f"CAST(NULL AS BIGINT) AS {r}" for r in ranges]
    votes = entries.selectExpr("parent_order_id AS ranked_order_id", "0 AS firsts", "1 AS entries", *ranges).unionAll(
        first_orders(entries).selectExpr("parent_order_id", "1", "0", *none)
    )
    several = [f"min(low_{i}) < max(high_{i}) AS several_{i}" for i in items]
    return votes.groupBy("ranked_order_id").agg(
        *map(
            F.expr,
            [
                "CAST(sum(firsts) AS INT) AS n_first",
                "CAST(sum(entries) - sum(firsts) AS INT) AS n_repeat",
                *several,
            ],
        )
    )


def lifetime_order_rank(entries: DataFrame) -> DataFrame:
    """Exact rank of every (order, member) row within its member.

    Members are cut into hours, hours into cells of one instant and one slot. Rows are
    numbered inside their cell; the rows of earlier cells and earlier hours are added from
    counts. A window never holds more than one cell's rows, one hour's cells, or one
    member's hours, and everything is a function of the data, so a lost executor's part is
    recomputed to the same ranks.
    """
    placed = entries.selectExpr(
        "parent_order_id",
        "member_id",
        "first_paid_time",
        "date_trunc('HOUR', first_paid_time) AS hour",
        f"{TIE} AS tie",
        f"substring({TIE}, 1, {SLOT_DIGITS}) AS slot",
    )
    cell = ["member_id", "hour", "first_paid_time", "slot"]
    cells = (
        placed.groupBy(*cell)
        .agg(F.expr("count(*) AS n"))
        .selectExpr(
            *cell,
            "n",
            "coalesce(sum(n) OVER (PARTITION BY member_id, hour ORDER BY first_paid_time, slot"
            " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_in_hour",
        )
    )
    hours = (
        cells.groupBy("member_id", "hour")
        .agg(F.expr("sum(n) AS n"))
        .selectExpr(
            "member_id AS h_member",
            "hour AS h_hour",
            "coalesce(sum(n) OVER (PARTITION BY member_id ORDER BY hour"
            " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_hours",
        )
    )
    offsets = cells.join(hours, F.expr("member_id <=> h_member AND hour <=> h_hour")).selectExpr(
        *[f"{c} AS c_{c}" for c in cell], "before_in_hour + before_hours AS earlier"
    )
    same_cell = " AND ".join(f"{c} <=> c_{c}" for c in cell)
    return (
        placed.selectExpr(
            "*",
            f"row_number() OVER (PARTITION BY {', '.join(cell)} ORDER BY tie, parent_order_id) AS in_cell",
        )
        .join(offsets, F.expr(same_cell))
        .selectExpr(
            "parent_order_id", "member_id", "first_paid_time", "CAST(earlier + in_cell AS BIGINT) AS rk"
        )
    )


def two_order_days(lines: DataFrame) -> DataFrame:
    """``(member_id, days)`` of the members with exactly two valid orders: all their distinct payment days,
    in order. A member has at most one entry for each day of the calendar."""
    valid = "coalesce(is_member_order AND is_effective, false) AND parent_order_id IS NOT NULL"
    marks = (
        "inline(array_compact(array(named_struct('day', paid_date, 'order_id', CAST(NULL AS STRING)),"
        f" CASE WHEN {valid} THEN named_struct('day', CAST(NULL AS DATE), 'order_id', parent_order_id) END)))"
    )
    per_member = lines.selectExpr("member_id", marks).distinct().groupBy("member_id")
    counted = per_member.agg(F.expr("count(order_id) AS orders"), F.expr("array_sort(collect_list(day)) AS days"))
    return counted.filter("orders = 2").select("member_id", "days")


def previous_purchase_date(members: DataFrame) -> DataFrame:
    """One row per member and purchase day, with the member's purchase day before it."""
    gap = "named_struct('paid_date', day, 'prev_paid_date', CASE WHEN i > 0 THEN days[i - 1] END)"
    return members.selectExpr("member_id", f"inline(transform(days, (day, i) -> {gap}))")
