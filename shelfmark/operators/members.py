"""Member-level bases and distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.calendar import ReportCalendar
from shelfmark.functions.measures import net_sales, safe_ratio
from shelfmark.functions.segments import capped_count_label
from shelfmark.functions.windows import in_calendar_year


def member_base(valid: DataFrame, cal: ReportCalendar) -> DataFrame:
    """Per canonical member: sales, average ticket, frequency, breadth, activity this year.

    Lines without a canonical member form one row whose frequency is NULL. Columns a report
    does not use are pruned before the aggregation.
    """
    aggregates = [
        f"{net_sales()} AS net",
        "count(DISTINCT parent_order_id) AS orders",
        "count(DISTINCT product_line) AS line_count",
        "count(DISTINCT sku_id) AS sku_count",
        f"max({in_calendar_year('order_paid_date', cal)}) AS active",
    ]
    return valid.groupBy("member_id").agg(*map(F.expr, aggregates)).selectExpr(
        "member_id",
        "CAST(net AS DOUBLE) AS member_sales",
        f"{safe_ratio('net', 'orders')} AS member_atv",
        "CASE WHEN member_id IS NOT NULL THEN orders END AS member_frequency",
        "line_count",
        "sku_count",
        "CASE WHEN member_id IS NOT NULL AND active THEN 1L END AS member_shopper_ytd",
    )


def share_of_total(value: str) -> str:
    """Share of the column's sum over all rows; for reports of a handful of rows only."""
    return safe_ratio(value, f"sum({value}) OVER ()")


def member_distribution(base: DataFrame, count_col: str, cap: int, label: str) -> DataFrame:
    """Members and their share per capped count.

    At most ``cap + 2`` rows leave the aggregation, so the total over them is a small window.
    """
    return (
        base.groupBy(F.expr(capped_count_label(count_col, cap)).alias(label))
        .agg(F.expr("count(member_id) AS members"), F.expr("sum(member_shopper_ytd) AS active"))
        .selectExpr(
            label,
            "members AS member_shopper_LTD",
            f"{share_of_total('members')} AS member_share",
            "active AS member_shopper_YTD",
            f"{safe_ratio('active', 'members')} AS share_purchased_YTD",
        )
    )


def new_members(members: DataFrame, condition: str) -> DataFrame:
    """Distinct ids of members who meet a joining condition."""
    return members.filter(condition).select("member_detail_id").distinct()
