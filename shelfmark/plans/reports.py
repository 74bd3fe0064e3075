"""Member, assortment and similarity reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.calendar import ReportCalendar
from shelfmark.conventions import Conventions
from shelfmark.functions import segments
from shelfmark.functions.windows import in_calendar_year
from shelfmark.operators import members, products, similarity
from shelfmark.operators.conform import VALID_MEMBER_ORDER, conform_order_lines
from shelfmark.operators.lifetime import previous_purchase_date, two_order_days
from shelfmark.sources.shared import relation
from shelfmark.sources.tables import Warehouse, latest_snapshot

_MEASURED = ["sales_qty", "order_amt", "product_line", "sku_id"]


def line_similarity_top5(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    """Five most similar lines per line, best sellers of the year first."""
    scores = wh.table("line_similarity", ["line1", "line2", "rank", "update_date"])
    return _top5(wh, cal, latest_snapshot(scores, "update_date"), "line1", "line2", "product_line")


def line_age_similarity_top5(
    wh: Warehouse, cal: ReportCalendar, conv: Conventions, own_snapshot_date: bool = False
) -> DataFrame:
    """The same for line-and-age labels. The snapshot date is that of the line scores unless
    ``own_snapshot_date``; popularity is looked up by the whole label."""
    scores = wh.table("line_age_similarity", ["line_age1", "line_age2", "rank", "update_date"])
    by = None if own_snapshot_date else wh.table("line_similarity", ["update_date"])
    return _top5(wh, cal, latest_snapshot(scores, "update_date", by), "line_age1", "line_age2", "line_age")


def _top5(wh: Warehouse, cal: ReportCalendar, snapshot: DataFrame, item: str, other: str, name: str) -> DataFrame:
    top = similarity.top_by_stored_rank(snapshot, item, other).withColumnRenamed(item, name)
    sales = wh.table("store_sales", ["parent_order_id", "product_line", "sale_date"])
    sold = sales.filter(in_calendar_year("sale_date", cal)).withColumnRenamed("product_line", "line_sold")
    return similarity.order_by_popularity(top, name, sold, "line_sold")


def valid_omnichannel_lines(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    columns = [*_MEASURED, "is_member_order", "is_effective"]
    return conform_order_lines(wh, cal, conv, conv.all_channels, columns, where=VALID_MEMBER_ORDER)


def shared_member_base(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    return relation(wh, "member_base", lambda: members.member_base(valid_omnichannel_lines(wh, cal, conv), cal))


def member_frequency_distribution(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    """Members by number of orders, and how many of them bought this calendar year."""
    base = shared_member_base(wh, cal, conv)
    return members.member_distribution(base, "member_frequency", 5, "member_frequency")


def member_line_count_distribution(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    """Share of members by number of different product lines."""
    base = shared_member_base(wh, cal, conv)
    return members.member_distribution(base, "line_count", 5, "line_count").select("line_count", "member_share")


def member_sku_count_distribution(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    """Share of members by number of different SKUs."""
    base = shared_member_base(wh, cal, conv)
    return members.member_distribution(base, "sku_count", 10, "sku_count").select("sku_count", "member_share")


def purchase_days(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    """Distinct payment days, with the previous one, of members with exactly two valid orders.

    All eligible lines give days, returns and invalid orders included. One scan gives both: a line is a
    day and, if valid, an order of its member; equal ones merge before they meet at the member.
    """
    columns = ["is_member_order", "is_effective"]
    lines = conform_order_lines(wh, cal, conv, conv.all_channels, columns).filter("member_id IS NOT NULL")
    return previous_purchase_date(two_order_days(lines))


def repurchase_gap_distribution(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    """Members by days between their purchases, for members with exactly two orders."""
    gaps = purchase_days(wh, cal, conv).filter("prev_paid_date IS NOT NULL")
    bucket = segments.gap_bucket("datediff(paid_date, prev_paid_date)")
    return gaps.groupBy(F.expr(bucket).alias("repurchase_days")).agg(
        F.expr("count(DISTINCT member_id) AS member_shopper_count")
    )


def portfolio_line_age(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    """SKUs on sale this year by line and age band; rated SKUs only."""
    rated = wh.table("product", ["sku_id", "product_line", "age_mark"]).filter(segments.is_rated("age_mark"))
    selling = products.selling_this_year(rated, wh, cal)
    banded = selling.selectExpr("sku_id", "product_line", f"{segments.min_age('age_mark')} AS min_age").selectExpr(
        "sku_id", "product_line", f"{segments.age_band('min_age')} AS age_band"
    )
    return products.sku_distribution(banded, "product_line", "age_band")


def portfolio_line_novelty(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    """SKUs on sale this year by line and novelty (launched this year); rated SKUs only."""
    rated = wh.table("product", ["sku_id", "product_line", "age_mark", "bu_launch_date"]).filter(
        segments.is_rated("age_mark")
    )
    labelled = products.selling_this_year(rated, wh, cal).selectExpr(
        "sku_id", "product_line", f"{segments.novelty_in_year('bu_launch_date', cal.year)} AS novelty"
    )
    return products.sku_distribution(labelled, "product_line", "novelty")


def portfolio_line_price(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    """SKUs on sale this year by line and price band."""
    selling = products.selling_this_year(wh.table("product", ["sku_id", "product_line", "rsp"]), wh, cal)
    banded = selling.selectExpr("sku_id", "product_line", f"{segments.price_band('rsp')} AS price_band")
    return products.sku_distribution(banded, "product_line", "price_band")


REPORTS = {
    f.__name__: f
    for f in (
        line_similarity_top5,
        line_age_similarity_top5,
        repurchase_gap_distribution,
        member_line_count_distribution,
        member_frequency_distribution,
        member_sku_count_distribution,
        portfolio_line_age,
        portfolio_line_novelty,
        portfolio_line_price,
    )
}
