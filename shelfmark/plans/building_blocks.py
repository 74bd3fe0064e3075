"""Single operators as queries of their own, so that each can be checked by itself."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.calendar import ReportCalendar
from shelfmark.conventions import Conventions
from shelfmark.functions import segments
from shelfmark.functions.measures import net_sales
from shelfmark.functions.windows import PERIODS, TY, ytd_window
from shelfmark.operators import basket, journey, members, products, profile
from shelfmark.operators import conform as conformed
from shelfmark.operators.lifetime import first_paid_time, lifetime_order_rank, order_rank_flags
from shelfmark.operators.scorecard import ScorecardRun, period_metrics, sales_figures, valid_store_lines
from shelfmark.plans.line_report import journeys_of, store_order_lines, this_year_lines
from shelfmark.plans.reports import purchase_days, valid_omnichannel_lines
from shelfmark.plans.scorecards import STORE_BY_LINE, STORE_BY_PRICE
from shelfmark.sources.tables import Warehouse, latest_snapshot as newest_rows


def canonical_member_ids(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    """Eligible lines, members and amounts per channel and identity type."""
    columns = ["source_channel", "type_name", "sales_qty", "order_amt"]
    lines = conformed.conform_order_lines(wh, cal, conv, conv.all_channels, columns)
    return lines.groupBy("source_channel", "type_name").agg(
        F.expr("count(*) AS lines"),
        F.expr("count(DISTINCT member_id) AS members"),
        F.expr("count(DISTINCT member_detail_id) AS registered_members"),
        F.expr(f"{net_sales()} AS net_sales"),
    )


def min_age(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    """Every SKU's parsed age, age band and audience segment; unrated marks have no age."""
    years = f"CASE WHEN {segments.is_rated('age_mark')} THEN {segments.min_age('age_mark')} END"
    return (
        wh.table("product", ["sku_id", "age_mark"])
        .selectExpr("sku_id", "age_mark", f"{years} AS min_age")
        .selectExpr(
            "*",
            f"{segments.age_band('min_age')} AS age_band",
            f"{segments.audience_segment('min_age')} AS segment",
        )
    )


def net_sales_by_line(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    """Net sales and transactions per line over the whole sales table."""
    sales = wh.table("store_sales", ["parent_order_id", "product_line", "sales_qty", "order_amt"])
    return sales.groupBy("product_line").agg(
        F.expr(f"{net_sales()} AS net_sales"), F.expr("count(DISTINCT parent_order_id) AS transactions")
    )


def latest_snapshot(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    columns = ["line1", "line2", "cosine_similarity", "rank", "update_date"]
    return newest_rows(wh.table("line_similarity", columns), "update_date")


def plan_rollup(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    return ScorecardRun(wh, cal, conv, STORE_BY_LINE).plan_block().select("product_line", "sales_plan")


def lifetime_rank(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    ranks = lifetime_order_rank(first_paid_time(valid_store_lines(wh, cal, conv)))
    return ranks.select("parent_order_id", "member_id", "rk")


def order_rank_counts(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    """Per order: members for whom it is the first order, and for whom it is a later one."""
    return order_rank_flags(first_paid_time(valid_store_lines(wh, cal, conv)))


def previous_purchase(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    return purchase_days(wh, cal, conv)


def member_base(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    return members.member_base(valid_omnichannel_lines(wh, cal, conv), cal)


def multi_item_orders(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    return basket.multi_item_orders(valid_store_lines(wh, cal, conv, ["product_line"]), "product_line")


def _patterns(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    return basket.basket_patterns(valid_store_lines(wh, cal, conv, ["product_line"]), this_year_lines(cal))


def basket_pairs(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    return basket.basket_pair_counts(_patterns(wh, cal, conv))


def basket_totals(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    return basket.basket_totals(_patterns(wh, cal, conv))


def top_bundled(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    return basket.top_bundled_lines(basket.ranked_bundles(_patterns(wh, cal, conv)))


def initial_repurchase(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    return journey.initial_repurchase_summary(journeys_of(store_order_lines(wh, cal, conv)), conv).drop("is_total")


def top_repurchased(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    return journey.top_repurchased_lines(journeys_of(store_order_lines(wh, cal, conv)))


def prior_purchase(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    return journey.prior_purchase_summary(journey.repeat_histories(journeys_of(store_order_lines(wh, cal, conv))))


def top_previous(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    return journey.top_previous_lines(journey.repeat_histories(journeys_of(store_order_lines(wh, cal, conv))))


def nth_purchase_shoppers(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    valid = valid_store_lines(wh, cal, conv, ["product_line"])
    ranks = lifetime_order_rank(first_paid_time(valid_store_lines(wh, cal, conv)))
    return journey.nth_purchase_shoppers(valid, ranks, this_year_lines(cal), conv)


def kid_age_flags(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    history = wh.table("birthday_history", ["member_detail_id", "birthday_year", "person_type"])
    return profile.kid_age_flags(history, cal)


def member_profile(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    return profile.member_profile(wh, cal)


def new_members(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    """Members who joined through a store, this year or last year to date."""
    table = wh.table("member", ["member_detail_id", "join_time", "reg_channel"])
    by_period = [
        members.new_members(
            table, f"{ytd_window('join_time', cal, p)} AND reg_channel LIKE '{conv.registration_like}'"
        ).selectExpr(f"'{p}' AS period", "member_detail_id")
        for p in PERIODS
    ]
    return by_period[0].unionByName(by_period[1])


def city_maturity(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    """Store cities with their maturity, and the order lines each combination has."""
    lines = wh.table("order_lines", ["city", "city_tier", "sales_qty"])
    labelled = conformed.attach_city_maturity(lines, wh)
    return labelled.groupBy("city", "city_tier", "city_maturity").agg(F.expr("count(*) AS lines"))


def sales_compare(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    figures = sales_figures(STORE_BY_PRICE)
    rows = ScorecardRun(wh, cal, conv, STORE_BY_PRICE).sales_compare()
    return rows.selectExpr("price_band", *[f"{e} AS {n}" for n, e in figures.items()])


def member_kpis(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    """This year's 23 member metrics per price band and in total."""
    metrics = period_metrics(TY, STORE_BY_PRICE.whole_repurchase_share)
    rows = ScorecardRun(wh, cal, conv, STORE_BY_PRICE).member_kpis().filter("ty_lines > 0")
    return rows.selectExpr("price_band", *[f"{e} AS {n}" for n, (e, _) in metrics.items()])


def line_split(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    """SKUs per line after dividing one line by a word in the SKU name."""
    split = segments.line_split("product_line", "sku_name", "Brand#1", "widget")
    return products.sku_distribution(
        wh.table("product", ["sku_id", "sku_name", "product_line"]).selectExpr(
            "sku_id", f"{split} AS product_line"
        ),
        "product_line",
    )


def latest_attribute_segment(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    events = wh.table("profile_events", ["profile_id", "prop_key", "prop_value", "update_time", "event_id"])
    return profile.latest_attribute_segment(events, "click", "yes", "signup")


BUILDING_BLOCKS = {
    f.__name__: f
    for f in (
        canonical_member_ids,
        min_age,
        net_sales_by_line,
        latest_snapshot,
        plan_rollup,
        lifetime_rank,
        order_rank_counts,
        previous_purchase,
        member_base,
        multi_item_orders,
        basket_pairs,
        basket_totals,
        top_bundled,
        initial_repurchase,
        top_repurchased,
        prior_purchase,
        top_previous,
        nth_purchase_shoppers,
        kid_age_flags,
        member_profile,
        new_members,
        city_maturity,
        sales_compare,
        member_kpis,
        line_split,
        latest_attribute_segment,
    )
}
