"""The scorecard by product line: the common scorecard plus baskets, journeys and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfmark.calendar import ReportCalendar
from shelfmark.conventions import Conventions
from shelfmark.functions.measures import safe_ratio
from shelfmark.functions.windows import TY, ytd_window
from shelfmark.operators import basket, journey, profile
from shelfmark.operators.lifetime import first_paid_time, lifetime_order_rank, order_rank_flags
from shelfmark.operators.scorecard import (
    ExtraCounts,
    ScorecardRun,
    base_count,
    join_on_keys,
    metric_figures,
    sales_figures,
    valid_store_lines,
)
from shelfmark.plans.scorecards import STORE_BY_LINE
from shelfmark.sources.shared import relation, shares
from shelfmark.sources.staging import stage
from shelfmark.sources.tables import Warehouse

# Order items that make an order a bundle -> output column.
BUNDLE_RATES = {
    "several_sku_id": "bundle_differnt_sku_order_rate",
    "several_product_line": "bundle_differnt_cnline_order_rate",
}
# In this report two member figures carry another name.
RENAMED = {
    "member_atv": "member_atv_buying_the_line",
    "member_frequency": "member_frequency_buying_the_line",
}
_SHARE = "lifetime_initial_member_shopper_repurchased_{}_member_shopper_share_of_all_repurchased"
REPURCHASE_SHARES = {
    _SHARE.format("starred_line"): "repurchased_starred",
    _SHARE.format("initial_line"): "repurchased_initial_line",
    _SHARE.format("starred_or_initial_line"): "repurchased_starred_or_initial_line",
}


def this_year_lines(cal: ReportCalendar) -> str:
    return ytd_window("order_paid_date", cal, TY, bounded=False)


# What makes an order a bundle: number ranges of ``order_member_lines``.
ORDER_ITEMS = ("sku_id", "product_line")


def store_order_lines(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    """Valid store lines reduced to (order, member, line); the base of every block below.

    Where the cluster has a shared checkpoint folder the reduced rows are written once, so
    that the order lines are scanned and joined to the members once instead of per block.
    """
    valid = valid_store_lines(wh, cal, conv, ["product_line", "sku_id"])
    reduced = journey.order_member_lines(valid, this_year_lines(cal))
    return relation(wh, "order_member_lines", lambda: reduced) if shares(wh) else stage(reduced)


def line_extras(
    wh: Warehouse, cal: ReportCalendar, order_lines: DataFrame, fix_under_18: bool = False
) -> ExtraCounts:
    """Bundle and profile counts that join the member block."""
    bundles = {n: ("parent_order_id", f"valid AND coalesce({n}, false)") for n in BUNDLE_RATES}
    return ExtraCounts(
        counts=bundles | profile.profile_counts(fix_under_18),
        line_columns=(*BUNDLE_RATES, *profile.PROFILE_LINE_COLUMNS),
        needs_city=True,
        bridge_columns=profile.member_profile(wh, cal).drop("tier_code", "has_birthday"),
        order_flags=order_rank_flags(first_paid_time(order_lines, ORDER_ITEMS), ORDER_ITEMS),
    )


def journeys_of(order_lines: DataFrame) -> DataFrame:
    """Member journeys over store lines; reused by every journey block."""
    ranks = lifetime_order_rank(first_paid_time(order_lines))
    return journey.member_journeys(journey.member_lines(order_lines, ranks))


def store_by_line(
    wh: Warehouse, cal: ReportCalendar, conv: Conventions, fix_under_18: bool = False
) -> DataFrame:
    order_lines = store_order_lines(wh, cal, conv)
    extras = line_extras(wh, cal, order_lines, fix_under_18)
    run = ScorecardRun(wh, cal, conv, STORE_BY_LINE, extras)
    keys = ["is_total", "product_line"]
    rows = run.joined()

    patterns = basket.basket_patterns(order_lines, "recent")
    bundles = basket.top_bundled_lines(basket.ranked_bundles(patterns))

    journeys = journeys_of(order_lines)
    histories = journey.repeat_histories(journeys)
    starts = journey.initial_repurchase_summary(journeys, conv)
    next_lines = journey.line_ranks(
        journey.top_repurchased_lines(journeys), "initial_line", "repurchase_line", "repurchase_cnline_top_"
    )
    previous = journey.prior_purchase_summary(histories)
    previous_lines = journey.line_ranks(
        journey.top_previous_lines(histories), "repurchase_line", "previous_line", "previous_purchases_cnline_"
    )

    def by_line(block: DataFrame, line: str) -> DataFrame:
        """A block that has no total row, keyed like the scorecard."""
        others = [c for c in block.columns if c != line]
        return block.selectExpr("false AS is_total", f"{line} AS product_line", *others)

    totals_too = starts.withColumnRenamed("initial_line", "product_line")
    bundles_by_line = by_line(bundles.selectExpr("main_line AS line", "*"), "line")
    for block in (
        bundles_by_line,
        totals_too,
        by_line(next_lines, "initial_line"),
        by_line(previous, "repurchase_line"),
        by_line(previous_lines, "repurchase_line"),
    ):
        rows = join_on_keys(rows, block, keys)

    metrics = metric_figures(STORE_BY_LINE, RENAMED)
    lifetime = {n: e for n, e in metrics.items() if n.startswith("lifetime_")}
    figures = sales_figures(STORE_BY_LINE) | {n: e for n, e in metrics.items() if n not in lifetime}
    figures |= {
        name: safe_ratio(base_count(TY, item), base_count(TY, "orders")) for item, name in BUNDLE_RATES.items()
    }
    figures |= {c: c for c in ["main_line", "ttl_bundled_cnline_orders"]}
    figures |= {f"top{i}_bundled_{what}": f"top{i}_bundled_{what}" for what in ("line", "penetration") for i in (1, 2, 3)}
    figures |= lifetime
    figures["lifetime_initial_member_shopper_repurchase_rate"] = "repurchase_rate"
    figures |= {c: c for c in [f"repurchase_cnline_top_{i}" for i in range(1, 5)]}
    figures |= {n: safe_ratio(c, "repurchasing_members") for n, c in REPURCHASE_SHARES.items()}
    figures["lifetime_repurchase_member_shopper_v2"] = "repurchase_members"
    figures |= {c: c for c in [f"previous_purchases_cnline_{i}" for i in range(1, 5)]}
    figures["previous_purchases_repurchase_cnline_share"] = safe_ratio("bought_before", "repurchase_members")
    figures |= {n: f"nullif({base_count(TY, n)}, 0)" for n in profile.profile_counts()}
    return rows.selectExpr("product_line", *[f"{e} AS {n}" for n, e in figures.items()])
