"""The nine scorecards as configurations of one operator."""

from __future__ import annotations

from shelfmark.calendar import ReportCalendar
from shelfmark.functions import segments
from shelfmark.functions.windows import TY
from shelfmark.operators import products
from shelfmark.operators.scorecard import Dimension, ScorecardSpec

_ALL_BLOCKS = frozenset({"plan", "sales", "kpi"})


def _same(name: str, plan: str, sales: str, kpi: str) -> Dimension:
    """A dimension that has one rule per block for both years."""
    return Dimension(
        name,
        plan=lambda cal: plan,
        sales=lambda cal, period: sales,
        kpi=lambda cal, period: kpi,
    )


def _attribute(name: str, expression: str) -> Dimension:
    return _same(name, expression, expression, expression)


LINE = _same("product_line", "p_product_line", "product_line", "product_line")
AGE_BAND = _attribute("age_band", segments.age_band("a_min_age"))
PRICE_BAND = _attribute("price_band", "a_price_band")


def _cutoff(cal: ReportCalendar, period: str):
    return cal.novelty_cutoff_ty if period == TY else cal.novelty_cutoff_ly


def _novelty_by_cutoff(launch: str):
    def rule(cal: ReportCalendar, period: str) -> str:
        return segments.novelty_since(launch, _cutoff(cal, period))

    return rule


NOVELTY = Dimension(
    "novelty",
    plan=lambda cal: segments.novelty_since("p_store_launch_date", cal.novelty_cutoff_ty),
    sales=_novelty_by_cutoff("bu_launch_date"),
    kpi=_novelty_by_cutoff("a_bu_launch_date"),
)

# Next to the line, novelty is judged by other dates: plan by store-launch year, this year's
# sales by store launch, this year's members by launch year; last year as above.
NOVELTY_NEXT_TO_LINE = Dimension(
    "novelty",
    plan=lambda cal: segments.novelty_in_year("p_store_launch_date", cal.year),
    sales=lambda cal, period: segments.novelty_since(
        "store_launch_date" if period == TY else "bu_launch_date", _cutoff(cal, period)
    ),
    kpi=lambda cal, period: (
        segments.novelty_in_year("a_bu_launch_date", cal.year)
        if period == TY
        else segments.novelty_since("a_bu_launch_date", cal.novelty_cutoff_ly)
    ),
)


def _segment(*_) -> str:
    return segments.audience_segment("a_min_age")


SEGMENT = Dimension("segment", plan=_segment, sales=_segment, kpi=_segment)
SKU = _same("sku_id", "sku_id", "sku_id", "sku_id")

STORE_BY_AGE = ScorecardSpec(
    dimensions=(AGE_BAND,),
    share_key="age_band",
    sku_base=products.RATED_AND_SELLING,
    sku_blocks=_ALL_BLOCKS,
)

STORE_BY_LINE = ScorecardSpec(
    dimensions=(LINE,),
    share_key="product_line",
    sales_columns=("product_line",),
    kpi_columns=("product_line",),
    bound_rows=False,
    hide_unchanged_atv=True,
    whole_repurchase_share=False,
)

STORE_BY_LINE_AGE = ScorecardSpec(
    dimensions=(AGE_BAND, LINE),
    share_key="product_line",
    sales_columns=("product_line",),
    kpi_columns=("product_line",),
    sku_base=products.RATED_AND_SELLING,
    sku_blocks=_ALL_BLOCKS,
    bound_rows=False,
    bound_total=False,
    bound_new_members=False,
    hide_unchanged_atv=True,
)

STORE_BY_LINE_NOVELTY = ScorecardSpec(
    dimensions=(LINE, NOVELTY_NEXT_TO_LINE),
    share_key="novelty",
    sales_columns=("product_line", "bu_launch_date", "store_launch_date"),
    kpi_columns=("product_line",),
    sku_blocks=frozenset({"kpi"}),
    bound_rows=False,
    bound_total=False,
    bound_new_members=False,
    hide_unchanged_atv=True,
)

STORE_BY_LINE_PRICE = ScorecardSpec(
    dimensions=(_same("product_line", "p_product_line", "a_product_line", "product_line"), PRICE_BAND),
    share_key="price_band",
    kpi_columns=("product_line",),
    sku_blocks=_ALL_BLOCKS,
    bound_rows=False,
    bound_total=False,
    hide_unchanged_atv=True,
)

STORE_BY_LINE_SKU = ScorecardSpec(
    dimensions=(LINE, SKU),
    share_key="sku_id",
    sales_columns=("product_line", "sku_name", "bu_launch_date"),
    kpi_columns=("product_line",),
    sku_base=products.RATED_AND_SELLING,
    sku_blocks=frozenset({"sales"}),
    descriptions={
        "sku_name": lambda cal: "sku_name",
        "novelty": lambda cal: segments.novelty_in_year("bu_launch_date", cal.year),
        "age_band": lambda cal: segments.age_band("a_min_age"),
        "price_band": lambda cal: "a_price_band",
    },
    bound_rows=False,
    bound_total=False,
    hide_unchanged_atv=True,
)

STORE_BY_NOVELTY = ScorecardSpec(
    dimensions=(NOVELTY,),
    share_key="novelty",
    sales_columns=("bu_launch_date",),
    sku_blocks=frozenset({"kpi"}),
    bound_rows=False,
    bound_total=False,
    bound_new_members=False,
)

STORE_BY_SEGMENT = ScorecardSpec(
    dimensions=(SEGMENT,),
    share_key="segment",
    sku_base=products.RATED,
    sku_blocks=_ALL_BLOCKS,
)

STORE_BY_PRICE = ScorecardSpec(
    dimensions=(PRICE_BAND,),
    share_key="price_band",
    zero_price_is_low=True,
    sku_blocks=_ALL_BLOCKS,
)

SCORECARDS: dict[str, ScorecardSpec] = {
    "store_by_age": STORE_BY_AGE,
    "store_by_line": STORE_BY_LINE,
    "store_by_line_age": STORE_BY_LINE_AGE,
    "store_by_line_novelty": STORE_BY_LINE_NOVELTY,
    "store_by_line_price": STORE_BY_LINE_PRICE,
    "store_by_line_sku": STORE_BY_LINE_SKU,
    "store_by_novelty": STORE_BY_NOVELTY,
    "store_by_segment": STORE_BY_SEGMENT,
    "store_by_price": STORE_BY_PRICE,
}
