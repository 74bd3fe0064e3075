"""Product attributes, assortment counts and the sales plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.calendar import ReportCalendar
from shelfmark.conventions import Conventions
from shelfmark.functions import segments
from shelfmark.functions.windows import in_calendar_year
from shelfmark.sources.tables import Warehouse

ALL, RATED, RATED_AND_SELLING = "all", "rated", "rated_and_selling"


def skus_sold_this_year(wh: Warehouse, cal: ReportCalendar) -> DataFrame:
    sales = wh.table("store_sales", ["sku_id", "sale_date"])
    return sales.filter(in_calendar_year("sale_date", cal)).selectExpr("sku_id AS sold_sku").distinct()


def selling_this_year(products: DataFrame, wh: Warehouse, cal: ReportCalendar) -> DataFrame:
    """Keep products with a store sale in the calendar year."""
    return products.join(skus_sold_this_year(wh, cal), F.expr("sku_id = sold_sku"), "left_semi")


def sku_attributes(wh: Warehouse, cal: ReportCalendar, base: str = ALL, zero_is_low: bool = False) -> DataFrame:
    """Derived attributes of each SKU, columns prefixed ``a_``; ``base`` picks the SKUs."""
    products = wh.table("product", ["sku_id", "product_line", "age_mark", "rsp", "bu_launch_date"])
    if base in (RATED, RATED_AND_SELLING):
        products = products.filter(segments.is_rated("age_mark"))
    if base == RATED_AND_SELLING:
        products = selling_this_year(products, wh, cal)
    years = segments.min_age("age_mark")
    return products.selectExpr(
        "sku_id AS a_sku_id",
        "product_line AS a_product_line",
        "bu_launch_date AS a_bu_launch_date",
        f"{segments.price_band('rsp', zero_is_low)} AS a_price_band",
        f"{years} AS a_min_age",
    )


def attach_sku_attributes(rows: DataFrame, attributes: DataFrame) -> DataFrame:
    return rows.join(attributes, F.expr("sku_id = a_sku_id"), "left")


def sku_distribution(products: DataFrame, *keys: str) -> DataFrame:
    return products.groupBy(*keys).agg(F.expr("count(DISTINCT sku_id) AS sku_count"))


def plan_value(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    """Planned sales value per SKU of this year up to this month, with product columns ``p_``.

    Months are summed before the product is joined; a SKU without a price has no value.
    """
    plan = wh.table(
        "sku_plan",
        ["sku_id", "plan_year", "plan_month", "plan_qty", "review_channel", "plan_version"],
    ).filter(
        f"plan_year = {cal.year} AND plan_month <= {cal.as_of.month}"
        f" AND review_channel LIKE '{conv.plan_channel_like}' AND plan_version = '{conv.plan_version}'"
    )
    quantity = plan.groupBy("sku_id").agg(F.expr("CAST(sum(plan_qty) AS DECIMAL(18,0)) AS plan_qty"))
    product = wh.table("product", ["sku_id", "product_line", "rsp", "store_launch_date"]).selectExpr(
        "sku_id AS p_sku_id",
        "product_line AS p_product_line",
        "store_launch_date AS p_store_launch_date",
        "rsp AS p_rsp",
    )
    return quantity.join(product, F.expr("sku_id = p_sku_id"), "left").selectExpr(
        "*", "p_rsp * plan_qty AS plan_value"
    )
