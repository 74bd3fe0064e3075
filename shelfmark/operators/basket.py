"""Lines bought together in one order.

Orders are first reduced to their set of product lines, and orders with the same sets are
counted together; pairs are formed from the distinct sets. However many orders there are (or
lines one order has), the work after that grows with the variety of baskets. A set holds each
product line at most once, so its size is bounded by the number of lines in the assortment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.measures import safe_ratio
from shelfmark.operators.lifetime import item_range
from shelfmark.operators.similarity import rank_pivot


def multi_item_orders(valid: DataFrame, item: str, n: int = 2) -> DataFrame:
    """Orders with at least ``n`` different items."""
    if n == 2:
        rows = valid.selectExpr("parent_order_id", *item_range(item, "item"))
        enough = F.expr("min(low_item) < max(high_item) AS enough")
    else:
        rows, enough = valid, F.expr(f"count(DISTINCT {item}) >= {n} AS enough")
    return rows.groupBy("parent_order_id").agg(enough).filter("enough").select("parent_order_id")


def basket_patterns(valid: DataFrame, this_year: str) -> DataFrame:
    """How often each combination of lines occurs among orders with at least two lines this
    year: ``recent`` lists the known lines of this year's rows, ``ever`` all lines (one
    element may hold an unknown line). Orders without an id pair with nothing."""
    return (
        valid.filter("parent_order_id IS NOT NULL")
        .groupBy("parent_order_id")
        .agg(
            F.expr(f"array_sort(collect_set(product_line) FILTER (WHERE {this_year})) AS recent"),
            F.expr("array_sort(collect_set(struct(product_line))) AS ever"),
        )
        .filter("size(recent) >= 2")
        .groupBy("recent", "ever")
        .agg(F.expr("count(*) AS orders"))
    )


def basket_pair_counts(patterns: DataFrame) -> DataFrame:
    """Orders per ordered pair of different lines."""
    return (
        patterns.selectExpr("explode(recent) AS main_line", "recent", "orders")
        .selectExpr("main_line", "explode(recent) AS bundled_line", "orders")
        .filter("main_line <> bundled_line")
        .groupBy("main_line", "bundled_line")
        .agg(F.expr("sum(orders) AS bundle_count"))
    )


def basket_totals(patterns: DataFrame) -> DataFrame:
    """Orders with several lines, per line they contain."""
    return (
        patterns.selectExpr("inline(ever)", "orders")
        .groupBy("product_line")
        .agg(F.expr("sum(orders) AS ttl_bundled_order_cnt"))
    )


def ranked_bundles(patterns: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` lines most often bought with each line; equal counts rank by name."""
    totals = basket_totals(patterns).withColumnRenamed("product_line", "total_line")
    best = "row_number() OVER (PARTITION BY main_line ORDER BY bundle_count DESC, bundled_line) AS rk"
    return (
        basket_pair_counts(patterns)
        .selectExpr("*", best)
        .filter(f"rk <= {k}")
        .join(totals, F.expr("main_line = total_line"))
        .selectExpr(
            "main_line",
            "bundled_line",
            "bundle_count",
            "ttl_bundled_order_cnt",
            f"{safe_ratio('bundle_count', 'ttl_bundled_order_cnt')} AS ratio",
            "rk",
        )
    )


def top_bundled_lines(ranked: DataFrame, k: int = 3) -> DataFrame:
    """One row per line: its orders with several lines, its best companions, their shares."""
    values = {
        "bundled_line": [f"top{i}_bundled_line" for i in range(1, k + 1)],
        "ratio": [f"top{i}_bundled_penetration" for i in range(1, k + 1)],
    }
    total = "max(ttl_bundled_order_cnt) AS ttl_bundled_cnline_orders"
    return rank_pivot(ranked, "main_line", "rk", values, [total])
