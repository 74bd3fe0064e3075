"""Purchase journeys: what members bought first, what they came back for.

All questions compare a member's lines with each other, so the fact is first reduced to one
row per (member, line) - whether the line was part of this year's first or repeat orders, the
highest rank it was repeated at and the lowest rank it was ever bought at - and then to one
row per member holding these few rows (at most one per product line of the assortment).
Members with equal journeys are counted together before any pair of lines is formed.

Members without a canonical id match nobody: they contribute rows with a count of 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.conventions import Conventions
from shelfmark.functions.measures import safe_ratio
from shelfmark.operators.lifetime import item_range
from shelfmark.operators.similarity import rank_pivot


def order_rank_range(ranks: DataFrame) -> DataFrame:
    """Per order the lowest and highest lifetime rank it has for any of its members."""
    return ranks.groupBy("parent_order_id").agg(
        F.expr("min(rk) AS min_rk"), F.expr("max(rk) AS max_rk")
    ).withColumnRenamed("parent_order_id", "ranked_order_id")


def order_member_lines(valid: DataFrame, this_year: str) -> DataFrame:
    """One row per (order, member, line) of valid lines: everything baskets, ranks and journeys
    need to know about them."""
    numbered = valid.selectExpr("*", *item_range("sku_id", "sku_id"))
    reduced = numbered.groupBy("parent_order_id", "member_id", "product_line").agg(
        F.expr("min(order_paid_time) AS order_paid_time"),
        F.expr(f"max({this_year}) AS recent"),
        F.expr("min(low_sku_id) AS low_sku_id"),
        F.expr("max(high_sku_id) AS high_sku_id"),
    )
    return reduced.selectExpr("*", *item_range("product_line", "product_line"))


def member_lines(per_order: DataFrame, ranks: DataFrame) -> DataFrame:
    """One row per (member, line).

    ``initial``: bought this year in someone's first order; ``repeated_at``: highest rank of
    this year's orders that are a repeat, ``repeated_from`` the lowest (an order shared by
    several members has several ranks); ``first_at``: lowest rank of any order.
    """
    joined = per_order.join(order_rank_range(ranks), F.expr("parent_order_id = ranked_order_id"), "left")
    return joined.groupBy("member_id", "product_line").agg(
        F.expr("coalesce(max(recent AND min_rk = 1), false) AS initial"),
        F.expr("max(max_rk) FILTER (WHERE recent AND max_rk >= 2) AS repeated_at"),
        F.expr("min(min_rk) FILTER (WHERE recent AND max_rk >= 2) AS repeated_from"),
        F.expr("min(min_rk) AS first_at"),
    )


def member_journeys(lines: DataFrame) -> DataFrame:
    """One row per member: ``lines`` as (line, initial, repeated_at, repeated_from, first_at)."""
    entry = "struct(product_line AS line, initial, repeated_at, repeated_from, first_at)"
    return lines.groupBy("member_id").agg(F.expr(f"array_sort(collect_list({entry})) AS lines"))


_COUNTED = "CAST(sum(CASE WHEN known THEN members ELSE 0 END) AS BIGINT)"

# Of one member: lines bought first, lines repeated.
_INITIAL = "transform(filter(lines, x -> x.initial), x -> struct(x.line))"
_REPEATED = "transform(filter(lines, x -> x.repeated_at IS NOT NULL), x -> struct(x.line))"


def _starts(journeys: DataFrame) -> DataFrame:
    """Distinct (first lines, repeated lines) of members with a first line, with their number."""
    return (
        journeys.selectExpr(
            "member_id IS NOT NULL AS known",
            f"{_INITIAL} AS initial",
            f"CASE WHEN member_id IS NOT NULL THEN {_REPEATED} ELSE array() END AS repeated",
        )
        .filter("size(initial) > 0")
        .groupBy("known", "initial", "repeated")
        .agg(F.expr("count(*) AS members"))
    )


def initial_repurchase_summary(journeys: DataFrame, conv: Conventions) -> DataFrame:
    """Per line of a first order, and in total: members, how many came back, and how many came
    back for a starred line, for the same line, for either."""
    starred = f"exists(repeated, r -> r.line LIKE '{conv.starred_line_like}')"
    back = "size(repeated) > 0"
    own = "exists(repeated, r -> r.line = i.line)"
    any_own = "exists(initial, i -> exists(repeated, r -> r.line = i.line))"

    def row(is_total: str, line: str, same: str) -> str:
        return (
            f"named_struct('is_total', {is_total}, 'initial_line', {line}, 'back', {back},"
            f" 'starred', {starred}, 'same', coalesce({same}, false))"
        )

    rows = (
        f"inline(concat(transform(initial, i -> {row('false', 'i.line', own)}),"
        f" array({row('true', repr(conv.total_label), any_own)})))"
    )

    def members(condition: str) -> str:
        return f"CAST(sum(CASE WHEN known AND {condition} THEN members ELSE 0 END) AS BIGINT)"

    return (
        _starts(journeys)
        .selectExpr("known", "members", rows)
        .groupBy("is_total", "initial_line")
        .agg(
            F.expr(f"{_COUNTED} AS initial_members"),
            F.expr(f"{members('back')} AS repurchasing_members"),
            F.expr(f"{members('starred')} AS repurchased_starred"),
            F.expr(f"{members('same')} AS repurchased_initial_line"),
            F.expr(f"{members('(starred OR same)')} AS repurchased_starred_or_initial_line"),
        )
        .selectExpr("*", f"{safe_ratio('repurchasing_members', 'initial_members')} AS repurchase_rate")
    )


def top_repurchased_lines(journeys: DataFrame, k: int = 4) -> DataFrame:
    """Per line of a first order the ``k`` lines most members came back for."""
    pairs = (
        _starts(journeys)
        .filter("known")
        .selectExpr("inline(initial)", "repeated", "members")
        .selectExpr("line AS initial_line", "inline(repeated)", "members")
        .groupBy("initial_line", F.expr("line AS repurchase_line"))
        .agg(F.expr("CAST(sum(members) AS BIGINT) AS members"))
    )
    return _ranked(pairs, "initial_line", "repurchase_line", k)


def repeat_histories(journeys: DataFrame) -> DataFrame:
    """Per repeated line and set of lines its buyer had bought at a lower rank: members.

    A purchase that had none before it stands as an unnamed line in the set.
    """
    lower = "transform(filter(lines, p -> p.first_at < r.repeated_at), p -> struct(p.line))"
    none_before = (
        "CASE WHEN r.repeated_from <= array_min(transform(lines, p -> p.first_at))"
        " THEN array(struct(CAST(NULL AS STRING) AS line)) ELSE array() END"
    )
    earlier = f"array_sort(array_distinct(concat({lower}, {none_before})))"
    return (
        journeys.selectExpr(
            "member_id IS NOT NULL AS known",
            "inline(transform(filter(lines, x -> x.repeated_at IS NOT NULL), r -> struct(r.line AS line,"
            f" CASE WHEN member_id IS NOT NULL THEN {earlier} ELSE array() END AS earlier)))",
        )
        .groupBy("known", F.expr("line AS repurchase_line"), "earlier")
        .agg(F.expr("count(*) AS members"))
    )


def prior_purchase_summary(histories: DataFrame) -> DataFrame:
    """Per repeated line: members, and members who had bought that line before."""
    again = "exists(earlier, p -> p.line = repurchase_line)"
    return histories.groupBy("repurchase_line").agg(
        F.expr(f"{_COUNTED} AS repurchase_members"),
        F.expr(f"CAST(sum(CASE WHEN known AND {again} THEN members ELSE 0 END) AS BIGINT) AS bought_before"),
    )


def top_previous_lines(histories: DataFrame, k: int = 4) -> DataFrame:
    """Per repeated line the ``k`` lines most of its buyers had bought before. Buyers without
    an earlier line, and earlier lines without a name, share one unnamed entry."""
    pairs = (
        histories.selectExpr("known", "repurchase_line", "members", "inline_outer(earlier)")
        .groupBy("repurchase_line", F.expr("line AS previous_line"))
        .agg(F.expr(f"{_COUNTED} AS members"))
    )
    return _ranked(pairs, "repurchase_line", "previous_line", k)


def _ranked(pairs: DataFrame, key: str, line: str, k: int) -> DataFrame:
    best = f"row_number() OVER (PARTITION BY {key} ORDER BY members DESC, {line} ASC NULLS LAST) AS rk"
    ranked = pairs.selectExpr("*", best).filter(f"rk <= {k}")
    return ranked.selectExpr(key, line, "members", "CAST(rk AS BIGINT) AS rk")


def line_ranks(ranked: DataFrame, key: str, line: str, prefix: str, k: int = 4) -> DataFrame:
    """Ranked lines as columns ``prefix1`` .. ``prefixk``."""
    return rank_pivot(ranked, key, "rk", {line: [f"{prefix}{i}" for i in range(1, k + 1)]})


def nth_purchase_shoppers(valid: DataFrame, ranks: DataFrame, this_year: str, conv: Conventions) -> DataFrame:
    """Members per line (and in total) whose order this year was their 2nd, 3rd, 4th, 5th or
    later one, and their share of all members."""
    nth = {"second": "rk = 2", "third": "rk = 3", "fourth": "rk = 4", "five_plus": "rk >= 5"}
    rank_of = ranks.selectExpr("parent_order_id AS ranked_order_id", "rk")
    lines = valid.filter(this_year).join(rank_of, F.expr("parent_order_id = ranked_order_id"), "left")
    counts = [
        f"count(DISTINCT member_id) FILTER (WHERE {c}) AS lifetime_{n}_member_shopper" for n, c in nth.items()
    ]
    both = (
        "inline(array(named_struct('is_total', false, 'line', product_line),"
        f" named_struct('is_total', true, 'line', '{conv.total_label}')))"
    )
    counted = (
        lines.selectExpr("member_id", "rk", both)
        .groupBy("is_total", "line")
        .agg(*map(F.expr, ["count(DISTINCT member_id) AS buyers", *counts]))
    )
    figures = [
        f
        for n in nth
        for f in (
            f"lifetime_{n}_member_shopper",
            f"{safe_ratio(f'lifetime_{n}_member_shopper', 'buyers')} AS lifetime_{n}_member_shopper_share",
        )
    ]
    return counted.selectExpr("line AS product_line", *figures)
