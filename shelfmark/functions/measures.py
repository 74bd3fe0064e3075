"""Measures and ratios."""

from __future__ import annotations

MONEY_TOTAL = "DECIMAL(38,2)"


def signed_amount(qty: str = "sales_qty", amount: str = "order_amt") -> str:
    """Sales count up, returns (negative quantity) count down, zero or unknown quantity is 0.

    Its sum is net sales: amounts sold minus absolute amounts returned.
    """
    return f"CASE WHEN {qty} > 0 THEN {amount} WHEN {qty} < 0 THEN -abs({amount}) ELSE 0 END"


def net_sales(qty: str = "sales_qty", amount: str = "order_amt") -> str:
    return f"CAST(sum({signed_amount(qty, amount)}) AS {MONEY_TOTAL})"


def safe_ratio(numerator: str, denominator: str) -> str:
    """Double division; NULL when the divisor is zero or NULL."""
    return f"(CAST({numerator} AS DOUBLE) / nullif(CAST({denominator} AS DOUBLE), 0))"


def growth(current: str, base: str) -> str:
    return f"({safe_ratio(current, base)} - 1.0D)"


def share_change(current: str, base: str) -> str:
    return f"({current} - {base})"


def whole_ratio(numerator: str, denominator: str) -> str:
    """Integer division of two counts, NULL on a zero divisor."""
    return f"({numerator} div nullif({denominator}, 0))"
