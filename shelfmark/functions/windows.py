"""Date-window predicates, written as ranges on the raw column so they reach the scan.

``date(ts) < d`` equals ``ts < d`` at midnight, ``date(ts) <= d`` equals ``ts < d + 1``;
both forms work unchanged on DATE, TIMESTAMP and TIMESTAMP_NTZ columns.
"""

from __future__ import annotations

import datetime as dt

from shelfmark.calendar import ReportCalendar

TY = "ty"
LY = "ly"
PERIODS = (TY, LY)


def date_literal(day: dt.date) -> str:
    return f"DATE'{day.isoformat()}'"


def paid_before(day: str, cal: ReportCalendar) -> str:
    return f"{day} < {date_literal(cal.as_of)}"


def ytd_window(day: str, cal: ReportCalendar, period: str, bounded: bool = True) -> str:
    """Year-to-date of this year (``ty``, upper bound optional) or last year (``ly``)."""
    if period == TY:
        inside = f"{day} >= {date_literal(cal.ty_start)}"
        return f"({inside} AND {paid_before(day, cal)})" if bounded else f"({inside})"
    if period == LY:
        after_end = cal.ly_end + dt.timedelta(days=1)
        return f"({day} >= {date_literal(cal.ly_start)} AND {day} < {date_literal(after_end)})"
    raise ValueError(f"unknown period {period!r}")


def in_calendar_year(day: str, cal: ReportCalendar) -> str:
    """``year(d) = year(as_of)`` as a range, so that it can prune files and row groups."""
    return f"({day} >= {date_literal(cal.year_start)} AND {day} < {date_literal(cal.next_year_start)})"
