"""The reporting calendar: every report takes its date as an argument."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


def _one_year_before(day: dt.date) -> dt.date:
    """Same day last year; 29 February becomes the 28th, as ``add_months(d, -12)`` does."""
    try:
        return day.replace(year=day.year - 1)
    except ValueError:
        return day.replace(year=day.year - 1, day=28)


@dataclass(frozen=True)
class ReportCalendar:
    """Dates one report run depends on.

    ``as_of`` is an exclusive upper bound. This year (``ty``) runs from ``ty_start``;
    last year (``ly``) is ``ly_start`` to ``ly_end``, both included.
    """

    as_of: dt.date
    ty_start: dt.date
    ly_start: dt.date
    ly_end: dt.date
    novelty_cutoff_ty: dt.date
    novelty_cutoff_ly: dt.date
    profile_year: int

    @classmethod
    def for_date(
        cls,
        as_of: dt.date,
        *,
        ty_start: dt.date | None = None,
        ly_start: dt.date | None = None,
        ly_end: dt.date | None = None,
        novelty_cutoff_ty: dt.date | None = None,
        novelty_cutoff_ly: dt.date | None = None,
        profile_year: int | None = None,
    ) -> "ReportCalendar":
        """Default rules: years start on the Monday of ISO week 1; last year ends two days
        after the same calendar day; products launched from 25 December on are new."""
        year = as_of.year
        return cls(
            as_of=as_of,
            ty_start=ty_start or dt.date.fromisocalendar(year, 1, 1),
            ly_start=ly_start or dt.date.fromisocalendar(year - 1, 1, 1),
            ly_end=ly_end or _one_year_before(as_of) + dt.timedelta(days=2),
            novelty_cutoff_ty=novelty_cutoff_ty or dt.date(year - 1, 12, 25),
            novelty_cutoff_ly=novelty_cutoff_ly or dt.date(year - 2, 12, 25),
            profile_year=profile_year or year,
        )

    @property
    def year(self) -> int:
        """Calendar (not ISO) year of the report."""
        return self.as_of.year

    @property
    def year_start(self) -> dt.date:
        return dt.date(self.as_of.year, 1, 1)

    @property
    def next_year_start(self) -> dt.date:
        return dt.date(self.as_of.year + 1, 1, 1)

    @property
    def earliest(self) -> dt.date:
        """Start of the older of the two reporting windows."""
        return min(self.ty_start, self.ly_start)
