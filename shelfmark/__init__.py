"""Retail assortment and member reporting as plain Spark DataFrame jobs."""

from shelfmark.calendar import ReportCalendar
from shelfmark.conventions import Conventions

__all__ = ["Conventions", "ReportCalendar"]
