"""Every registered query with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfmark.conventions import Conventions
from shelfmark.operators.scorecard import ScorecardSpec, scorecard
from shelfmark.oracle.reports import ORACLE_SQL
from shelfmark.plans.building_blocks import BUILDING_BLOCKS
from shelfmark.plans.line_report import store_by_line
from shelfmark.plans.reports import REPORTS
from shelfmark.plans.scorecards import SCORECARDS
from shelfmark.sources.fixtures import FIXTURE_CALENDAR, FixtureWarehouse

Report = Callable[..., DataFrame]


def _scorecard(spec: ScorecardSpec) -> Report:
    return lambda wh, cal, conv: scorecard(wh, cal, conv, spec)


def all_reports() -> dict[str, Report]:
    """Report name -> function of (warehouse, calendar, conventions)."""
    scorecards = {name: _scorecard(spec) for name, spec in SCORECARDS.items()}
    scorecards["store_by_line"] = store_by_line
    return {**REPORTS, **scorecards, **BUILDING_BLOCKS}


def _bind(report: Report) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return report(FixtureWarehouse(spark, folder), FIXTURE_CALENDAR, Conventions())

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bind(report) for name, report in all_reports().items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
