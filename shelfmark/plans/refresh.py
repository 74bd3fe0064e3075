"""The refresh job: all 18 reports of one date, over shared relations, into their targets together."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from shelfmark.calendar import ReportCalendar
from shelfmark.conventions import Conventions
from shelfmark.plans.registry import all_reports
from shelfmark.plans.reports import REPORTS
from shelfmark.plans.scorecards import SCORECARDS
from shelfmark.sources.shared import SharedRelations
from shelfmark.sources.sinks import refresh_together
from shelfmark.sources.staging import CHECKPOINT_DIR, has_shared_folder
from shelfmark.sources.tables import Warehouse, check_unique, source_quality

#: The reports a refresh covers.
TARGETS = (*REPORTS, *SCORECARDS)
#: Masters in which a key must be unique, or joins to them would repeat lines.
MASTERS = {"product": ["sku_id"], "city_type": ["city"]}


@dataclass(frozen=True)
class RefreshResult:
    targets: Mapping[str, str]
    # Relations that were stored and shared by the reports.
    shared: tuple[str, ...]
    # Figures of the source, as ``source_quality`` counts them.
    quality: Mapping[str, int]


def refresh_reports(
    wh: Warehouse,
    cal: ReportCalendar,
    conv: Conventions,
    targets: Mapping[str, str],
    reports: Mapping[str, Callable[[Warehouse, ReportCalendar, Conventions], DataFrame]] | None = None,
) -> RefreshResult:
    """Compute the reports named in ``targets`` (report -> table name or folder) and replace all or none.

    The eligible lines with their members, the order ranks and the member base are derived and stored once
    in the cluster's checkpoint folder, and dropped at the end. Repeated keys in a master stop the refresh
    before anything is written, with the keys in the message.
    """
    spark = wh.spark
    if not has_shared_folder(spark):
        raise ValueError(f"{CHECKPOINT_DIR} must name a folder that the driver and all executors share")
    known = dict(reports) if reports is not None else all_reports()
    unknown = set(targets) - set(known)
    if unknown:
        raise ValueError(f"unknown reports: {sorted(unknown)}")
    for name, keys in MASTERS.items():
        check_unique(wh.table(name, keys), keys, name)
    folder = f"{spark.conf.get(CHECKPOINT_DIR).rstrip('/')}/refresh-{uuid.uuid4().hex}"
    shared = SharedRelations(wh, folder)
    try:
        quality = source_quality(wh, cal).first().asDict()
        refresh_together(spark, {t: _bound(known[name], shared, cal, conv) for name, t in targets.items()})
        return RefreshResult(dict(targets), tuple(shared.stored), quality)
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _bound(report, wh, cal, conv) -> Callable[[], DataFrame]:
    return lambda: report(wh, cal, conv)
