"""Report targets: whole-table refresh and creation, of one target or of many together."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from contextlib import suppress

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def is_folder(target: str) -> bool:
    """Targets with a slash are folders, others tables of the catalog."""
    return "/" in target


def in_table_order(df: DataFrame, target: str) -> DataFrame:
    """``df`` with the columns of the existing table ``target``, in its order; any difference is an error."""
    existing = df.sparkSession.table(target).columns
    missing, extra = set(existing) - set(df.columns), set(df.columns) - set(existing)
    if missing or extra:
        raise ValueError(
            f"{target} is not refreshed: the report lacks {sorted(missing)}, the table lacks {sorted(extra)}"
        )
    return df.select(*existing)


def full_refresh(df: DataFrame, target: str) -> None:
    """Replace the contents of ``target`` (a table name or a folder) with ``df``.

    An existing table keeps its definition and is overwritten by column name, whatever the
    order. Its columns must be those of ``df``: on any difference nothing is written and a
    ``ValueError`` names the columns (``create_table_as`` replaces a definition on purpose).
    Readers see the old or the new rows, as the table format allows.
    """
    if is_folder(target):
        df.write.mode("overwrite").parquet(target)
        return
    catalog = df.sparkSession.catalog
    if catalog.tableExists(target):
        in_table_order(df, target).write.mode("overwrite").insertInto(target, overwrite=True)
    else:
        create_table_as(df, target)


def create_table_as(df: DataFrame, target: str, format: str = "parquet") -> None:
    """Create ``target`` from a query, replacing a table of that name."""
    df.write.mode("overwrite").format(format).saveAsTable(target)


def ordered_refresh(df: DataFrame, target: str, order: str, rank: str = "row_rank", files: int = 8) -> None:
    """``full_refresh`` of a report whose rows have an order, which stored tables do not keep.

    Rows are range-partitioned and sorted by the SQL ordering ``order`` and carry their place, from 1, in
    the column ``rank``: ``ORDER BY row_rank`` gives the order back, over any number of files. Places are
    row numbers inside a range plus the rows of the ranges before it, so no task sees all rows.
    """
    keys = [F.expr(k.removesuffix(" DESC")).desc() if k.endswith(" DESC") else F.expr(k).asc() for k in order.split(", ")]
    placed = df.repartitionByRange(files, *keys).sortWithinPartitions(*keys).withColumn("_place", F.monotonically_increasing_id())
    part = "shiftright(_place, 33)"
    sizes = placed.groupBy(F.expr(f"{part} AS part")).agg(F.count(F.lit(1)).alias("n")).collect()
    before, starts = 0, {}
    for row in sorted(sizes):
        starts[row.part], before = before, before + row.n
    start = "CAST(0 AS BIGINT)" if not starts else f"map({', '.join(f'{p}L, {n}L' for p, n in starts.items())})[{part}]"
    ranked = placed.withColumn(rank, F.expr(f"{start} + (_place & 8589934591L) + 1"))
    full_refresh(ranked.drop("_place"), target)


class _Replacement:
    """The new contents of one target, written beside it and put in its place by renaming."""

    def __init__(self, spark: SparkSession, target: str, run: str):
        self.spark, self.target = spark, target.rstrip("/")
        self.new, self.old = f"{self.target}__new_{run}", f"{self.target}__old_{run}"
        self.kept_old = self.put_new = False

    def write(self, df: DataFrame) -> None:
        if is_folder(self.target):
            df.write.mode("errorifexists").parquet(self.new)
        elif self.exists(self.target):
            self.spark.sql(f"CREATE TABLE {self.new} LIKE {self.target}")
            in_table_order(df, self.target).write.insertInto(self.new, overwrite=True)
        else:
            df.write.mode("errorifexists").format("parquet").saveAsTable(self.new)

    def swap(self) -> None:
        if self.exists(self.target):
            self._rename(self.target, self.old)
            self.kept_old = True
        self._rename(self.new, self.target)
        self.put_new = True

    def revert(self) -> None:
        if self.put_new:
            self._rename(self.target, self.new)
            self.put_new = False
        if self.kept_old:
            self._rename(self.old, self.target)
            self.kept_old = False

    def discard(self, name: str) -> None:
        if is_folder(self.target):
            files, path = self._files(name)
            files.delete(path, True)
        else:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def exists(self, name: str) -> bool:
        if is_folder(self.target):
            files, path = self._files(name)
            return files.exists(path)
        return self.spark.catalog.tableExists(name)

    def _files(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _rename(self, name: str, to: str) -> None:
        if not is_folder(self.target):
            self.spark.sql(f"ALTER TABLE {name} RENAME TO {to}")
            return
        files, path = self._files(name)
        if not files.rename(path, self._files(to)[1]):
            raise OSError(f"{name} could not be renamed to {to}")


def refresh_together(spark: SparkSession, reports: Mapping[str, Callable[[], DataFrame]]) -> None:
    """Replace many targets (target -> report) so that either all change or none does.

    Every report is written in full beside its target first; if one fails, the others' new rows are dropped
    and no target has changed. Then targets are exchanged by renaming, which moves no data on file systems
    with a rename; if a renaming fails those before it are taken back. Old contents are dropped at the end.
    Readers may see some targets renamed before others, never a half-written one.
    """
    if len({t.rstrip("/") for t in reports}) < len(reports):
        raise ValueError("a target is named twice")
    run = uuid.uuid4().hex[:12]
    replacements = [_Replacement(spark, target, run) for target in reports]
    try:
        for replacement, report in zip(replacements, reports.values(), strict=True):
            replacement.write(report())
        for replacement in replacements:
            replacement.swap()
    except BaseException:
        for replacement in reversed(replacements):
            replacement.revert()
            with suppress(PySparkException, Py4JError):  # the first error is the one to report
                replacement.discard(replacement.new)
        raise
    for replacement in replacements:
        if replacement.kept_old:
            replacement.discard(replacement.old)
