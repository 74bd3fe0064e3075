"""Relations that several reports of one refresh read: derived once, stored, read by all."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from shelfmark.sources.tables import Warehouse


class SharedRelations:
    """A warehouse that stores each named relation in ``folder`` when it is first asked for.

    ``folder`` must be one that the driver and all executors share. A stored relation is a Parquet table:
    it outlives lost executors, its readers take only the columns they need, and its ranks and reductions
    are not computed again. Every name stands for one relation of one calendar.
    """

    def __init__(self, warehouse: Warehouse, folder: str):
        self.spark = warehouse.spark
        self.folder = folder.rstrip("/")
        self.stored: dict[str, DataFrame] = {}
        self._warehouse = warehouse

    def table(self, name: str, columns: Sequence[str]) -> DataFrame:
        return self._warehouse.table(name, columns)

    def relation(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self.stored:
            df, path = build(), f"{self.folder}/{name}"
            df.write.mode("errorifexists").parquet(path)
            self.stored[name] = self.spark.read.schema(df.schema).parquet(path)
        return self.stored[name]


def shares(wh: Warehouse) -> bool:
    return hasattr(wh, "relation")


def relation(wh: Warehouse, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The stored relation where the warehouse shares them, else the plan that derives it."""
    return wh.relation(name, build) if shares(wh) else build()
