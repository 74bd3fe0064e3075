"""Item similarity: stored top-k laid out in columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rank_pivot(
    rows: DataFrame, key: str, rank: str, values: dict[str, Sequence[str]], also: Sequence[str] = ()
) -> DataFrame:
    """One row per key with one column per rank: ``values`` maps a value column to the output
    names of its ranks 1, 2, ...; ``also`` adds plain aggregates."""
    picks = [
        f"max(CASE WHEN {rank} = {i} THEN {value} END) AS {name}"
        for value, names in values.items()
        for i, name in enumerate(names, 1)
    ]
    return rows.groupBy(key).agg(*map(F.expr, [*picks, *also]))


def top_by_stored_rank(snapshot: DataFrame, item: str, other: str, k: int = 5) -> DataFrame:
    """The k most similar items of each item that has a rank-1 neighbour."""
    names = [f"top_{i}_line" for i in range(1, k + 1)]
    ranked = snapshot.filter(f"rank BETWEEN 1 AND {k}")
    pivoted = rank_pivot(ranked, item, "rank", {other: names}, ["count_if(rank = 1) AS firsts"])
    return pivoted.filter("firsts > 0").select(item, *names)


def order_by_popularity(rows: DataFrame, item: str, sales: DataFrame, line: str) -> DataFrame:
    """Sort by this year's transactions of the line, most first, then by name."""
    popularity = sales.groupBy(line).agg(F.expr("count(DISTINCT parent_order_id) AS transactions"))
    joined = rows.join(popularity.withColumnRenamed(line, "sold"), F.expr(f"{item} = sold"), "left")
    return joined.orderBy(F.expr("coalesce(transactions, 0)").desc(), item).select(*rows.columns)
