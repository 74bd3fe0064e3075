"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing.

Vectors get one more component so that all have the same length (the largest); queries get a zero
there. The largest inner product is then the smallest Euclidean distance, for which p-stable hashes
(projections on Gaussian directions, cut into slots) collide. Each table visits, besides a query's
own bucket, buckets with some slots moved by one, in the order of their estimated success. The
candidates of all tables are merged and ranked by exact inner products. Every vector's bucket keys
are stored once; the stated queries then meet the stored index block by block, so that candidates
are merged where the vectors are and only each block's best leave it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import Staging

#: Nearest neighbours asked for.
NEAREST = 20
#: Tables, projections a table, and buckets a query visits in each table.
TABLES = 24
PROJECTIONS = 8
PROBES = 64
#: Width of a slot as a share of the typical distance between a query and its neighbours (fitted on a sample).
WIDTH = 1.5
#: Vectors and queries the fit may look at.
FIT_ROWS = 2_000
FIT_QUERIES = 100
#: Vectors and queries that meet in one task.
BLOCK = 16_384
QUERY_BLOCK = 1_024
_TAG = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class Index:
    """Directions, offsets and slot width, and the length all vectors are lifted to."""

    directions: np.ndarray  # tables * projections, dim + 1
    offsets: np.ndarray
    width: float
    length: float

    def lift(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0.0, self.length**2 - np.einsum("ij,ij->i", x, x)))
        return np.column_stack([x, rest])

    def place(self, x: np.ndarray) -> np.ndarray:
        """Slot coordinates (whole part: slot, fraction: place in it), one row a vector."""
        return (x @ self.directions.T) / self.width + self.offsets


def probe_order(fractions: np.ndarray, probes: int) -> list[dict[int, int]]:
    """Moves of slots (projection -> -1 or 1) in the order of estimated success, the empty one first.

    The score of a move is the squared distance to the slot's edge; a set of moves has the sum.
    Sets come from a heap by shifting or extending the last move, sets that move a slot both ways
    are passed over.
    """
    moves = sorted([(f * f, i, -1) for i, f in enumerate(fractions)] + [((1 - f) ** 2, i, 1) for i, f in enumerate(fractions)])
    out: list[dict[int, int]] = [{}]
    heap: list[tuple[float, list[int]]] = [(moves[0][0], [0])]
    while heap and len(out) < probes:
        score, chosen = heappop(heap)
        step = {moves[c][1]: moves[c][2] for c in chosen}
        if len(step) == len(chosen):
            out.append(step)
        last = chosen[-1] + 1
        if last < len(moves):
            heappush(heap, (score - moves[chosen[-1]][0] + moves[last][0], [*chosen[:-1], last]))
            heappush(heap, (score + moves[last][0], [*chosen, last]))
    return out


def _keys(slots: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """A bucket key for each row of slots in its table."""
    key = tables.astype(np.uint64) * np.uint64(_TAG)
    for i in range(slots.shape[-1]):
        key = (key ^ slots[..., i].astype(np.int64).view(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def _visits(index: Index, v: np.ndarray) -> np.ndarray:
    """Keys of the buckets a query visits in all tables."""
    # A query's length does not change its neighbours: it is scaled to the common length.
    x = np.append(v * (index.length / np.linalg.norm(v)), 0.0)
    placed = index.place(x[None, :]).reshape(TABLES, PROJECTIONS)
    slots = np.floor(placed)
    probed = np.repeat(slots[:, None, :], PROBES, axis=1)
    for t in range(TABLES):
        for i, step in enumerate(probe_order(placed[t] - slots[t], PROBES)):
            for p, d in step.items():
                probed[t, i, p] += d
    return np.unique(_keys(probed, np.broadcast_to(np.arange(TABLES)[:, None], (TABLES, PROBES))))


def _candidates(n: int, visits: np.ndarray, keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Marks the rows of a block in visited buckets; ``keys`` are all its bucket keys in order, ``rows`` their rows."""
    starts, stops = np.searchsorted(keys, visits, "left"), np.searchsorted(keys, visits, "right")
    sizes = stops - starts
    at = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
    near = np.zeros(n, dtype=bool)
    near[rows[at]] = True
    return near


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``(id, v)``: rows with a key and a vector of finite numbers that is not all zero."""
    rows = vectors.where(f"{key} IS NOT NULL AND size({vector}) > 0").select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")
    )
    bad = "exists(v, x -> x IS NULL OR isnan(x) OR abs(x) = double('Infinity'))"
    return rows.where(f"NOT {bad} AND exists(v, x -> x != 0)")


def fit(rows: DataFrame, seed: int) -> Index | None:
    """Fit on at most ``FIT_ROWS`` rows with the smallest hashes; the greatest length is that of all rows.

    The slot width is that share of the median distance from sampled queries to their nearest
    sampled vectors which the constants name. None if there are no rows.
    """
    longest = rows.select(F.expr("max(sqrt(aggregate(v, 0D, (s, x) -> s + x * x)))")).first()[0]
    if longest is None:
        return None
    sample = rows.orderBy(F.expr("xxhash64(id, v)"), "id").limit(FIT_ROWS).select("v").collect()
    dim = max(len(r[0]) for r in sample)
    x = np.array([r[0] for r in sample if len(r[0]) == dim])
    rng = np.random.default_rng(seed)
    n = TABLES * PROJECTIONS
    index = Index(rng.standard_normal((n, dim + 1)), rng.random(n), 1.0, float(longest))
    queries = x[:FIT_QUERIES]
    queries = queries * (longest / np.linalg.norm(queries, axis=1))[:, None]
    lifted = index.lift(x)
    distances = np.sqrt(np.maximum(0.0, 2 * longest**2 - 2 * queries @ lifted[:, :-1].T))
    near = np.sort(distances, axis=1)[:, : max(2, min(NEAREST, len(x)))]
    width = max(float(np.median(near[:, -1])) * WIDTH, 1e-9 * float(longest))
    return Index(index.directions, index.offsets, width, float(longest))


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = NEAREST, key: str = "vec_id", vector: str = "embedding", seed: int = 11
) -> DataFrame:
    """``(query_id, rank, key, score)``: the nearest ``vectors`` found for each row of ``queries``.

    Nearness is the largest inner product of the original vectors in double precision, ties go to the
    smaller key, a row is no neighbour of itself. Vectors that are NULL, zero, or hold NULL or
    non-finite numbers take no part; a query and a vector of different lengths never meet. Equal
    vectors are searched once: of each group the ``k + 1`` smallest keys can be neighbours, all the
    others come after them. Rows that share a key and a vector count once. A query with fewer than
    ``k`` candidates in its buckets of a block is compared with that whole block. Empty tables give no
    rows.
    """
    spark = vectors.sparkSession
    staging = Staging(spark)
    rows = staging.keep(usable(vectors, key, vector).distinct(), "rows")
    asked = staging.keep(usable(queries, key, vector).distinct(), "asked")
    schema = f"query_id long, rank int, {key} long, score double"
    index = fit(rows, seed)
    if index is None or asked.isEmpty():
        return spark.createDataFrame([], schema)
    dim = index.directions.shape[1] - 1

    # One row for each distinct vector. Keys beyond the k + 1 smallest can't be among k nearest.
    slotted = rows.groupBy("v", F.expr("pmod(xxhash64(id), 64)").alias("salt")).agg(F.array_sort(F.collect_set("id")).alias("ids"))
    slotted = slotted.withColumn("ids", F.slice("ids", 1, k + 1))
    groups = staging.keep(
        slotted.groupBy("v").agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, k + 1).alias("ids")).withColumn("g", F.col("ids")[0]),
        "groups",
    )
    wanted = staging.keep(asked.groupBy("v").agg(F.min("id").alias("q")), "wanted")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[batch["v"].map(len) == dim]
            if len(batch):
                placed = index.place(index.lift(np.stack(batch["v"].to_numpy()))).reshape(len(batch), TABLES, PROJECTIONS)
                keys = _keys(np.floor(placed), np.broadcast_to(np.arange(TABLES), (len(batch), TABLES)))
                yield pd.DataFrame({"g": batch["g"], "v": batch["v"], "keys": list(keys)})

    placed = groups.select("g", "v").mapInPandas(place, "g long, v array<double>, keys array<long>")
    stored = staging.keep(placed, "index")
    blocks, query_blocks = -(-stored.count() // BLOCK), -(-wanted.count() // QUERY_BLOCK)

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[batch["v"].map(len) == dim]
            if len(batch):
                yield pd.DataFrame({"q": batch["q"], "v": batch["v"], "visits": [_visits(index, np.asarray(v)) for v in batch["v"]]})

    probing = wanted.select("q", "v").repartition(F.expr("pmod(xxhash64(q), 64)")).mapInPandas(visit, "q long, v array<double>, visits array<long>")
    probing = staging.keep(probing, "probing")

    def match(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        found: list[pd.DataFrame] = []
        if len(block) and len(queries):
            x, g = np.stack(block["v"].to_numpy()), block["g"].to_numpy()
            keys = np.stack(block["keys"].to_numpy()).reshape(-1)
            order = np.argsort(keys, kind="stable")
            keys, rows_of = keys[order], order // TABLES
            for q, v, visits in zip(queries["q"], queries["v"], queries["visits"], strict=True):
                near = _candidates(len(x), np.asarray(visits), keys, rows_of)
                if near.sum() <= k:
                    near[:] = True
                rows_near = np.flatnonzero(near)
                # Candidates that are many are cheaper to rank in place than to gather.
                score = (x @ np.asarray(v))[rows_near] if 4 * len(rows_near) > len(x) else x[rows_near] @ np.asarray(v)
                if len(score) > k + 1:  # with all that tie with the last, but for rounding
                    least = np.partition(score, -(k + 1))[-(k + 1)]
                    kept = score >= least - 1e-9 * max(1.0, abs(least))
                    rows_near = rows_near[kept]
                found.append(pd.DataFrame({"q": q, "g": g[rows_near]}))
        return pd.concat(found) if found else pd.DataFrame({"q": np.empty(0, np.int64), "g": np.empty(0, np.int64)})

    def spread(n: int, name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(max(0, n - 1)))).alias(name)

    left = probing.select("q", "v", "visits", F.expr(f"CAST(pmod(xxhash64(q), {max(1, query_blocks)}) AS INT)").alias("qb"), spread(blocks, "vb"))
    right = stored.select("g", "v", "keys", F.expr(f"CAST(pmod(xxhash64(g), {max(1, blocks)}) AS INT)").alias("vb"), spread(query_blocks, "qb"))
    matched = left.groupBy("qb", "vb").cogroup(right.groupBy("qb", "vb")).applyInPandas(match, "q long, g long")
    both = matched.join(wanted.selectExpr("q", "v AS x"), "q").join(groups.selectExpr("g", "ids", "v AS y"), "g")
    inner = "aggregate(zip_with(x, y, (s, t) -> s * t), 0D, (s, t) -> s + t)"
    scored = both.selectExpr("q", "ids", f"{inner} AS score")
    best = _top(scored.selectExpr("q", "explode(ids) AS id", "score"), "q", k + 1)
    # Back from a distinct query vector to its rows: each leaves itself out.
    owners = asked.join(wanted, "v").selectExpr("q", "id AS query_id")
    out = _top(owners.join(best, "q").where("query_id != id").select("query_id", "id", "score"), "query_id", k)
    return out.selectExpr("query_id", "CAST(rank AS INT) AS rank", f"id AS {key}", "score")


def _top(rows: DataFrame, by: str, k: int) -> DataFrame:
    """The ``k`` best of each group with their ranks. A window on the rank limits groups before the shuffle, too."""
    return rows.withColumn("rank", F.expr(f"row_number() OVER (PARTITION BY {by} ORDER BY score DESC, id)")).where(f"rank <= {k}")
