"""Hard negatives by exact search in an inverted multi-index.

Each half of a vector has a small codebook; the two codes of a vector name its cell. The score of a
vector of a cell is at most the sum of two half bounds: the anchor half's product with the centroid plus
its length times the radius of the code. A heap over the two descending lists of half bounds yields the
cells by descending sum (multi-sequence search). A search stops when the bound of the next cell proves
that nothing better is left: below the fifth positive, or below what each window still lacks.

Rows lie in blocks by a hash of their place, so a hot label, cell or copy is spread over all of them. Every
group of anchors meets every block; each block answers with at most five rows a question, and the
answers are ranked together. A row therefore crosses the network once for each group of anchors.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import Staging

#: Rows of a block and anchors of a group, on average.
BLOCK_ROWS = 8192
ANCHOR_ROWS = 2048
#: Centroids of a half, and the rows (on average, by a hash) their codebooks are fitted on.
CODES = 16
SAMPLE = 4096
ROUNDS = 8
#: Rows scored between two looks at the bounds; doubled each time.
FIRST_BATCH = 256
#: Whole numbers below this are exact as doubles.
EXACT = 1 << 53


def usable(vectors: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """``(id, label, vector)`` of the rows that have all three and only finite components."""
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(label_column).cast("long").alias("label"),
        F.col(vector_column).cast("array<double>").alias("vector"),
    )
    finite = "forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < DOUBLE('Infinity'))"
    return rows.where(f"id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND {finite}")


def _scaled(vector: np.ndarray, scale: float) -> np.ndarray:
    whole = np.floor(scale * np.asarray(vector, dtype="f8"))
    if whole.size and np.abs(whole).max() >= 2.0**62:
        raise ValueError("a scaled component does not fit into a 64-bit integer")
    return whole.astype("<i8")


def _pack(scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = [_scaled(v.values.to_numpy(zero_copy_only=False), scale) for v in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(v) for v in whole], pa.int32()), pa.array([v.tobytes() for v in whole], pa.binary())],
                names=["id", "label", "width", "packed"],
            )

    return run


def fit_codebook(halves: np.ndarray, codes: int) -> np.ndarray:
    """Centroids by some rounds of Lloyd's algorithm from evenly spaced rows."""
    if not len(halves):
        return np.zeros((1, halves.shape[1]))
    centroids = halves[np.unique(np.linspace(0, len(halves) - 1, codes).astype(int))].astype("f8")
    for _ in range(ROUNDS):
        nearest = _codes(halves, centroids)[0]
        counts = np.bincount(nearest, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, halves)
        centroids[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centroids


def _codes(halves: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code of the nearest centroid and the distance to it."""
    near = ((centroids**2).sum(1) - 2 * halves @ centroids.T).argmin(1)
    return near, np.sqrt(((halves - centroids[near]) ** 2).sum(1))


def product(rows: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows with one integer vector."""
    largest = int(np.abs(rows).max(initial=0)) * int(np.abs(one).max(initial=0)) * max(1, rows.shape[1])
    if largest < EXACT:
        return (rows.astype("f8") @ one.astype("f8")).astype("i8")
    if largest < 1 << 63:
        return rows @ one
    exact = rows.astype(object) @ one.astype(object)
    return np.array([int(x) for x in np.atleast_1d(exact)]).astype("i8")


class MultiIndex:
    """The rows of a block by cell, and the radii that bound their scores."""

    def __init__(self, vectors: np.ndarray, codebooks: tuple[np.ndarray, np.ndarray] | None):
        self.vectors = vectors
        self.half = vectors.shape[1] // 2
        parts = [vectors[:, : self.half].astype("f8"), vectors[:, self.half :].astype("f8")]
        self.books = codebooks or tuple(np.zeros((1, p.shape[1])) for p in parts)
        found = [_codes(p, c) for p, c in zip(parts, self.books, strict=True)]
        self.radii = [np.zeros(len(c)) for c in self.books]
        for radius, (near, far) in zip(self.radii, found, strict=True):
            np.maximum.at(radius, near, far)
        width = len(self.books[1])
        cell = found[0][0] * width + found[1][0]
        self.order = np.argsort(cell, kind="stable")
        numbers, starts = np.unique(cell[self.order], return_index=True)
        ends = np.append(starts[1:], len(cell))
        self.cells = {(int(n) // width, int(n) % width): (int(s), int(e)) for n, s, e in zip(numbers, starts, ends, strict=True)}
        self.used = [np.unique(near) for near, _ in found]
        # Rows of a cell lie side by side.
        self.by_cell = vectors[self.order]
        self.fast = self.by_cell.astype("f8")
        self.largest = int(np.abs(vectors).max(initial=0))

    def _bounds(self, anchor: np.ndarray, side: int) -> tuple[list[float], list[int]]:
        part = anchor[: self.half] if side == 0 else anchor[self.half :]
        part = part.astype("f8")
        used = self.used[side]
        bound = self.books[side][used] @ part + np.sqrt((part**2).sum()) * self.radii[side][used]
        order = np.argsort(-bound, kind="stable")
        return bound[order].tolist(), used[order].tolist()

    def visit(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """Rows (their places) and exact scores, cells by descending bound, and the bound of all that follows."""
        (u, code_u), (v, code_v) = self._bounds(anchor, 0), self._bounds(anchor, 1)
        wide = float(np.abs(anchor).sum()) * max(1, self.largest) * 1e-9 + 1e-6  # above any rounding of a bound
        heap, batch, held, size = [(-(u[0] + v[0]), 0, 0)], FIRST_BATCH, [], 0
        exact = self.largest * int(np.abs(anchor).max(initial=0)) * max(1, len(anchor)) < EXACT
        as_double = anchor.astype("f8")
        while heap:
            _, i, j = heapq.heappop(heap)
            if j + 1 < len(v):
                heapq.heappush(heap, (-(u[i] + v[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(u):
                heapq.heappush(heap, (-(u[i + 1] + v[0]), i + 1, 0))
            span = self.cells.get((code_u[i], code_v[j]))
            if span:
                held.append(span)
                size += span[1] - span[0]
            if held and (size >= batch or not heap):
                places = np.concatenate([np.arange(s, e) for s, e in held])
                scores = (self.fast[places] @ as_double).astype("i8") if exact else product(self.by_cell[places], anchor)
                yield self.order[places], scores, wide - heap[0][0] if heap else -math.inf
                held, size, batch = [], 0, 2 * batch


def _first(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    """Places of the ``count`` highest scores, ties by smaller id, then row."""
    if len(scores) > count:
        cut = np.partition(scores, len(scores) - count)[len(scores) - count]
        some = np.flatnonzero(scores >= cut)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((rows[some], ids[some], -scores[some]))[:count]]


def positives_of(index: MultiIndex, ids, rows, labels, anchor, label, own_row, count) -> list[tuple[int, int, int]]:
    """``(score, id, row)`` of the first rows of the anchor's label, without itself."""
    best = np.zeros((3, 0), dtype="i8")
    for places, scores, bound in index.visit(anchor):
        mine = (labels[places] == label) & (rows[places] != own_row)
        new = np.stack([scores[mine], ids[places[mine]], rows[places[mine]]])
        best = np.concatenate([best, new], axis=1)
        best = best[:, _first(best[0], best[1], best[2], count)]
        if best.shape[1] == count and best[0, -1] > bound:
            break
    return list(map(tuple, best.T.tolist()))


def negatives_of(index: MultiIndex, ids, rows, labels, anchor, label, positives, count) -> list[list[tuple[int, int, int]]]:
    """Per positive score the first rows of other labels with ``80 p <= 100 n <= 100 p``."""
    found = [np.zeros((3, 0), dtype="i8") for _ in positives]
    todo = [k for k, p in enumerate(positives) if 80 * p <= 100 * p]
    if not todo:
        return [[] for _ in positives]
    for places, scores, bound in index.visit(anchor):
        other = labels[places] != label
        new = np.stack([scores[other], ids[places[other]], rows[places[other]]])
        for k in list(todo):
            p, low = positives[k], -(-80 * positives[k] // 100)
            inside = new[:, (new[0] >= low) & (new[0] <= p)]
            if inside.shape[1]:
                both = np.concatenate([found[k], inside], axis=1)
                found[k] = both[:, _first(both[0], both[1], both[2], count)]
            if bound < low or (found[k].shape[1] == count and found[k][0, -1] > bound):
                todo.remove(k)
        if not todo:
            break
    return [list(map(tuple, f.T.tolist())) for f in found]


def _unpack(rows: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(rows["packed"]), dtype="<i8").reshape(len(rows), -1)


def _search(codebooks: dict[int, tuple[np.ndarray, np.ndarray]], count: int, windows: bool):
    """One block against one group of anchors."""

    def run(key, block: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(block) and len(anchors):
            block = block.sort_values("row")
            ids, rows, labels = (block[c].to_numpy() for c in ("id", "row", "label"))
            index = MultiIndex(_unpack(block), codebooks.get(int(block["width"].iloc[0])))
            vectors = _unpack(anchors)
            columns = [anchors["row"], anchors["label"], *([anchors["positives"]] if windows else [])]
            for anchor, row, label, *rest in zip(vectors, *columns, strict=True):
                if windows:
                    scores = [p["score"] for p in rest[0]]
                    for slot, found in enumerate(negatives_of(index, ids, rows, labels, anchor, label, scores, count)):
                        out += [(row, slot, *f) for f in found]
                else:
                    out += [(row, 0, *f) for f in positives_of(index, ids, rows, labels, anchor, label, row, count)]
        return pd.DataFrame(out, columns=["anchor_row", "slot", "score", "id", "found_row"])

    return run


def hard_negatives(
    vectors: DataFrame,
    anchors: str = "id % 100 = 0",
    relabel: str = "label",
    scale: float = 256.0,
    count: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    block_rows: int = BLOCK_ROWS,
    anchor_rows: int = ANCHOR_ROWS,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Components are scaled and floored to whole numbers; a score is the exact inner product of two such
    vectors. Anchors are the rows where the SQL condition ``anchors`` over ``id`` and ``label`` holds;
    ``relabel`` is SQL for the label that counts. An anchor's positives are its first ``count`` other rows of
    the same label by score, ties by smaller id; for each, the first ``count`` rows of another label whose
    score is at least 80 % of the positive's and not above it are ranked. All rows are searched.

    Rows with a NULL id, label, vector or component, or a component that is not finite, take no part. Vectors
    of different lengths have no product and do not meet; empty vectors have the product 0. Rows that share
    an id are rows of their own, ties between them go by their place in the stored table. An anchor without
    positives, and a positive without negatives in its window, give no rows; so does an empty table. Scaled
    components beyond 64 bits, and scores beyond, raise an error. Other columns, whatever their names, are
    left out.
    """
    spark = vectors.sparkSession
    staging = Staging(spark)
    packed = usable(vectors, id_column, vector_column, label_column).mapInArrow(
        _pack(scale), "id long, label long, width int, packed binary"
    )
    labelled = packed.selectExpr("id", f"CAST({relabel} AS BIGINT) AS label", "width", "packed").where("label IS NOT NULL")
    rows = staging.keep(labelled.withColumn("row", F.monotonically_increasing_id()), "rows")
    chosen = rows.where(anchors)
    n_rows, n_anchors = rows.count(), chosen.count()
    n_blocks, n_groups = max(1, math.ceil(n_rows / block_rows)), max(1, math.ceil(n_anchors / anchor_rows))

    share = min(1.0, SAMPLE / max(1, n_rows))
    sample = rows.where(f"pmod(xxhash64(row, 'sample'), 1048576) < {math.ceil(share * 1048576)}")
    codebooks = _fit(sample.select("width", "packed").toPandas())

    blocks = rows.selectExpr("*", f"pmod(xxhash64(row, 'block'), {n_blocks}) AS block", f"explode(sequence(0L, {n_groups - 1}L)) AS group")
    everywhere = [f"pmod(xxhash64(row, 'group'), {n_groups}) AS group", f"explode(sequence(0L, {n_blocks - 1}L)) AS block"]
    cell, found = ["width", "block", "group"], "anchor_row long, slot int, score long, id long, found_row long"

    def search(asked: DataFrame, windows: bool) -> DataFrame:
        near = blocks.groupBy(*cell).cogroup(asked.selectExpr("*", *everywhere).groupBy(*cell))
        ranked = near.applyInPandas(_search(codebooks, count, windows), found).selectExpr(
            "*", "row_number() OVER (PARTITION BY anchor_row, slot ORDER BY score DESC, id, found_row) AS rank"
        )
        return ranked.where(f"rank <= {count}")

    first = search(chosen.select("width", "row", "label", "packed"), windows=False)
    listed = first.groupBy("anchor_row").agg(F.expr("sort_array(collect_list(struct(rank, score, id))) AS positives"))
    asked = chosen.join(listed, F.expr("row = anchor_row")).select("width", "row", "id", "label", "packed", "positives")
    asked = staging.keep(asked, "anchors")
    second = search(asked.drop("id"), windows=True)
    # Anchors back to their answers: both sides are as many as anchors.
    named = asked.selectExpr("row AS named_row", "id AS anchor_id", "posexplode(positives) AS (place, positive)")
    joined = second.join(named, F.expr("anchor_row = named_row AND slot = place"))
    return joined.selectExpr(
        "anchor_id",
        "positive.id AS positive_id",
        "CAST(rank AS INT) AS rank",
        "id AS negative_id",
        "positive.score AS positive_score",
        "score AS negative_score",
    )


def _fit(sample: pd.DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Both codebooks of each vector length of the sample; other lengths are searched as one cell."""
    books = {}
    for width, rows in sample.groupby("width"):
        whole = _unpack(rows).astype("f8")
        books[int(width)] = (fit_codebook(whole[:, : width // 2], CODES), fit_codebook(whole[:, width // 2 :], CODES))
    return books


#: DuckDB SQL for the query's rows over the table ``embeddings``.
QUERY_SQL = """
WITH usable AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""
