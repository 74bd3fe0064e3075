"""Passages that repeat, exactly or with small edits, across documents: collinear chaining of seeds.

Seeds are k-word runs, thinned to window minimisers (the least hash of each window), so that equal
passages keep the same seeds. Each seed links its first document with all others that hold it, and so
does each run of three neighbouring seeds at equal distances: where common phrases scatter the seeds of a
passage over many first documents, its longer runs still lead to one that holds more of it. A popular
passage costs a few links a document, never all pairs. The matches of a pair of documents are chained in
order, with gap costs, by range maxima in a Fenwick tree; chains are then aligned word by word, between
the seeds and outwards, cut at their worst gaps until the pieces are similar enough, and kept if long.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import Staging
from shelfmark.llm.minhash import mix, word_hashes

#: Words of a seed, and seeds of a window of which the least is kept. Two texts that share a run of
#: 2 * WINDOW + SEED - 1 = 37 words share at least two seeds of it.
SEED = 6
WINDOW = 16
#: Neighbouring seeds of the runs that link documents besides single seeds. A run spans about 23 words, 38 at most.
RUN = 3
#: A passage has at least MIN_WORDS words in both documents and this share of aligned words.
MIN_WORDS = 50
SIMILARITY = 0.75
#: Cost of each word between two seeds of a chain; a gap over MAX_GAP words ends a chain.
GAP_COST = 0.05
MAX_GAP = 100
#: Words around a chain within which its alignment may grow.
REACH = 200
_LINES = 1 << 31
_FACTOR = np.uint64(0xD6E8FEB86659FD93)


def minimizers(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the seeds of one text."""
    n = len(words) - SEED + 1
    if n < 1:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    runs = words[:n].copy()
    for i in range(1, SEED):
        runs = runs * _FACTOR + words[i : n + i]
    runs = mix(runs)
    if n <= WINDOW:
        at = np.array([int(runs.argmin())])
    else:
        views = np.lib.stride_tricks.sliding_window_view(runs, WINDOW)
        at = np.unique(views.argmin(axis=1) + np.arange(len(views)))
    return runs[at], at


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Keys and word hashes of the texts of a batch, a few at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, 128):
            some = batch.slice(start, 128)
            words, counts = word_hashes(some.column(1).cast(pa.binary()).to_pylist())
            yield some.column(0).to_pylist(), np.split(words, np.cumsum(counts)[:-1]) if len(counts) else []


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for keys, texts in _each(batches):
        found = [minimizers(w) for w in texts]
        sizes = [len(at) for _, at in found]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([h for h, _ in found]).view(np.int64)),
                pa.array(np.repeat(np.array(keys, dtype=np.int64), sizes)),
                pa.array(np.concatenate([at for _, at in found]).astype(np.int32)),
                pa.array(np.concatenate([np.arange(n, dtype=np.int32) for n in sizes])),
            ],
            names=["seed", "doc", "at", "nth"],
        )


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for keys, texts in _each(batches):
        packed = [(w >> np.uint64(32)).astype("<u4").tobytes() for w in texts]
        yield pa.RecordBatch.from_arrays([pa.array(keys, type=pa.int64()), pa.array(packed, type=pa.binary())], names=["doc", "words"])


class Fenwick:
    """Maxima of values over ranges of places, among those put at a time that has not expired.

    Times of ``put`` and ``best`` never fall. A node keeps a queue of the values that can still become its
    maximum: later ones push out smaller ones before them.
    """

    def __init__(self, n: int):
        self.nodes: list[deque] = [deque() for _ in range(n + 1)]
        self.places: list[deque] = [deque() for _ in range(n)]

    def put(self, place: int, time: int, value: tuple[float, int]) -> None:
        self._push(self.places[place], time, value)
        place += 1
        while place < len(self.nodes):
            self._push(self.nodes[place], time, value)
            place += place & -place

    def best(self, low: int, high: int, since: int) -> tuple[float, int]:
        """The maximum over places ``low`` to ``high - 1``, put at ``since`` or later."""
        out = (-1e18, -1)
        while high > low:
            whole = high - (high & -high) >= low
            queue = self.nodes[high] if whole else self.places[high - 1]
            while queue and queue[0][0] < since:
                queue.popleft()
            if queue:
                out = max(out, queue[0][1])
            high -= high & -high if whole else 1
        return out

    @staticmethod
    def _push(queue: deque, time: int, value: tuple[float, int]) -> None:
        while queue and queue[-1][1] <= value:
            queue.pop()
        queue.append((time, value))


def chains(left: list[int], right: list[int]) -> list[list[int]]:
    """Chains of matches (indices), best first; ``left`` and ``right`` are places in the two texts.

    A chain ascends in both texts, by ``MAX_GAP`` words beyond a seed at most. Its score is the words it
    covers less the gap costs; since the cost of a step is a difference of terms of its two ends, the best
    predecessor is the maximum over the matches within that distance.
    """
    order = sorted(range(len(left)), key=lambda i: (right[i], -left[i]))
    places = sorted(set(left))
    ranks = {a: r for r, a in enumerate(places)}
    tree = Fenwick(len(places))
    score, parent = [0.0] * len(left), [-1] * len(left)
    waiting: list[int] = []  # matches at the current place on the right: no chain has two of them

    def flush() -> None:
        for i in waiting:
            tree.put(ranks[left[i]], right[i], (score[i] + GAP_COST * (left[i] + right[i]), i))
        waiting.clear()

    reach = MAX_GAP + SEED
    for n, i in enumerate(order):
        if n and right[order[n - 1]] != right[i]:
            flush()
        value, j = tree.best(bisect_left(places, left[i] - reach), ranks[left[i]], right[i] - reach)
        score[i] = float(SEED)
        if j >= 0:
            step = min(left[i] - left[j], right[i] - right[j])
            gained = value - GAP_COST * (left[i] + right[i]) + min(SEED, step)
            if gained > score[i]:
                score[i], parent[i] = gained, j
        waiting.append(i)
    used, out = [False] * len(left), []
    for i in sorted(range(len(left)), key=lambda i: (-score[i], right[i], left[i])):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = parent[i]
        if chain:
            out.append(chain[::-1])
    return out


def _chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for a, b, matches in zip(batch["a"], batch["b"], batch["matches"], strict=True):
            right, left = zip(*sorted({(m["at"], m["first_at"]) for m in matches}), strict=True)
            for chain in chains(left, right):
                if len(chain) > 1:
                    x, y = [left[i] for i in chain], [right[i] for i in chain]
                    rows.append((a, b, x, y, max(0, x[0] - REACH), x[-1] + SEED + REACH, max(0, y[0] - REACH), y[-1] + SEED + REACH))
        yield pd.DataFrame(rows, columns=["a", "b", "left", "right", "a0", "a1", "b0", "b1"])


_CHAINS = "a long, b long, left array<int>, right array<int>, a0 int, a1 int, b0 int, b1 int"


def aligned(x: np.ndarray, y: np.ndarray) -> int:
    """Words on the diagonal of a least-edit alignment of two short runs."""
    if len(x) == len(y) and (x == y).all():
        return len(x)
    if not len(x) or not len(y):
        return 0
    # Most equal words in order, one row of the table at a time.
    row = np.zeros(len(y) + 1, dtype=np.int32)
    for w in x:
        step = np.concatenate([[0], np.where(y == w, row[:-1] + 1, row[1:])])
        row = np.maximum.accumulate(np.maximum(step, row))
    return int(row[-1])


def grow(x: np.ndarray, y: np.ndarray) -> tuple[int, int, int]:
    """How far two runs agree from their starts: words taken of each, and those that are equal.

    Edits are bridged if three equal words follow within six.
    """
    i = j = same = 0
    while i < len(x) and j < len(y):
        n = min(len(x) - i, len(y) - j)
        differ = np.flatnonzero(x[i : i + n] != y[j : j + n])
        run = int(differ[0]) if len(differ) else n
        i, j, same = i + run, j + run, same + run
        if run == n:
            break
        ahead, after = x[i : i + 9].tolist(), y[j : j + 9].tolist()
        threes: dict[tuple, list[int]] = {}
        for e in range(len(after) - 2):
            threes.setdefault(tuple(after[e : e + 3]), []).append(e)
        bridge = min(((d + e, d, e) for d in range(len(ahead) - 2) for e in threes.get(tuple(ahead[d : d + 3]), ())), default=None)
        if bridge is None:
            break
        i, j = i + bridge[1], j + bridge[2]
    return i, j, same


def similar_parts(x: np.ndarray, y: np.ndarray, left: list[int], right: list[int]) -> list[tuple[int, int, int, int, float]]:
    """``(start, words, start, words, similarity)`` in both runs for the similar, long parts of a chain.

    A chain that is not similar enough as a whole is cut where most words between two seeds differ, and
    so are its parts.
    """
    same = np.array([aligned(x[p:q], y[r:s]) for p, q, r, s in zip(left, left[1:], right, right[1:], strict=False)], dtype=np.int64)
    left_at, right_at = np.array(left), np.array(right)
    lost = np.maximum(np.diff(left_at), np.diff(right_at)) - same
    out, parts, low_x, low_y = [], [(0, len(left) - 1)], 0, 0
    while parts:
        i, j = parts.pop()
        # Parts come in order, and none reaches back into one that was kept before it.
        if left[i] < low_x or right[i] < low_y:
            continue
        end_x, end_y = (left[j + 1], right[j + 1]) if j + 1 < len(left) else (len(x), len(y))
        back = grow(x[low_x : left[i]][::-1], y[low_y : right[i]][::-1])
        on = grow(x[left[j] : end_x], y[right[j] : end_y])
        a, b = left[i] - back[0], right[i] - back[1]
        n, m = left[j] + on[0] - a, right[j] + on[1] - b
        equal = back[2] + on[2] + int(same[i:j].sum())
        if equal >= SIMILARITY * max(n, m):
            if min(n, m) >= MIN_WORDS:
                out.append((a, n, b, m, equal / max(n, m)))
                low_x, low_y = a + n, b + m
        elif i < j:
            cut = i + int(lost[i:j].argmax())
            parts += [(cut + 1, j), (i, cut)]
    return out


def _align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for c in batch.itertuples(index=False):
            x, y = np.frombuffer(c.x, dtype="<u4"), np.frombuffer(c.y, dtype="<u4")
            left, right = [p - c.a0 for p in c.left], [p - c.b0 for p in c.right]
            for a, n, b, m, similarity in similar_parts(x, y, left, right):
                rows.append((c.b, c.b0 + b, m, c.a, c.a0 + a, n, similarity))
        yield pd.DataFrame(rows, columns=["doc", "start", "n", "first", "first_start", "first_n", "similarity"])


_FOUND = "doc long, start int, n int, first long, first_start int, first_n int, similarity double"


def _firsts(held: DataFrame, key: str) -> DataFrame:
    """``(key, a, first_at)``: the first place of each key that several documents hold."""
    place = f"CAST(doc AS DECIMAL(20, 0)) * {_LINES} + at"
    firsts = held.groupBy(key).agg(F.expr(f"min({place})").alias("first"), F.min("doc").alias("low"), F.max("doc").alias("high"))
    return firsts.where("low < high").selectExpr(key, "low AS a", f"CAST(pmod(first, {_LINES}) AS INT) AS first_at")


def _runs(shared: DataFrame) -> DataFrame:
    """``(run, span, doc, at)``: hashes of ``RUN`` seeds and their distances, neighbours among all seeds of a document."""
    after = Window.partitionBy("doc").orderBy("nth")
    ahead = range(1, RUN)
    for i in ahead:
        shared = shared.withColumn(f"s{i}", F.lead("seed", i).over(after)).withColumn(f"d{i}", F.lead("at", i).over(after) - F.col("at"))
    shared = shared.withColumn("last", F.lead("nth", RUN - 1).over(after)).where(f"last = nth + {RUN - 1}")
    return shared.selectExpr(f"xxhash64(seed, {', '.join(f's{i}, d{i}' for i in ahead)}) AS run", f"d{RUN - 1} AS span", "doc", "at")


def repeated_passages(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, start_word, n_words, first_key, first_start_word, first_n_words, similarity)`` for each repeated passage.

    A row says that the words from ``start_word`` (counted from 0, A-Z lower-cased) of a document
    repeat those of an earlier one, the document with the smallest key that holds a seed, or a run of
    seeds, of them;
    ``similarity`` is the share of aligned words. Passages have ``MIN_WORDS`` words at least in both.
    A document may have several rows, also for overlapping passages of different earlier documents.

    NULL, empty and short texts have no passages; rows without a key take no part; rows that share
    a key are one document whose parts are not compared with each other. An empty table gives no
    rows. Other columns are not read.
    """
    staging = Staging(documents.sparkSession)
    rows = documents.where(f"{key} IS NOT NULL AND length({text}) > 0").select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    seeds = staging.keep(rows.mapInArrow(_seeds, "seed long, doc long, at int, nth int"), "seeds")
    firsts = staging.keep(_firsts(seeds, "seed"), "firsts")
    shared = staging.keep(seeds.join(firsts, "seed"), "shared")
    runs = staging.keep(_runs(shared.select("seed", "doc", "at", "nth")), "runs")
    ends = runs.join(staging.keep(_firsts(runs, "run"), "first-runs"), "run")
    ends = ends.selectExpr("doc", "a", "explode(array(0, span)) AS on", "at", "first_at").selectExpr("doc", "a", "at + on AS at", "first_at + on AS first_at")
    matches = shared.select("doc", "a", "at", "first_at").union(ends).where("doc != a")
    pairs = matches.groupBy("a", F.col("doc").alias("b")).agg(F.collect_set(F.struct("at", "first_at")).alias("matches"))
    chained = staging.keep(pairs.where("size(matches) > 1").mapInPandas(_chain, _CHAINS), "chains")
    needed = chained.selectExpr("explode(array(a, b)) AS doc").distinct()
    words = staging.keep(rows.join(needed, "doc", "left_semi").mapInArrow(_coded, "doc long, words binary"), "words")
    both = chained.join(words.selectExpr("doc AS a", "words AS wa"), "a").withColumn("x", F.expr("substring(wa, a0 * 4 + 1, (a1 - a0) * 4)")).drop("wa")
    both = both.join(words.selectExpr("doc AS b", "words AS wb"), "b").withColumn("y", F.expr("substring(wb, b0 * 4 + 1, (b1 - b0) * 4)")).drop("wb")
    found = both.select("a", "b", "left", "right", "a0", "b0", "x", "y").mapInPandas(_align, _FOUND)
    return found.distinct().selectExpr(
        f"doc AS {key}", "start AS start_word", "n AS n_words", f"first AS first_{key}", "first_start AS first_start_word", "first_n AS first_n_words", "similarity"
    )
