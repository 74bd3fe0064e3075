"""Near-duplicate documents by SuperMinHash signatures, banding, verification and components.

Every element of a set draws a permutation of the signature's places step by step and offers step
number plus a uniform draw to each place it visits. Offers of later steps are always larger, so a
set stops drawing as soon as all places hold offers of earlier steps. Places are filled evenly,
which makes the estimate less variable than with independent minima.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import ROW_KEY, Staging, bucket_components, connected_components, row_keys

SHINGLE = 5
#: Places of a signature; bands times rows. At a similarity of 0.75 a pair shares no band with probability 6e-6.
PLACES = 128
BANDS = 32
ROWS = PLACES // BANDS
#: Links: 100 * intersection >= LINK * union.
LINK = 75
#: Two bits of every place prune pairs before the exact check. A pair at the link threshold has 24 of
#: 128 places that differ in them on average, deviation 4.4; it has more than 48 with probability 1e-7.
SKETCH_LIMIT = 48
#: Elements signed at once at most, but for a single larger set; bounds a task's memory.
BATCH_ELEMENTS = 150_000

#: Sets of a cluster that one task compares with each other or with as many others.
BLOCK = 2_048

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_FACTOR = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z lower-cased, and the number of words of each text."""
    words: list[bytes] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        if text:
            own = text.lower().split()  # of bytes: A-Z and ASCII white space only
            counts[i] = len(own)
            words += own
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words)), counts


def shingle_sets(texts: list[bytes | None]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle, an empty one none."""
    words, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    joined = words.copy()
    for i in range(1, SHINGLE):
        joined[: max(0, len(words) - i)] = joined[: max(0, len(words) - i)] * _FACTOR + words[i:]
    joined = mix(joined)
    out = []
    for end, n in zip(ends.tolist(), counts.tolist(), strict=True):
        if n >= SHINGLE:
            out.append(np.unique(joined[end - n : end - SHINGLE + 1]))
        elif n:
            value = np.uint64(n)
            with np.errstate(over="ignore"):
                for w in words[end - n : end]:
                    value = value * _FACTOR + w
            out.append(mix(np.array([value], dtype=np.uint64)))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def signatures(sets: list[np.ndarray], places: int = PLACES) -> np.ndarray:
    """SuperMinHash signature of each set as a row; empty sets have infinite values."""
    sizes = np.array([len(s) for s in sets])
    held = np.full((len(sets), places), np.inf)
    flat = held.reshape(-1)
    values = np.concatenate(sets) if len(sets) else np.empty(0, dtype=np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order: np.ndarray | None = None
    first = np.empty(0, dtype=np.int64)
    for step in range(places):
        if step:
            open_rows = (held.max(axis=1) > step)[owner]
            if not open_rows.any():
                break
            if order is None:
                owner, values, first = owner[open_rows], values[open_rows], first[open_rows]
                order = np.tile(np.arange(places, dtype=np.uint8 if places <= 256 else np.int32), (len(owner), 1))
                order[np.arange(len(owner)), first] = 0
            elif not open_rows.all():
                owner, values, order = owner[open_rows], values[open_rows], order[open_rows]
        drawn = mix(values + np.uint64((step + 1) * int(_GOLDEN) % 2**64))
        offer = (drawn >> np.uint64(32)).astype(np.float64) * 2.0**-32 + step
        at = step + (((drawn & np.uint64(0xFFFFFFFF)) * np.uint64(places - step)) >> np.uint64(32)).astype(np.int64)
        if order is None:
            first = place = at
        else:
            line = np.arange(len(owner))
            place = order[line, at].astype(np.int64)
            order[line, at] = order[line, step]
        np.minimum.at(flat, owner * places + place, offer)
    return held


def bands(held: np.ndarray) -> np.ndarray:
    """A hash for each band of each signature; equal in two signatures where the band's places are."""
    bits = held.view(np.uint64).reshape(len(held), BANDS, ROWS)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _GOLDEN, (len(held), BANDS)).copy()
    for r in range(ROWS):
        out = mix(out * _FACTOR + bits[:, :, r])
    return out.view(np.int64)


def sketches(held: np.ndarray) -> np.ndarray:
    """Two bits of every place: two words with the first bits, then two with the second."""
    bits = mix(held.view(np.uint64))
    planes = [np.packbits(((bits >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), axis=1) for b in (0, 1)]
    return np.concatenate(planes, axis=1).view(np.int64)


_SIGNED = "doc_id long, c0 long, c1 long, n_shingles long, bands array<long>, sketch array<long>"


def _batches(sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    start = 0
    while start < len(sets):
        stop, total = start, 0
        while stop < len(sets) and (stop == start or total + len(sets[stop]) <= BATCH_ELEMENTS):
            total += len(sets[stop])
            stop += 1
        yield start, stop
        start = stop


def _in_slices(column: pa.Array) -> Iterator[tuple[int, list[bytes | None]]]:
    """Texts of a column in slices of about a million bytes."""
    texts = column.cast(pa.binary()).to_pylist()
    start = 0
    while start < len(texts):
        stop, size = start, 0
        while stop < len(texts) and (stop == start or size + len(texts[stop] or b"") <= 1_000_000):
            size += len(texts[stop] or b"")
            stop += 1
        yield start, texts[start:stop]
        start = stop


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, texts in _in_slices(batch.column(1)):
            sets = shingle_sets(texts)
            for start, stop in _batches(sets):
                some = sets[start:stop]
                held = signatures(some)
                digest = np.frombuffer(b"".join(hashlib.md5(s.tobytes()).digest() for s in some), dtype=np.int64).reshape(-1, 2)
                full = np.array([len(s) > 0 for s in some])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at + start, stop - start),
                        pa.array(digest[:, 0]),
                        pa.array(digest[:, 1]),
                        pa.array([len(s) for s in some], type=pa.int64()),
                        _lists(bands(held), full),
                        _lists(sketches(held), full),
                    ],
                    names=["doc_id", "c0", "c1", "n_shingles", "bands", "sketch"],
                )


def _lists(rows: np.ndarray, full: np.ndarray) -> pa.Array:
    """Rows as lists; empty lists for sets without elements."""
    ends = np.concatenate([[0], np.cumsum(full * rows.shape[1])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows[full].reshape(-1)))


def _as_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, texts in _in_slices(batch.column(1)):
            packed = pa.array([s.tobytes() for s in shingle_sets(texts)], type=pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), packed], names=["id", "elements"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for left, right in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            x, y = np.frombuffer(left, dtype=np.uint64), np.frombuffer(right, dtype=np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            found.append(100 * both >= LINK * (len(x) + len(y) - both))
        keep = pa.array(found, type=pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])


def _compare(group: pd.DataFrame) -> pd.DataFrame:
    """Links that join different components within one or two blocks of sets."""
    sets = [np.frombuffer(e, dtype=np.uint64) for e in group["elements"]]
    ids, labels = group["id"].to_numpy(), group["c"].to_numpy()
    sizes = np.array([len(s) for s in sets])
    values, flat = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    component = np.unique(labels, return_inverse=True)[1]
    largest = np.bincount(component).argmax()
    found = []
    for x in np.flatnonzero(component != largest).tolist():  # pairs within the largest need no link
        if (component == component[x]).all():
            break
        held = np.zeros(len(values), dtype=bool)
        held[flat[ends[x] - sizes[x] : ends[x]]] = True
        both = np.add.reduceat(held[flat].astype(np.int64), ends - sizes)
        linked = 100 * both >= LINK * (sizes + sizes[x] - both)
        for y in np.flatnonzero(linked & (component != component[x])).tolist():
            if component[y] != component[x]:
                found.append((ids[x], ids[y]))
                component[component == component[y]] = component[x]
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def near_duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_shingles, component_id, kept)`` for every row of ``documents``.

    Texts are linked if their sets of five-word shingles (A-Z lower-cased) have a Jaccard similarity
    of 0.75 or more, confirmed on the full sets of 64-bit shingle hashes; ``component_id`` is the
    smallest key reachable over links and ``kept`` marks that row.

    NULL, empty and blank texts have no shingles and link with nothing; texts of fewer than five
    words are one shingle. Equal sets are linked without comparing them again. Rows that share a key but
    not the text are linked each by its own text. Rows without a key take part in nothing:
    ``component_id`` NULL, ``kept`` true. An empty table gives no rows. Other columns are not read.
    """
    staging = Staging(documents.sparkSession)
    rows, names = row_keys(documents.select(F.col(key).alias("id"), F.col(text).alias("text")), "id", "text", staging)
    found = _row_duplicates(rows, staging)
    if names is not None:
        own = names.withColumnRenamed("k", "doc_id")
        first = names.toDF("component_id", "first_id")
        found = found.join(own, ROW_KEY, "left").join(first, "component_id", "left")
        found = found.selectExpr("doc_id", "n_shingles", "first_id AS component_id", "coalesce(doc_id = first_id, true) AS kept")
    return found.toDF(key, "n_shingles", "component_id", "kept")


def _row_duplicates(documents: DataFrame, staging: Staging) -> DataFrame:
    """``near_duplicates`` by ``ROW_KEY``, of which no two different texts share one."""
    key, text = ROW_KEY, "text"
    texts = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = staging.keep(texts.mapInArrow(_sign, _SIGNED), "signed")
    full = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = staging.keep(full.groupBy("c0", "c1").agg(F.min("doc_id").alias("id")), "classes")
    firsts = staging.keep(
        full.join(classes, (full["doc_id"] == classes["id"]) & (full["c0"] == classes["c0"]) & (full["c1"] == classes["c1"])).select(
            "id", "n_shingles", "bands", "sketch"
        ),
        "firsts",
    )
    slim = firsts.selectExpr("id", "n_shingles AS n", *[f"sketch[{i}] AS s{i}" for i in range(4)])

    def accept(pairs: DataFrame, name: str) -> DataFrame:
        left = slim.selectExpr("id AS a", "n AS na", *[f"s{i} AS a{i}" for i in range(4)])
        right = slim.selectExpr("id AS b", "n AS nb", *[f"s{i} AS b{i}" for i in range(4)])
        differ = "bit_count((a0 ^ b0) | (a2 ^ b2)) + bit_count((a1 ^ b1) | (a3 ^ b3))"
        likely = pairs.join(left, "a").join(right, "b").where(
            f"100 * least(na, nb) >= {LINK} * greatest(na, nb) AND {differ} <= {SKETCH_LIMIT}"
        )
        likely = staging.keep(likely.select("a", "b").distinct(), f"likely-{name}")
        needed = likely.selectExpr("explode(array(a, b)) AS doc_id").distinct()
        some = texts.join(needed, "doc_id", "left_semi")
        sets = some.mapInArrow(_as_sets, "id long, elements binary")
        both = likely.join(sets.selectExpr("id AS a", "elements AS x"), "a").join(sets.selectExpr("id AS b", "elements AS y"), "b")
        return both.select("a", "b", "x", "y").mapInArrow(_verify, "a long, b long").distinct()

    def finish(mates: DataFrame) -> DataFrame:
        # Sets that open buckets connect form clusters; each set goes to its cluster once and is compared there.
        edges = mates.where("id > hub").selectExpr("hub AS a", "id AS b")
        clusters = connected_components(edges, staging, "clusters").withColumnRenamed("component", "cluster")
        placed = clusters.join(mates.select("id", "c").distinct(), "id")
        sizes = placed.groupBy("cluster").agg(F.expr(f"CAST(ceil(count(1) / {BLOCK}) AS INT)").alias("blocks"))
        placed = staging.keep(
            placed.join(sizes, "cluster").withColumn("block", F.expr("CAST(pmod(xxhash64(id), blocks) AS INT)")), "placed"
        )
        some = texts.join(placed.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")
        sets = placed.join(some.mapInArrow(_as_sets, "id long, elements binary"), "id")
        met = sets.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).selectExpr(
            "cluster", "least(block, other) AS i", "greatest(block, other) AS j", "id", "c", "elements"
        )
        return met.groupBy("cluster", "i", "j").applyInPandas(_compare, "a long, b long")

    components = bucket_components(firsts.selectExpr("id", "bands AS buckets"), accept, finish, staging)
    reached = classes.join(components, "id", "left").selectExpr("c0", "c1", "coalesce(component, id) AS component_id")
    out = signed.join(reached, ["c0", "c1"], "left").selectExpr(
        "doc_id", "n_shingles", "CASE WHEN doc_id IS NULL THEN NULL WHEN n_shingles = 0 THEN doc_id ELSE component_id END AS component_id"
    )
    return out.selectExpr(f"doc_id AS {key}", "n_shingles", "component_id", "coalesce(doc_id = component_id, true) AS kept")


def keep_first(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``documents`` that are first of their group, columns unchanged.

    Rows without a key stay. Of rows that share a key each stays or goes by its own text; rows that are
    equal in both are one document.
    """
    staging = Staging(documents.sparkSession)
    rows, _ = row_keys(documents, key, text, staging)
    found = _row_duplicates(rows.select(ROW_KEY, F.col(text).alias("text")), staging)
    gone = found.where("NOT kept").select(F.col(ROW_KEY).alias("__gone")).distinct()
    return rows.join(gone, F.col(ROW_KEY) == F.col("__gone"), "left_anti").drop(ROW_KEY)
