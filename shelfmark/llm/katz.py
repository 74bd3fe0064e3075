"""Scoring texts with a Katz backoff language model over words.

Probabilities, with N the training tokens and c, r training counts:

    P(w)     = d(c) c / (N + 1),                    the rest of the mass for all unknown words as one
    P(w | v) = d(r) r / (c(v) + 1)                  if the pair was seen in training,
             = alpha(v) P(w)                        otherwise,

where d are Good-Turing discounts for counts up to K (1 above) and alpha(v) makes P(. | v) sum to
one exactly. The added 1 leaves every context some mass even if none of its counts is discounted.

Texts are coded once as numbers of the words of their chunk. A chunk asks for the counts of its
distinct words, so that a frequent word is one row a chunk, and is stored with the answers; then its distinct pairs, with
their documents, are sent to the partition of their context, where counts, seen pairs and backoff weights are at hand
and only sums for each document leave. Nothing of the corpus passes through the driver but the
numbers of words and pairs that occur once, twice, ... .
"""

from __future__ import annotations

import random
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import Staging
from shelfmark.llm.minhash import mix

#: Counts up to K are discounted.
K = 5
#: Tokens and documents a chunk takes before it is closed; a longer text is a chunk of its own.
CHUNK_TOKENS = 1_000_000
CHUNK_DOCS = 2_000
#: Bytes of text for each partition of the word and the pair tables.
WORD_BYTES = 16_000_000
PAIR_BYTES = 9_000_000
#: Contexts that occur more often are split by their next word.
HOT = 500_000

END, START = np.uint64(1), np.uint64(2)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob; bytes of equal weight are put together, where they repeat most."""
    parts = [struct.pack("<H", len(arrays))]
    for a in arrays:
        a = np.ascontiguousarray(a)
        parts.append(struct.pack("<3sQ", a.dtype.str[1:].encode(), len(a)))
        parts.append(a.view(np.uint8).reshape(-1, a.dtype.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(blob: bytes) -> list[np.ndarray]:
    data, at = zstandard.ZstdDecompressor().decompress(blob), 2
    out = []
    for _ in range(struct.unpack_from("<H", data)[0]):
        kind, n = struct.unpack_from("<3sQ", data, at)
        dtype = np.dtype("<" + kind.rstrip(b"\0").decode())
        at += 11
        planes = np.frombuffer(data, dtype=np.uint8, count=n * dtype.itemsize, offset=at)
        out.append(np.ascontiguousarray(planes.reshape(dtype.itemsize, n).T).view(dtype).reshape(-1))
        at += n * dtype.itemsize
    return out


def discounts(occurring: list[int]) -> np.ndarray:
    """d(1) .. d(K) from the numbers of types that occur 1 .. K + 1 times.

    Good-Turing discounts in Katz's form; where the numbers give none between 0 and 1, half a count
    is taken off instead.
    """
    n = [0, *occurring]
    common = (K + 1) * n[K + 1] / n[1] if n[1] else 1.0
    out = []
    for r in range(1, K + 1):
        d = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) if n[r] and common < 1 else 0.0
        out.append(d if 0 < d < 1 else 1 - 0.5 / r)
    return np.array(out)


def unigram(counts: np.ndarray, tokens: int, occurring: list[int]) -> np.ndarray:
    """P(w) for words with these training counts; a count of 0 is the class of all unknown words."""
    d = np.concatenate([discounts(occurring), [1.0]])
    known = d[np.minimum(counts, K + 1) - 1] * counts / (tokens + 1)
    saved = 1 + sum((1 - d[r - 1]) * r * occurring[r - 1] for r in range(1, K + 1))
    return np.where(counts > 0, known, saved / (tokens + 1))


_CODED = "chunk long, part int, payload binary, ids array<long>"


def _coder(parts: int):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        held: list[bool] = []
        lengths: list[int] = []
        hashes: list[np.ndarray] = []
        total = 0

        def close() -> pa.RecordBatch:
            chunk = random.SystemRandom().getrandbits(62)  # stored with the chunk, so it holds for all readers
            tokens = np.concatenate(hashes)
            words, coded = np.unique(tokens, return_inverse=True)
            order = np.lexsort((words, words % np.uint64(parts)))  # words of a partition together
            place = np.empty(len(order), dtype=np.int32)
            place[order] = np.arange(len(order), dtype=np.int32)
            coded, words = place[coded], words[order]
            training = np.repeat(~np.array(held), lengths)
            counts = np.bincount(coded[training], minlength=len(words)).astype(np.uint32)
            part = (words % np.uint64(parts)).astype(np.int64)
            starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            rows = [(chunk, -1, pack(coded, np.array(lengths, dtype=np.int32), np.array(held)), list(ids))]
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(words)], strict=True):
                rows.append((chunk, int(part[a]), pack(words[a:b], counts[a:b]), None))
            for kept in (ids, held, lengths, hashes):
                kept.clear()
            columns = list(zip(*rows, strict=True))
            types = (pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types, strict=True)], names=["chunk", "part", "payload", "ids"])

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                some = batch.slice(start, 256)
                texts = some.column(1).cast(pa.binary()).to_pylist()
                for i, text, out in zip(some.column(0).to_pylist(), texts, some.column(2).to_pylist(), strict=True):
                    own = (text or b"").lower().split()  # of bytes: A-Z and ASCII white space only
                    if lengths and (len(lengths) >= CHUNK_DOCS or total + len(own) > CHUNK_TOKENS):
                        yield close()
                        total = 0
                    hashes.append(np.append(np.fromiter(map(xxhash.xxh3_64_intdigest, own), dtype=np.uint64, count=len(own)), END))
                    ids.append(i)
                    held.append(out)
                    lengths.append(len(own) + 1)
                    total += len(own) + 1
        if lengths:
            yield close()

    return code


def _count_words(group: pd.DataFrame) -> pd.DataFrame:
    """Global counts and numbers for all chunks' words of one partition, in each chunk's order; the chunk has the words."""
    asked = [unpack(p) for p in group["payload"]]
    words, where = np.unique(np.concatenate([a[0] for a in asked]), return_inverse=True)
    total = np.bincount(where, weights=np.concatenate([a[1] for a in asked]), minlength=len(words)).astype(np.int64)
    ends = np.cumsum([len(a[0]) for a in asked])
    rows = [
        (c, p, pack(_fitting(total[where[e - len(a[0]) : e]]), _fitting(where[e - len(a[0]) : e])), None)
        for c, p, a, e in zip(group["chunk"], group["part"], asked, ends, strict=True)
    ]
    seen = total[total > 0]
    stats = [len(seen), int(seen.sum()), *[int((seen == r).sum()) for r in range(1, K + 2)]]
    rows.append((-1, int(group["part"].iloc[0]), None, stats))
    return pd.DataFrame(rows, columns=["chunk", "part", "payload", "stats"])


_ANSWERED = "chunk long, payload binary, ids array<long>, words binary"


def _answered(word_parts: int):
    """One row for a chunk: its texts, and its words with their counts and the numbers that tell all words apart."""

    def run(key: tuple, coded: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        coded = coded.sort_values("part")  # the texts, then the words of each partition
        words = np.concatenate([unpack(p)[0] for p in coded["payload"].iloc[1:]])
        found = [unpack(p) for p in answers.sort_values("part")["payload"]]
        counts = np.concatenate([f[0] for f in found])
        numbers = np.concatenate([f[1] for f in found]).astype(np.uint64) * np.uint64(word_parts) + words % np.uint64(word_parts)
        row = (key[0], coded["payload"].iloc[0], coded["ids"].iloc[0], pack(words, _fitting(counts), _fitting(numbers)))
        return pd.DataFrame([row], columns=["chunk", "payload", "ids", "words"])

    return run


def _pair_rows(parts: int, distinct: int, tokens: int, documents: int):
    """Rows of each chunk: figures of its documents, and their distinct pairs for each partition."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                yield told(row.chunk, row.payload, row.ids, row.words)

    def told(chunk: int, payload: bytes, ids: np.ndarray, answered: bytes) -> pd.DataFrame:
        text, lengths, held = unpack(payload)
        words, counts, numbers = unpack(answered)
        counts = counts.astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        c = counts[text]
        base = np.add.reduceat(np.log10((c + 0.1) / (tokens + 0.1 * (distinct + 1))), starts)
        known = np.add.reduceat((c > 0).astype(np.int64), starts)
        rows = [("base", chunk, chunk % parts, pack(lengths.astype(np.int64), known, base, held), ids)]

        before = np.concatenate([[0], text[:-1]]).astype(np.int64)
        before[starts] = len(words)  # the start of a text, as often as there are training texts
        words, counts = np.append(words, START), np.append(counts, documents)
        bits = int(len(words)).bit_length()
        doc = np.repeat(np.arange(len(lengths), dtype=np.int64), lengths)
        pairs, times = np.unique((doc << (2 * bits)) | (before << bits) | text, return_counts=True)
        doc, before, after = pairs >> (2 * bits), (pairs >> bits) & ((1 << bits) - 1), pairs & ((1 << bits) - 1)
        slices = (counts[before] // HOT + 1).astype(np.uint64)
        part = (mix(words[before] + _FACTOR * (mix(words[after]) % slices)) % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((doc, after, before, part))
        doc, before, after, times, part = (x[order] for x in (doc, before, after, times, part))
        bounds = [*np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])).tolist(), len(part)]
        for a, b in zip(bounds, bounds[1:], strict=False):
            # A distinct pair is told once a chunk, with the documents that have it; likewise its context.
            new_context = np.concatenate([[True], before[a + 1 : b] != before[a : b - 1]])
            new_pair = new_context | np.concatenate([[True], after[a + 1 : b] != after[a : b - 1]])
            at = np.flatnonzero(new_pair)
            contexts = np.flatnonzero(new_context[at])
            context = before[a:b][at][contexts]
            # The next words stand once for the partition, in the order of their numbers.
            number, first, which = np.unique(numbers[after[a:b][at]], return_index=True, return_inverse=True)
            payload = pack(
                words[context], _fitting(counts[context]), _fitting(np.diff(np.append(contexts, len(at)))), _fitting(which),
                _fitting(doc[a:b]), _fitting(counts[after[a:b][at][first]]), _fitting(times[a:b]), held, _fitting(np.diff(np.append(at, b - a))),
                _fitting(np.diff(number.astype(np.int64), prepend=0)),
            )
            rows.append(("pairs", chunk, int(part[a]), payload, None))
        return pd.DataFrame(rows, columns=["kind", "chunk", "part", "payload", "ids"])

    return run


def _fitting(numbers: np.ndarray) -> np.ndarray:
    """Numbers from 0 in the narrowest type that holds the largest."""
    return numbers.astype(np.min_scalar_type(int(numbers.max(initial=0))))


_CONTEXT = ["context", "occurs", "undiscounted", "covered", *[f"n{r}" for r in range(1, K + 1)]]
_SUMS = (
    "kind string, chunk long, payload binary, ids array<long>, stats array<long>, context array<long>, doc array<int>, times array<int>, "
    "occurs array<double>, undiscounted array<double>, covered array<double>, " + ", ".join(f"n{r} array<double>" for r in range(1, K + 1))
)


def _score_pairs(tokens: int, occurring: list[int]):
    """Sums for the documents of every chunk, of the pairs of one partition."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        rows = [{"kind": "base", "chunk": c, "payload": p, "ids": i} for c, p, i in group.loc[group["kind"] == "base", ["chunk", "payload", "ids"]].itertuples(index=False)]
        pairs = group[group["kind"] == "pairs"]
        if len(pairs):
            blobs = [unpack(p) for p in pairs["payload"]]
            contexts, which = np.unique(np.concatenate([b[0] for b in blobs]), return_inverse=True)
            occurs = np.zeros(len(contexts), dtype=np.float64)
            occurs[which] = np.concatenate([b[1] for b in blobs])
            repeats = np.concatenate([b[8] for b in blobs]).astype(np.int64)  # documents of each chunk's distinct pairs
            ctx = np.repeat(which, np.concatenate([b[2] for b in blobs])).astype(np.uint64)
            numbers = np.concatenate([np.cumsum(b[9].astype(np.uint64), dtype=np.uint64)[b[3]] for b in blobs])
            key = np.repeat((ctx << np.uint64(40)) | numbers, repeats)
            ctx = np.repeat(ctx, repeats)
            sizes = [len(b[4]) for b in blobs]
            times = np.concatenate([b[6] for b in blobs]).astype(np.int64)
            training = np.concatenate([~b[7].astype(bool)[b[4]] for b in blobs])
            order = np.argsort(key, kind="stable")
            first = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0]))
            r = np.add.reduceat(np.where(training, times, 0)[order], first)
            of = np.empty(len(key), dtype=np.int64)
            of[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(key))))
            next_count = np.repeat(np.concatenate([b[5].astype(np.int64)[b[3]] for b in blobs]), repeats)
            p1 = unigram(next_count, tokens, occurring)
            type_ctx, type_p1, seen = ctx[order][first].astype(np.int64), p1[order][first], r > 0
            rows.append({"kind": "stats", "stats": [int((r == i).sum()) for i in range(1, K + 2)]})

            # Documents: logarithms of seen pairs without their discounts, how many have each discount,
            # and of unseen pairs those of the next word; the backoff weights come later.
            count, ctx = r[of], ctx.astype(np.int64)
            is_seen = count > 0
            known = np.where(is_seen, np.log10(np.maximum(count, 1)) - np.log10(occurs[ctx] + 1), np.log10(p1)) * times
            start = 0
            for chunk, blob, n in zip(pairs["chunk"], blobs, sizes, strict=True):
                own, doc = slice(start, start + n), blob[4].astype(np.int64)
                docs = len(blob[7])
                sums = [np.bincount(doc, weights=known[own], minlength=docs)]
                for i in range(1, K + 1):
                    sums.append(np.bincount(doc, weights=times[own] * (count[own] == i), minlength=docs).astype(np.uint32))
                row = {"kind": "sums", "chunk": chunk, "payload": pack(*sums)}
                missing = np.flatnonzero(~is_seen[own])
                if len(missing):
                    row |= {"context": contexts[ctx[own][missing]].view(np.int64), "doc": doc[missing].astype(np.int32), "times": times[own][missing].astype(np.int32)}
                rows.append(row)
                start += n
            # Contexts that some unseen pair needs here, and the hot ones, whose slices must meet.
            needed = np.zeros(len(contexts), dtype=bool)
            needed[ctx[~is_seen]] = True
            needed |= occurs >= HOT
            tally = lambda weights: np.bincount(type_ctx, weights=weights, minlength=len(contexts))[needed]
            row = {"kind": "contexts", "context": contexts[needed].view(np.int64), "occurs": occurs[needed]}
            row |= {"undiscounted": tally(r * (r > K)), "covered": tally(type_p1 * seen)}
            row |= {f"n{i}": tally((r == i).astype(float)) for i in range(1, K + 1)}
            rows.append(row)
        names = ["kind", "chunk", "payload", "ids", "stats", "context", "doc", "times", *_CONTEXT[1:]]
        columns = {n: pd.Series([row.get(n) for row in rows], dtype="Int64" if n == "chunk" else object) for n in names}
        return pd.DataFrame(columns)

    return run


_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _finish(d: np.ndarray):
    """Scores of a chunk's documents from all partitions' sums and the backoff weights."""

    def run(sums: pd.DataFrame, backoff: pd.DataFrame) -> pd.DataFrame:
        base = sums[sums["kind"] == "base"].iloc[0]
        lengths, known, base_score, held = unpack(base["payload"])
        score = np.zeros(len(lengths))
        for blob in sums.loc[sums["kind"] == "sums", "payload"]:
            part = unpack(blob)
            score += part[0]
            for i in range(K):
                score += part[1 + i] * np.log10(d[i])
        if len(backoff):
            score[backoff["doc"].to_numpy()] += backoff["s"].to_numpy()
        ids = pd.array([None if i is None or i != i else int(i) for i in base["ids"]], dtype="Int64")
        return pd.DataFrame({"doc_id": ids, "held_out": held.astype(bool), "n_tokens": lengths, "n_known": known, "base_score": base_score, "score": score})

    return run


def score_texts(documents: DataFrame, held_out: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every row of ``documents``.

    ``held_out`` is SQL for the rows that do not train (they are scored like all others). Tokens are
    the words (A-Z lower-cased) and one end; ``base_score`` is the additive baseline, ``score`` the
    model's log10 probability of the tokens. Words are told apart by 64-bit hashes.

    NULL and empty texts are an end only. Rows without a key are scored and train; repeated rows
    count as often as they occur. Without training rows all words are unknown. An empty table gives
    no rows. Other columns are not read.
    """
    spark = documents.sparkSession
    staging = Staging(spark)
    rows = documents.selectExpr(f"CAST({key} AS BIGINT) AS doc_id", f"{text} AS text", f"{held_out} AS held")
    size = rows.selectExpr("coalesce(sum(octet_length(text)), 0)").first()[0]
    word_parts, pair_parts = size // WORD_BYTES + 8, size // PAIR_BYTES + 8
    coded = staging.keep(rows.mapInArrow(_coder(word_parts), _CODED), "coded")
    counted = coded.where("part >= 0").select("chunk", "part", "payload").groupBy("part")
    counted = staging.keep(counted.applyInPandas(_count_words, "chunk long, part int, payload binary, stats array<long>"), "words")
    stats = _total(counted.where("chunk = -1"), 2 + K + 1)
    distinct, tokens, occurring = stats[0], stats[1], stats[2:]
    training = coded.where("part = -1").selectExpr("payload", "size(ids) AS n")
    training = training.select(_training("payload").alias("n")).selectExpr("coalesce(sum(n), 0)").first()[0]
    answers = counted.where("chunk >= 0").select("chunk", "part", "payload")
    answered = coded.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(_answered(word_parts), _ANSWERED)
    answered = staging.keep(answered, "answered")
    staging.drop("coded")
    staging.drop("words")
    pairs = answered.mapInPandas(
        _pair_rows(pair_parts, distinct, tokens, training), "kind string, chunk long, part int, payload binary, ids array<long>"
    )
    sums = staging.keep(pairs.groupBy("part").applyInPandas(_score_pairs(tokens, occurring), _SUMS), "sums")
    staging.drop("answered")
    d = discounts(_total(sums.where("kind = 'stats'"), K + 1))
    contexts = sums.where("kind = 'contexts'").select(F.explode(F.arrays_zip(*_CONTEXT)).alias("z")).select("z.*")
    contexts = contexts.groupBy("context").agg(F.max("occurs").alias("occurs"), *[F.sum(c).alias(c) for c in _CONTEXT[2:]])
    mass = " + ".join(["undiscounted", *[f"{float(d[r - 1])!r}D * {r} * n{r}" for r in range(1, K + 1)]])
    weights = contexts.selectExpr("context", f"log10((1 - ({mass}) / (occurs + 1)) / (1 - covered)) AS alpha")
    unseen = sums.where("kind = 'sums' AND context IS NOT NULL").select("chunk", F.explode(F.arrays_zip("context", "doc", "times")).alias("z"))
    backoff = unseen.select("chunk", "z.*").join(weights, "context").groupBy("chunk", "doc").agg(F.sum(F.col("times") * F.col("alpha")).alias("s"))
    parts = sums.where("kind IN ('base', 'sums')").select("kind", "chunk", "payload", "ids")
    backoff = backoff.selectExpr("chunk AS of_chunk", "doc", "s")
    scored = parts.groupBy("chunk").cogroup(backoff.groupBy("of_chunk")).applyInPandas(_finish(d), _SCORED)
    return scored.selectExpr(
        f"doc_id AS {key}", "held_out", "n_tokens", "n_known", f"{tokens}L AS train_tokens", "base_score", "score"
    )


def _total(rows: DataFrame, n: int) -> list[int]:
    """Sums of the places of the arrays ``stats``."""
    sums = rows.select(*[F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(n)]).first()
    return [int(x or 0) for x in sums]


def _training(payload: str):
    @F.pandas_udf("long")
    def count(blobs: pd.Series) -> pd.Series:
        return blobs.map(lambda b: int((unpack(b)[2] == 0).sum()))

    return count(payload)
