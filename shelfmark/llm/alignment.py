"""Groups of tokens of two tokenizers that cover the same bytes, by pointer jumping.

Tokens of two tokenizers overlap where their byte ranges do. Every token points to the token of the
other tokenizer that overlaps it and reaches farthest to the right; a token that ends where that one
ends points to the second tokenizer's token of the two, which points to itself. Doubling
(``successor = successor[successor]``) leads every token to the terminal token of its component, which
labels the group. All tokens of a chunk of documents are doubled at once.

Link counts over the corpus are exact: a chunk (some MB of text, or one longer document) counts its own
id pairs, the counts are summed by pair, and each chunk gets back the totals of the pairs it holds. So
the shuffle carries a pair once a chunk, not once a link or document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from shelfmark.llm.common import Staging
from shelfmark.llm.tokens import ByteBpe, PieceBpe

#: Code points of text a chunk holds (more only where one text is longer).
CHUNK = 3_000_000
#: Bits of the second id in a pair.
PAIR_BITS = 32


def jump_groups(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group number (0, 1, ...) of each token, from the byte offsets where tokens end, both ascending.

    Both sequences tile the same bytes, so the last ends are equal.
    """
    n_a, n_b = len(ends_a), len(ends_b)
    # The token that covers the byte before an end reaches farthest among those that overlap the token.
    over_a, over_b = np.searchsorted(ends_b, ends_a), np.searchsorted(ends_a, ends_b)
    own_b = np.arange(n_b) + n_a
    successor = np.concatenate([over_a + n_a, np.where(ends_a[over_b] == ends_b, own_b, over_b)])
    while True:
        further = successor[successor]
        if np.array_equal(further, successor):
            break
        successor = further
    terminals, group = np.unique(successor, return_inverse=True)
    return group[:n_a], group[n_a:]


class Aligner:
    """Both tokenizers, loaded once a task."""

    def __init__(self, byte_path: str, piece_path: str):
        self.a, self.b = ByteBpe(byte_path), PieceBpe(piece_path)
        self.size_a, self.size_b = (np.array(list(map(len, t.bytes_of)), dtype="i8") for t in (self.a, self.b))
        shown_a, shown_b = list(map(str, range(self.a.size))), list(map(str, range(self.b.size)))
        # How a token is written inside its group and at the end of its side.
        written = [f"{i}," for i in shown_a] + [f"{i}|" for i in shown_a] + [f"{i}," for i in shown_b] + [f"{i};" for i in shown_b]
        self.written = np.array(written, dtype=object)

    def tokens(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both tokenizers a text; none for a text that either does not give back byte by byte."""
        all_a, all_b = [], []
        pieces = self.b.encode([t or "" for t in texts])
        join_a, join_b = self.a.bytes_of.__getitem__, self.b.bytes_of.__getitem__
        for text, piece_ids in zip(texts, pieces, strict=True):
            ids_a = ids_b = np.zeros(0, dtype="i8")
            if text:
                spaced = " " + text
                whole = spaced.encode()
                if b"".join(map(join_b, piece_ids)) == whole:
                    byte_ids = self.a.encode(spaced, marks=False)
                    if b"".join(map(join_a, byte_ids.tolist())) == whole:
                        ids_a, ids_b = byte_ids.astype("i8"), np.array(piece_ids, dtype="i8")
            all_a.append(ids_a)
            all_b.append(ids_b)
        return all_a, all_b

    def align(self, texts: list[str | None], keep_groups: bool) -> tuple[dict[str, list], np.ndarray, np.ndarray]:
        """Columns a text, and the chunk's distinct id pairs with their counts; ``links`` refers to the pairs."""
        all_a, all_b = self.tokens(texts)
        n_a, n_b = (np.array(list(map(len, x)), dtype="i8") for x in (all_a, all_b))
        a, b = np.concatenate(all_a), np.concatenate(all_b)
        empty = np.zeros(0, dtype="i8")
        n_groups, links, groups, digests = np.zeros(len(texts), dtype="i8"), [b""] * len(texts), [""] * len(texts), [""] * len(texts)
        pairs, counts = empty, empty
        if len(a):
            group_a, group_b = jump_groups(np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b]))
            total = int(group_a[-1]) + 1
            last_a, last_b = (np.append(g[1:] != g[:-1], True) for g in (group_a, group_b))
            # A group's last tokens end together: its one link. Tokens are never empty (checked below).
            pair = (a[last_a] << PAIR_BITS) | b[last_b]
            pairs, local, counts = np.unique(pair, return_inverse=True, return_counts=True)
            local = local.astype("<i4")
            # Side by side: the tokens of A of a group before those of B.
            size_a, size_b = np.bincount(group_a, minlength=total), np.bincount(group_b, minlength=total)
            before_a, before_b = np.cumsum(size_a), np.cumsum(size_b) - size_b
            code = np.empty(len(a) + len(b), dtype="i8")
            code[np.arange(len(a)) + before_b[group_a]] = a + last_a * self.a.size
            code[np.arange(len(b)) + before_a[group_b]] = b + last_b * self.b.size + 2 * self.a.size
            a_end, b_end = np.cumsum(n_a), np.cumsum(n_b)
            g_end = 0
            for i in np.flatnonzero(n_a).tolist():
                start, end = a_end[i] - n_a[i] + b_end[i] - n_b[i], a_end[i] + b_end[i]
                text = "".join(self.written[code[start:end]].tolist())[:-1]
                digests[i] = hashlib.sha256(text.encode()).hexdigest()
                groups[i] = text if keep_groups else ""
                g_start, g_end = g_end, int(group_a[a_end[i] - 1]) + 1
                n_groups[i] = g_end - g_start
                links[i] = local[g_start:g_end].tobytes()
        columns = {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "groups_sha256": digests, "groups": groups, "links": links}
        return columns, pairs, counts


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in their order, in tables of at most ``CHUNK`` code points or one row."""
    held, size = [], 0
    for batch in batches:
        lengths = [len(t) if (t := x.as_py()) else 0 for x in batch.column(1)]
        start = 0
        for i, n in enumerate(lengths):
            if size and size + n > CHUNK:
                yield pa.Table.from_batches([*held, batch.slice(start, i - start)])
                held, size, start = [], 0, i
            size += n
        held.append(batch.slice(start))
    if held and sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held)


def _aligned(byte_path: str, piece_path: str, keep_groups: bool, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(byte_path, piece_path)
        if min(aligner.size_a.min(), aligner.size_b.min()) == 0:
            raise ValueError("a vocabulary has a token without bytes; token ends would not be unique")
        for turn, table in enumerate(_chunks(batches)):
            chunk = (TaskContext.get().partitionId() << 32) + turn
            columns, pairs, counts = aligner.align(table.column(1).to_pylist(), keep_groups)
            n = table.num_rows
            rows = {"id": table.column(0), "chunk": [chunk] * n, "pairs": [None] * n, "counts": [None] * n, **columns}
            yield pa.Table.from_arrays([_column(rows[f.name], f.type) for f in schema], schema=schema).combine_chunks().to_batches()[0]
            own = {"chunk": [chunk], "pairs": [pairs], "counts": [counts]}
            yield pa.RecordBatch.from_arrays([pa.array(own.get(f.name, [None]), f.type) for f in schema], schema=schema)

    return run


def _column(values, kind: pa.DataType):
    return values if isinstance(values, pa.ChunkedArray) else pa.array(values, kind)


def _summed(key, docs: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
    """Documents of a chunk with the totals of their links' pairs."""
    total, best = np.zeros(len(pairs), dtype="i8"), np.zeros(len(pairs), dtype="i8")
    place = pairs["place"].to_numpy()
    total[place], best[place] = pairs["total"].to_numpy(), pairs["best"].to_numpy()
    links = [np.frombuffer(x, "<i4") for x in docs["links"]]
    docs["n_links"] = [len(x) for x in links]
    docs["n_best"] = [int(best[x].sum()) for x in links]
    docs["count_sum"] = [int(total[x].sum()) for x in links]
    return docs.drop(columns=["links", "chunk"])


def align_tokens(
    docs: DataFrame,
    byte_path: str,
    piece_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep_groups: bool = False,
) -> DataFrame:
    """Per document ``(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``.

    A are the tokens of a space and the text in the byte-level BPE of ``byte_path``, B those of the text in
    the SentencePiece model of ``piece_path``, which adds the space; strings of special tokens are plain text.
    A group is a run of tokens between two byte offsets where both have a token end; its last tokens are a
    link. A pair of ids counts as often as it is linked in all documents; ``n_best`` are the links whose
    count is the highest of their B id (ties included), ``count_sum`` the sum of the counts of the links.
    ``groups_sha256`` is the digest of ``a1,a2|b1;a3|b2,b3``: ids of A and B by group. ``keep_groups`` adds
    that text as ``groups``.

    A NULL or empty text, and one that either tokenizer does not give back byte by byte (B reads the sign
    U+2581 as a space), has no tokens: zeros, '' for the digest. Rows are aligned one by one, NULL or
    repeated keys too. An empty table gives no rows. Other columns, whatever their names, are left out.
    """
    staging = Staging(docs.sparkSession)
    chosen = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    id_field = chosen.schema["id"]
    fields = (
        f"id {id_field.dataType.simpleString()}, chunk long, n_a long, n_b long, n_groups long, groups_sha256 string, "
        "groups string, links binary, pairs array<long>, counts array<long>"
    )
    longs = pa.list_(pa.int64())
    kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.binary(), longs, longs]
    names = ["chunk", "n_a", "n_b", "n_groups", "groups_sha256", "groups", "links", "pairs", "counts"]
    schema = pa.schema([("id", to_arrow_type(id_field.dataType)), *zip(names, kinds, strict=True)])
    aligned = chosen.mapInArrow(_aligned(byte_path, piece_path, keep_groups, schema), fields)
    stored = staging.keep(aligned, "aligned")

    counted = stored.where("pairs IS NOT NULL").select("chunk", "pairs", "counts")
    each = counted.selectExpr("inline(arrays_zip(pairs, counts))").toDF("pair", "n")
    totals = staging.keep(each.groupBy("pair").agg(F.sum("n").alias("total")), "totals")
    second = f"pair & {(1 << PAIR_BITS) - 1}L"
    highest = totals.groupBy(F.expr(second).alias("b")).agg(F.max("total").alias("highest"))
    ranked = totals.selectExpr("pair", f"{second} AS b", "total").join(highest, "b")
    ranked = ranked.selectExpr("pair", "total", "CAST(total = highest AS BIGINT) AS best")

    placed = counted.selectExpr("chunk", "posexplode(pairs) AS (place, pair)")
    back = placed.join(ranked, "pair").selectExpr("chunk AS pairs_chunk", "place", "total", "best")
    kept = ["n_a", "n_b", "n_groups", "groups_sha256", *(["groups"] if keep_groups else [])]
    rows = stored.where("pairs IS NULL").select("id", "chunk", *kept, "links")
    out = rows.limit(0).selectExpr("id", *kept, "0L AS n_links", "0L AS n_best", "0L AS count_sum").schema
    result = rows.groupBy("chunk").cogroup(back.groupBy("pairs_chunk")).applyInPandas(_summed, out)
    return result.select(
        F.col("id").alias(id_column), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", *kept[3:]
    )
