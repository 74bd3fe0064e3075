"""Best-fit packing of tokenised documents into sequences of a fixed length.

Bounded-space online best fit: a packer holds a fixed number of open bins in a bitset keyed by free
space. A piece goes to the open bin with the least space that suffices, which is the lowest set bit at
or above its length. If none suffices a bin is opened; where all are open the fullest, the lowest set
bit of all, is closed first.

Documents are cut and described (length, checksum) where they are read, and only these descriptions
are dealt out: packers of some thousand pieces each, by a hash of the row, so that copies, repeated keys
and hot sources spread evenly. A packer takes its pieces longest first. What lies in bins that end
poorly filled is packed again, together with that of all other packers, until one packer gets it all.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import Staging
from shelfmark.llm.tokens import ByteBpe

#: Pieces a packer gets on average, and the bins it keeps open.
PIECES = 4096
OPEN_BINS = 1024
#: A bin less full than this at its packer's end is emptied and its pieces packed again.
WELL_FILLED = 15 / 16


def cut_lengths(total: int, limit: int) -> list[int]:
    """Lengths of a document's pieces: whole sequences, before them what is over."""
    over = total % limit
    return [over] * (over > 0) + [limit] * (total // limit)


def best_fit(lengths: list[int], capacity: int, open_bins: int) -> tuple[list[int], list[int], list[int]]:
    """Bin and place of each piece, in the given order, and how full each bin gets."""
    holes = 0  # bit f: an open bin has f free
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, places, fill, n_open = [], [], [], 0
    for length in lengths:
        fitting = holes >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            chosen = by_free[free].pop()
            if not by_free[free]:
                holes &= ~(1 << free)
        else:
            if n_open == open_bins:
                fullest = (holes & -holes).bit_length() - 1
                by_free[fullest].pop()
                if not by_free[fullest]:
                    holes &= ~(1 << fullest)
                n_open -= 1
            chosen, free = len(fill), capacity
            fill.append(0)
            n_open += 1
        bins.append(chosen)
        places.append(fill[chosen])
        fill[chosen] += length
        if free > length:
            by_free[free - length].append(chosen)
            holes |= 1 << (free - length)
        else:
            n_open -= 1
    return bins, places, fill


def _cut(path: str, limit: int, end_id: int, with_ids: bool, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows, pieces, starts, lengths, sums, kept = [], [], [], [], [], []
                for row, text in enumerate(part.column(1)):
                    ids = np.append(bpe.encode(text.as_py() or "", marks=True), end_id).astype("<u4")
                    start = 0
                    for piece, length in enumerate(cut_lengths(len(ids), limit)):
                        own = ids[start : start + length]
                        rows.append(row)
                        pieces.append(piece)
                        starts.append(start)
                        lengths.append(length)
                        sums.append(zlib.crc32(own.tobytes()))
                        if with_ids:
                            kept.append(own.astype("i4"))
                        start += length
                columns = [part.column(0).take(pa.array(rows, pa.int64())), pieces, starts, lengths, sums]
                if with_ids:
                    columns.append(kept)
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, t.type) for c, t in zip(columns, schema, strict=True)], schema=schema
                )

    return run


def _packer(limit: int, open_bins: int, turn: int):
    def run(pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values(["length", "row_id"], ascending=[False, True], kind="stable")
        bins, places, fill = best_fit(pieces["length"].tolist(), limit, open_bins)
        bins = np.array(bins, dtype="i8")
        first = (turn << 56) + (int(pieces["packer"].iloc[0]) << 20)
        pieces["sequence_id"], pieces["offset"] = first + bins, np.array(places, dtype="i8")
        pieces["loose"] = np.array(fill)[bins] < WELL_FILLED * limit
        return pieces.drop(columns="packer")

    return run


def pack_documents(
    docs: DataFrame,
    path: str,
    limit: int = 2048,
    end_id: int = 0,
    open_bins: int = OPEN_BINS,
    per_packer: int = PIECES,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of the documents and where they lie: ``(id, piece, start, length, ids_crc32, sequence_id, offset)``.

    A document's ids are those of the byte-level BPE in ``path`` (strings of special tokens stand for these),
    then ``end_id``. It is cut only where it is longer than ``limit``; its first piece may be shorter than the
    others. Pieces of a sequence lie side by side from offset 0. ``with_ids`` adds the ids of each piece.

    A NULL or empty text is a document of ``end_id`` alone. Rows are packed one by one: NULL or repeated keys
    are documents of their own. An empty table gives no rows. Other columns, whatever their names, are left
    out. The same stored table gives the same packing.
    """
    staging = Staging(docs.sparkSession)
    chosen = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    described = chosen.select("id").withColumns(
        {"piece": F.lit(0), "start": F.lit(0).cast("long"), "length": F.lit(0).cast("long"), "ids_crc32": F.lit(0).cast("long")}
    )
    if with_ids:
        described = described.withColumn("ids", F.array().cast("array<int>"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in described.schema)
    id_type = _arrow_type(chosen)
    types = [id_type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
    arrow = pa.schema(list(zip(described.columns, types, strict=False)))
    cut = chosen.mapInArrow(_cut(path, limit, end_id, with_ids, arrow), fields)
    stored = staging.keep(cut.withColumn("row_id", F.monotonically_increasing_id()), "pieces")

    names = ["id", "piece", "start", "length", "ids_crc32"]
    todo, left, turn, done = stored.select("row_id", *names), stored.count(), 0, []
    while left:
        packers = math.ceil(left / per_packer)
        dealt = todo.withColumn("packer", F.expr(f"pmod(xxhash64(row_id, {turn}), {packers})"))
        placed = todo.limit(0).selectExpr("*", "0L AS sequence_id", "0L AS offset", "true AS loose").schema
        packed = staging.keep(dealt.groupBy("packer").applyInPandas(_packer(limit, open_bins, turn), placed), f"packed-{turn}")
        again = packed.where("loose").count() if packers > 1 else 0
        if again == 0 or again > left / 2:  # nothing to gain from packing once more
            done.append(packed)
            break
        done.append(packed.where("NOT loose"))
        todo, left, turn = packed.where("loose").select("row_id", *names), again, turn + 1
    result = done[0] if done else stored.selectExpr("*", "0L AS sequence_id", "0L AS offset")
    for more in done[1:]:
        result = result.union(more)
    if with_ids and done:
        result = result.join(stored.select("row_id", "ids"), "row_id")
    out = [F.col("id").alias(id_column), *names[1:], "sequence_id", "offset"]
    return result.select(*out, *(["ids"] if with_ids else []))


def sequences(packed: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``(sequence_id, length, documents, ids)`` of the sequences, from pieces that carry their ids.

    ``documents`` lists ``(id, piece, offset, length)`` of the pieces in their order.
    """
    member = F.struct("offset", F.col(id_column).alias("id"), "piece", "length", "ids")
    rows = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(member)).alias("members"))
    return rows.select(
        "sequence_id",
        F.expr("aggregate(members, 0L, (n, m) -> n + m.length)").alias("length"),
        F.expr("transform(members, m -> struct(m.id, m.piece, m.offset, m.length))").alias("documents"),
        F.expr("flatten(members.ids)").alias("ids"),
    )


def _arrow_type(df: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[0].dataType)
