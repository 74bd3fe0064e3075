"""Sharding by extendible hashing.

A directory of hash prefixes grows only where it must: a bucket over the byte limit splits on the
next bit of its rows' hash, all others stay as they are. A row's shard is the shortest prefix of
its hash whose rows fit the limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import Staging

#: Bits of one hash word; a key's word is followed by a word of the row's text, so that rows of one hot key split too.
WORD_BITS = 60
WORDS = 2
#: Bits that one pass over the rows resolves; a pass aggregates to at most 2**CHUNK cells a bucket.
CHUNK = 12


def hash_word(value: str) -> str:
    """SQL for the first 60 bits of the MD5 of a string."""
    return f"CAST(conv(substr(md5({value}), 1, 15), 16, 10) AS BIGINT)"


def _hash_words(key: str, text: str) -> list[str]:
    return [hash_word(f"coalesce(CAST({key} AS STRING), '')"), hash_word(f"coalesce({text}, '')")]


def directory(df: DataFrame, byte_limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(at, shard_bytes, depth)``: the hash prefixes that are shards, stored in the shared folder."""
    staging = Staging(df.sparkSession)
    h0, h1 = _hash_words(key, text)
    rows = staging.keep(
        df.selectExpr(f"coalesce(octet_length({text}), 0) AS bytes", f"{h0} AS h0", f"{h1} AS h1"), "rows"
    )
    open_rows = rows.select("h0", "h1", "bytes", F.lit("").alias("prefix"))
    found = []
    for word in range(WORDS):
        for start in range(0, WORD_BITS, CHUNK):
            width = min(CHUNK, WORD_BITS - start)
            last = word == WORDS - 1 and start + width == WORD_BITS
            cells = open_rows.groupBy(
                "prefix", F.expr(f"(h{word} >> {WORD_BITS - start - width}) & {2**width - 1}").alias("cell")
            ).agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"))
            cells = cells.withColumn("bits", F.expr(f"lpad(bin(cell), {width}, '0')"))
            depths = cells.select("*", F.explode(F.expr(f"sequence(0, {width})")).alias("d")).withColumn(
                "at", F.expr("concat(prefix, left(bits, d))")
            )
            sums = depths.groupBy("at").agg(
                F.sum("bytes").alias("shard_bytes"), F.sum("n").alias("rows"), F.max("d").alias("d")
            )
            fits = sums.where(F.expr(f"shard_bytes <= {byte_limit} OR rows = 1" + (f" OR d = {width}" if last else "")))
            # The shortest prefix that fits: its parent does not.
            opened = sums.where(~F.expr(f"shard_bytes <= {byte_limit} OR rows = 1")).select(F.col("at").alias("parent"))
            first = fits.where("d = 0")
            later = fits.where("d > 0").withColumn("parent", F.expr("left(at, length(at) - 1)")).join(opened, "parent", "left_semi")
            stage = f"directory-{word}-{start}"
            directory = staging.keep(first.select("at", "shard_bytes").unionByName(later.select("at", "shard_bytes")), stage)
            found.append(directory)
            if last:
                break
            over = staging.keep(opened.where(f"length(parent) = {word * WORD_BITS + start + width}"), f"over-{word}-{start}")
            if over.isEmpty():
                break
            prefix = F.expr(_bits(word, start + width))
            open_rows = rows.withColumn("prefix", prefix).join(over.withColumnRenamed("parent", "prefix"), "prefix", "left_semi")
        else:
            continue
        break
    shards = found[0]
    for more in found[1:]:
        shards = shards.unionByName(more)
    deepest = staging.keep(shards.withColumn("depth", F.length("at")), "shards")
    staging.drop("rows")
    return deepest


def _place(
    df: DataFrame, shards: DataFrame, key: str, text: str, kept: dict[str, Column] | None = None
) -> DataFrame:
    """Rows of ``df`` (or the columns ``kept`` of them) as a struct ``row`` beside the shard each belongs to."""
    used = [r["depth"] for r in shards.select("depth").distinct().orderBy("depth").collect()]  # at most 121 values
    h0, h1 = _hash_words(key, text)
    rows = df.select(F.struct(*[c.alias(n) for n, c in kept.items()] if kept else ["*"]).alias("row"), F.expr(h0).alias("h0"), F.expr(h1).alias("h1"))
    rows = rows.withColumn("all_bits", F.expr(_bits(WORDS - 1, WORD_BITS)))
    prefixes = F.array(*[F.expr(f"left(all_bits, {d})") for d in used or [0]])
    return rows.select("row", F.explode(prefixes).alias("at")).join(shards, "at")


def extendible_shards(df: DataFrame, byte_limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, bytes, shard, depth, shard_bytes, oversized)`` for every row of ``df``.

    ``shard`` is the hash prefix in binary (empty: everything fits one shard), ``bytes`` the UTF-8
    length of the text. NULL keys hash as a key of their own, NULL and empty texts weigh 0 bytes.
    Rows that share the key are told apart by their text; rows equal in both always share a shard.
    A shard of one row, or of rows that no bit tells apart, stays even if it is over the limit and is
    marked ``oversized``. An empty table has no shards. Other columns are not read.
    """
    kept = {"k": F.col(key), "b": F.expr(f"CAST(coalesce(octet_length({text}), 0) AS BIGINT)")}
    return _place(df, directory(df, byte_limit, key, text), key, text, kept).select(
        F.col("row.k").alias(key),
        F.col("row.b").alias("bytes"),
        F.col("at").alias("shard"),
        F.col("depth").cast("int").alias("depth"),
        F.col("shard_bytes").cast("long").alias("shard_bytes"),
        (F.col("shard_bytes") > byte_limit).alias("oversized"),
    )


def _bits(word: int, upto: int) -> str:
    """SQL for the hash prefix up to bit ``upto`` of word ``word``, in binary."""
    full = [f"lpad(bin(h{w}), {WORD_BITS}, '0')" for w in range(word)]
    return f"concat({', '.join([*full, f'left(lpad(bin(h{word}), {WORD_BITS}, {chr(39)}0{chr(39)}), {upto})'])})"


def write_shards(df: DataFrame, path: str, byte_limit: int, key: str = "doc_id", text: str = "text") -> None:
    """Write the rows of ``df`` with all their columns, one folder ``shard=<prefix>`` for each shard.

    The rows of a shard meet in one task, which the byte limit bounds.
    """
    placed = _place(df, directory(df, byte_limit, key, text), key, text)
    named = placed.select("row.*", F.concat(F.lit("p"), "at").alias("shard"))
    named.repartition("shard").write.partitionBy("shard").parquet(path)
