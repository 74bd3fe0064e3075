"""The training-data operators as queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import (
    alignment,
    ann,
    bpe,
    fingerprint,
    katz,
    line_dedup,
    minhash,
    mining,
    mixing,
    packing,
    sharding,
    substring,
    toxicity,
)

#: Bytes of text a shard may hold.
SHARD_BYTES = 32 * 1024 * 1024
VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"
#: Tokens of a packed sequence.
SEQUENCE = 2048


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(modulus: int, remainder: int) -> str:
    return f"coalesce(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % {modulus} = {remainder}, false)"


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_groups(_table(spark, folder, "documents"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    known = _table(spark, folder, "labels").where(f"NOT {held_out(3, 1)}")
    scored = toxicity.score_toxicity(documents, toxicity.learn(documents, known))
    return scored.select("doc_id", F.expr(held_out(3, 1)).alias("held_out"), "score", "predicted")


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring.repeated_passages(_table(spark, folder, "documents"))


def op4_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.compare_edits(_table(spark, folder, "documents"))


def op5_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, folder, "documents"))


def op6_katz(spark: SparkSession, folder: str) -> DataFrame:
    return katz.score_texts(_table(spark, folder, "documents"), held_out(10, 0))


def op7_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    coded = bpe.encode_texts(_table(spark, folder, "documents"), path)
    decoded = coded.select("doc_id", "ids", bpe.decode_ids("ids", path).alias("decoded"), bpe.ids_digest("ids").alias("ids_sha256"))
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids_sha256",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op8_ann(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.extendible_shards(_table(spark, folder, "documents"), SHARD_BYTES)


def op10_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, folder, "documents"))


def op11_pack(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_table(spark, folder, "documents"), public_tokenizers.path(BYTE_VOCABULARY), SEQUENCE)


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    relabel = "CASE WHEN id % 7 = 0 THEN (label + 1) % 10 ELSE label END"
    return mining.hard_negatives(_table(spark, folder, "embeddings"), "id % 100 = 0", relabel)


def op13_align(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    return alignment.align_tokens(documents, public_tokenizers.path(BYTE_VOCABULARY), public_tokenizers.path(PIECE_VOCABULARY))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_fingerprint": op4_fingerprint,
    "op5_source_mix": op5_source_mix,
    "op6_katz": op6_katz,
    "op7_bpe": op7_bpe,
    "op8_ann": op8_ann,
    "op9_sharding": op9_sharding,
    "op10_minhash": op10_minhash,
    "op11_pack": op11_pack,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_align": op13_align,
}

ORACLE_SQL: dict[str, str] = {"op12_hard_negatives": mining.QUERY_SQL}
