"""The contract queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starwright.llm import (
    bpe, decontam, knn_quality, merkle, packing, periodic, pii, rans, rotated_bits, simhash,
    token_counts, warc, zstd_langid,
)
from starwright.llm.common import read_table
from starwright.llm.oracles import LOWER, ORACLES, UPPER

__all__ = ["BYTE_BPE", "ORACLES", "QUERIES", "WORD_BPE", "fold"]

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def fold(id_col: str, folds: int) -> Column:
    """CRC-32 class of an id as text; a null id is in class 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds, F.lit(0))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs)).select(
        "doc_id",
        *(f"n_{kind}" for kind in pii.BASE_KINDS),
        F.sha2(F.array_join("base", ","), 256).alias("base_sha256"),
        F.array_join("spans", ",").alias("spans"),
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), WORD_BPE, over=2048)


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotated_bits.nearest(
        spark, read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, most=10
    )


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(read_table(spark, sf_dir, "documents"), BYTE_BPE)


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op6_rans_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans.encode_read_back(read_table(spark, sf_dir, "documents"), WORD_BPE, end_id=2)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 5) == 0
    model = knn_quality.fit(docs, read_table(spark, sf_dir, "labels"), ~held_out)
    return knn_quality.predict(docs, model, threshold=0.3).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted"
    )


def op8_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read_table(spark, sf_dir, "pages"), min_bytes=0)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 4) == 2
    learned = zstd_langid.learn(docs.where(~held_out))
    return zstd_langid.predict(docs, learned).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected"
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), width=10
    ).drop("spans", "items", "near_items")


def op10_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The proximity matches: number and digest of the items found exactly or close by."""
    return decontam.decontaminate(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), width=10
    ).select(
        "doc_id",
        F.size("near_items").cast("long").alias("n_near"),
        F.sha2(F.array_join("near_items", ","), 256).alias("near_sha256"),
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents, verified against a copy with texts lower-cased in a third."""
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    lowered = F.when(tampered, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    manifest = merkle.build(read_table(spark, sf_dir, "documents"), claims={"text": lowered})
    return merkle.verify(manifest.proofs()).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(
        read_table(spark, sf_dir, "documents"), BYTE_BPE, end_id=2, limits=packing.Limits(1024)
    )


def planted_period(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """The contract's rule: a tenth of all documents repeat from a place on."""
    if doc_id is None:
        return None
    rest, digit = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if digit:
        return None
    at = rest % n
    return at, 1 + (n - at) // (3 + rest % 8)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    listed = F.transform("runs", lambda run: F.concat(
        run["start"].cast("string"), F.lit(","), run["length"].cast("string"), F.lit(","),
        run["period"].cast("string"), F.lit("\n"),
    ))
    return periodic.periodic_runs(docs, rewrite=planted_period).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli",
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_pii": op1_pii,
    "op2_token_counts": op2_token_counts,
    "op3_nearest": op3_nearest,
    "op4_bpe_round_trip": op4_bpe_round_trip,
    "op5_simhash_dedup": op5_simhash_dedup,
    "op6_rans_files": op6_rans_files,
    "op7_quality": op7_quality,
    "op8_warc_round_trip": op8_warc_round_trip,
    "op9_language": op9_language,
    "op10_decontamination": op10_decontamination,
    "op10_proximity": op10_proximity,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_best_fit_packing": op12_best_fit_packing,
    "op13_periodic_runs": op13_periodic_runs,
}
