"""Training-data pipeline: five stages, each calling one operator on what the last one kept.

Stages take ``(spark, docs, sf_dir)`` and return a frame; all but the last return the columns of
``documents``, whatever other columns there are.  Common to all: an empty table gives an empty
table; a null text is judged as an empty one; texts are read whole, whatever their length; every
row is judged by itself, whether it shares its ``doc_id`` with others or has none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starwright.llm import bpe, decontam, knn_quality, pii, simhash
from starwright.llm.common import lookup_join, materialize, read_table, stored
from starwright.llm.registry import BYTE_BPE, fold

LEAST_QUALITY = 0.3


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose quality score is below ``LEAST_QUALITY``.

    Labels of the fold that is held out elsewhere are not used.  Without any label the score
    is 0.5 and all stay.
    """
    model = knn_quality.fit(docs, read_table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return docs.where(knn_quality.scorer(model)(F.col("text")) >= LEAST_QUALITY)


def _numbered(docs: DataFrame, label: str) -> tuple[DataFrame, str]:
    """The rows, written with a number of their own each, and the name of its column."""
    number = "row_number"
    while number in (name.lower() for name in docs.columns):
        number += "_"
    return stored(docs.withColumn(number, F.monotonically_increasing_id()), label), number


def _without(
    rows: DataFrame, number: str, dropped: Column, found: DataFrame, label: str
) -> DataFrame:
    """Rows whose number is not among ``dropped``, a column of ``found``; without the numbers."""
    numbers = materialize(found.select(dropped.alias(number)), label)
    return lookup_join(rows, numbers, number, "left_anti").drop(number)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one document with the smallest id stays.

    Of rows that share this id the first one stays, and so it does of rows without an id if no
    row of their group has one.
    """
    rows, number = _numbered(docs, "pipeline-duplicates-rows")
    # In the order of these keys, rows without an id come last.
    key = F.struct(
        F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("name"),
        F.col(number).alias("number"),
    )
    keyed = rows.select(key.alias("key"), "text")
    found = simhash.near_duplicates(keyed, shingle=3, max_bits=3, id_col="key")
    others = found.where("doc_id != component_id")
    return _without(rows, number, F.col("doc_id.number"), others, "pipeline-duplicates")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in which a window of a benchmark item occurs."""
    rows, number = _numbered(docs, "pipeline-contaminated-rows")
    found = decontam.decontaminate(rows, read_table(spark, sf_dir, "benchmark"), id_col=number)
    return _without(
        rows, number, F.col("doc_id"), found.where("contaminated"), "pipeline-contaminated"
    )


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind, as in ``<EMAIL>``; ``n_chars`` follows the text."""
    masked = docs.withColumn("text", pii.masker(pii.fit(docs))(F.col("text")))
    if "n_chars" not in docs.columns:
        return masked
    kind = docs.schema["n_chars"].dataType
    return masked.withColumn("n_chars", F.length("text").cast(kind))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document: ``doc_id, n_tokens, ids_sha256, decoded_sha256, ids``."""
    return bpe.encode_decode(docs, BYTE_BPE, with_ids=True)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", keep_quality),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", mask_personal_data),
    ("bpe", tokenize),
]

#: Learned models and components of a graph have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
