"""Quality scores by nearest-neighbour voting over latent-semantic vectors.

A text is a bag of terms: hashed byte trigrams, and hashed shapes of its words (case, digits,
signs), where a word that repeats the one before it is a term of its own.  A singular value
decomposition of a bounded, labelled sample gives the latent space.  The sample's vectors and
labels travel with the tasks, and every document is compared with all of them: blocks of
documents times the whole matrix are exact cosines, and the most similar ones vote.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starwright.llm.common import first_by_hash, materialize
from starwright.llm.words import texts_of, words_between_spaces

#: Bound of the learning sample, half of it for each label, and sizes of the model.
SAMPLE, LATENT = 2000, 48
TRIGRAMS, SHAPES = 1024, 512
TRIGRAM_SHARE = 0.25
NEIGHBOURS, SHARPNESS = 16, 8
BLOCK_ROWS, BLOCK_BYTES = 1024, 16 << 20

_LETTERS, _DIGITS = re.compile(r"[^\W\d_]+"), re.compile(r"\d+")


def _letters(run: re.Match) -> str:
    text = run.group()
    return "A" if text.isupper() and len(text) > 1 else "Aa" if text[0].isupper() else "a"


def shape_of(word: str) -> str:
    return _DIGITS.sub("0", _LETTERS.sub(_letters, word))


def _shape_counts(texts: pa.Array) -> np.ndarray:
    split = words_between_spaces(texts)
    folded: dict[str, int] = {}
    lower = np.fromiter(
        (folded.setdefault(word.lower(), len(folded)) for word in split.words),
        np.int64, len(split.words),
    )[split.codes]
    shapes = [shape_of(word) for word in split.words]
    known = {
        shape: [zlib.crc32((shape + mark).encode()) % SHAPES for mark in ("", "=")]
        for shape in set(shapes)
    }
    terms = np.array([known[shape] for shape in shapes], np.int64).reshape(-1, 2)
    again = np.zeros(len(lower), np.int64)
    again[1:] = lower[1:] == lower[:-1]
    firsts = split.bounds[:-1]
    again[firsts[firsts < len(again)]] = 0
    text_of = np.repeat(np.arange(len(texts)), np.diff(split.bounds))
    at = text_of * SHAPES + terms[split.codes, again]
    # Runs of white space leave empty words, which are no terms.
    real = np.array([bool(word) for word in split.words], bool)[split.codes]
    counts = np.bincount(at[real], minlength=len(texts) * SHAPES)
    return counts.reshape(len(texts), SHAPES).astype(np.float32)


def _trigram_counts(texts: pa.Array) -> np.ndarray:
    shift = np.uint32(32 - (TRIGRAMS - 1).bit_length())
    counts = np.zeros((len(texts), TRIGRAMS), np.float32)
    for row, text in enumerate(texts):
        data = np.frombuffer(text.as_buffer(), np.uint8).astype(np.uint32)
        if len(data) > 2:
            grams = data[:-2] | data[1:-1] << 8 | data[2:] << 16
            # A fixed multiplier spreads the three bytes over the high bits.
            bins = grams * np.uint32(2654435761) >> shift
            counts[row] = np.bincount(bins, minlength=TRIGRAMS)
    return counts


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


def _damped(counts: np.ndarray) -> np.ndarray:
    return np.sqrt(counts / np.maximum(1, counts.sum(axis=1, keepdims=True)))


def term_counts(texts: pa.Array) -> np.ndarray:
    return np.hstack([_trigram_counts(texts), _shape_counts(texts)])


@dataclass
class Model:
    """Weights of the terms, the latent directions, and the labelled vectors."""

    weights: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def latent(self, counts: np.ndarray) -> np.ndarray:
        return _unit(_weighted(counts, self.weights) @ self.directions)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest, weighted by similarity; the prior if none is."""
        if not len(self.labels):
            return np.full(len(counts), self.prior)
        near = self.latent(counts) @ self.vectors.T
        k = min(NEIGHBOURS, len(self.labels))
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(near, best, 1), 0).astype(np.float64) ** SHARPNESS
        total = weight.sum(axis=1)
        voted = (weight * self.labels[best]).sum(axis=1) / np.maximum(total, 1e-300)
        return np.where(total > 0, np.clip(voted, 0, 1), self.prior)


def _weighted(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    grams, shapes = counts[:, :TRIGRAMS], counts[:, TRIGRAMS:]
    return np.hstack([
        TRIGRAM_SHARE * _unit(_damped(grams) * weights[:TRIGRAMS]),
        (1 - TRIGRAM_SHARE) * _unit(_damped(shapes) * weights[TRIGRAMS:]),
    ]).astype(np.float32)


def fit_counts(counts: np.ndarray, labels: np.ndarray, prior: float) -> Model:
    """Decompose the weighted term counts of the sample."""
    rows = len(labels)
    weights = np.log((1 + rows) / (1 + (counts > 0).sum(axis=0))) + 1
    terms = _weighted(counts, weights)
    _, directions = np.linalg.eigh(terms.T.astype(np.float64) @ terms)
    directions = directions[:, -LATENT:].astype(np.float32)
    model = Model(weights, directions, np.empty((0, LATENT), np.float32), labels, prior)
    model.vectors = model.latent(counts) if rows else model.vectors
    return model


def fit(
    docs: DataFrame, labels: DataFrame, learn_from: Column,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
) -> Model:
    """Learn from labelled documents for which ``learn_from``, an expression on ``docs``, holds.

    The sample has at most ``SAMPLE`` distinct texts, chosen by their hash, half for each
    label; copies count once.  Texts stay where they are: only hashes are joined with labels,
    and term counts of the sample reach the driver.  Rows without id, text or label teach
    nothing; without labels the score is 0.5.
    """
    texts = docs.where(learn_from & F.col(text_col).isNotNull())
    hashed = texts.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("h"))
    known = labels.where(F.col(label_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), (F.col(label_col) > 0).cast("int").alias("label")
    )
    candidates = hashed.join(known, "doc_id").groupBy("h", "label").count()
    chosen = materialize(
        first_by_hash(candidates.select("h", "label"), "label", "h", SAMPLE // 2),
        "quality-sample",
    )
    share = candidates.agg(F.sum(F.col("label") * F.col("count")) / F.sum("count")).first()[0]
    sample = (
        texts.select(F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
        .join(F.broadcast(chosen), "h")
        .select("h", "label", "text")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = term_counts(texts_of(batch.column(2)))
            packed = [row.astype("<f4").tobytes() for row in counts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(packed, pa.binary())],
                names=["h", "label", "counts"],
            )

    # Copies of a text meet again before they are sent.
    rows = (
        sample.groupBy("h", "label").agg(F.min("text").alias("text"))
        .mapInArrow(count, "h long, label int, counts binary")
        .orderBy("h", "label")
        .collect()
    )
    counts = np.array(
        [np.frombuffer(row.counts, "<f4") for row in rows], np.float32
    ).reshape(len(rows), TRIGRAMS + SHAPES)
    prior = 0.5 if share is None else float(share)
    return fit_counts(counts, np.array([row.label for row in rows], np.float64), prior)


def scorer(model: Model) -> Callable[[Column], Column]:
    """A column function from text to score.  Null and empty texts get the prior."""
    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = texts_of(batch)
            rows = max(1, min(BLOCK_ROWS, len(texts) * BLOCK_BYTES // max(1, texts.nbytes)))
            blocks = [
                model.score(term_counts(texts[start : start + rows]))
                for start in range(0, len(texts), rows)
            ]
            yield pa.array(np.concatenate([*blocks, []]))

    return score


def predict(
    docs: DataFrame, model: Model, threshold: float = 0.3,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, score, predicted`` (1 if the score reaches the threshold).

    Repeated rows and null ids stay rows of their own; an empty table gives no row; terms are
    counted over whole texts, whatever their length.  Other columns are left out.
    """
    scored = docs.select(
        F.col(id_col).alias("doc_id"), scorer(model)(F.col(text_col)).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
