"""Best-fit packing of documents into training sequences under several capacities.

A sequence has room for tokens, for documents and for attention cost (the sum of squared piece
lengths, as attention stays inside a document).  Pieces go in descending length to the sequence
that fits them best: the one with the smallest weighted dot product of demand and residual
capacity, or with the smallest weighted norm of the residual that would be left, among those in
which no capacity is exceeded.

What a piece asks for follows from its length alone.  So the corpus is counted by length, at
most one row per token of capacity, and the rule is run over *groups* of sequences that are
filled alike: exactly what it gives piece by piece, at a cost that does not grow with the
corpus.  The outcome is a short plan: which ranks of a length go to which sequences.  Pieces
learn their rank from counts per task and length, and their place from the plan, where they are;
nothing is collected, and no length, however common, meets in one task.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starwright.llm.common import keyed_text, lookup_join, materialize, shared_text, stored
from starwright.llm.words import (
    BYTE_PIECES, Ragged, batches_of, collector_off, spaced_piece_encoder, spaced_pieces,
    sums_between, texts_of, word_encoder, words_with_spaces,
)

BATCH_ROWS, BATCH_BYTES, KEPT_PIECES = 5000, 16 << 20, 400_000


@dataclass(frozen=True)
class Limits:
    """What a sequence holds; every single piece fits into an empty one."""

    tokens: int = 1024
    documents: int | None = None
    attention: int | None = None

    @property
    def vector(self) -> np.ndarray:
        documents = self.tokens if self.documents is None else self.documents
        attention = self.tokens**2 if self.attention is None else self.attention
        if documents < 1 or attention < self.tokens**2:
            raise ValueError("a full piece alone exceeds a capacity")
        return np.array([self.tokens, documents, attention], np.int64)


@dataclass(frozen=True)
class Rule:
    """How sequences are compared: ``dot`` or ``norm``, with a weight per capacity."""

    kind: str = "norm"
    weights: tuple[float, float, float] = (1.0, 0.0, 0.0)

    def score(self, residual: np.ndarray, demand: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """Smaller is better, for rows of residual capacity."""
        weights = np.array(self.weights)
        if self.kind == "dot":
            return (residual / whole * (demand / whole)) @ weights
        if self.kind == "norm":
            return ((residual - demand) / whole) ** 2 @ weights
        raise ValueError(f"no rule {self.kind}")


# The plan with the fewest sequences is taken; of equal ones the first.
RULES = (
    Rule("norm", (1.0, 0.0, 0.0)),
    Rule("norm", (1.0, 0.1, 0.1)),
    Rule("dot", (1.0, 0.0, 0.0)),
    Rule("dot", (1.0, 0.1, 0.1)),
)


@dataclass(frozen=True)
class Plan:
    """Rows ``length, first rank, pieces per sequence, first sequence, offset``, in order."""

    rows: np.ndarray
    sequences: int


def plan(counts: Mapping[int, int], limits: Limits, rule: Rule) -> Plan:
    """Best fit over ``counts`` pieces of each length, longest first.

    Groups are runs of sequences with equal residual capacity.  A piece makes its sequence
    fit better still under either rule, so a sequence takes pieces of one length until a
    capacity is reached; equal sequences are taken by number.
    """
    whole = limits.vector
    residual = np.empty((0, 3), np.int64)
    base = np.empty(0, np.int64)
    size = np.empty(0, np.int64)
    rows, used = [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        demand = np.array([length, 1, length * length], np.int64)
        while left:
            fits = np.flatnonzero((residual >= demand).all(axis=1))
            if len(fits):
                scores = rule.score(residual[fits], demand, whole)
                best = fits[scores == scores.min()]
                group = int(best[np.argmin(base[best])])
            else:
                most = int((whole // demand).min())
                group = len(base)
                residual = np.vstack([residual, whole])
                base, size = np.append(base, used), np.append(size, -(-left // most))
                used += int(size[-1])
            most = min(left, int((residual[group] // demand).min()))
            taken = min(int(size[group]), left // most)
            rows.append((length, rank, most, int(base[group]), int(whole[0] - residual[group, 0])))
            rank, left = rank + taken * most, left - taken * most
            if taken < size[group]:
                # The sequences that were not reached stay a group of their own.
                residual = np.vstack([residual, residual[group]])
                base = np.append(base, base[group] + taken)
                size = np.append(size, size[group] - taken)
                size[group] = taken
            residual[group] -= most * demand
    table = np.array(rows, np.int64).reshape(-1, 5)
    return Plan(table, used)


def best_plan(counts: Mapping[int, int], limits: Limits, rules: Sequence[Rule] = RULES) -> Plan:
    return min((plan(counts, limits, rule) for rule in rules), key=lambda found: found.sequences)


def pieces(
    docs: DataFrame, path: str, end_id: int, capacity: int, with_ids: bool = False
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, task, turn`` and, if asked for, ``ids``.

    ``turn`` numbers the pieces of one length in a task; it holds once the frame is written.
    """
    vocabulary = shared_text(path)
    fields = [
        T.StructField("doc_id", docs.schema["doc_id"].dataType),
        T.StructField("piece", T.IntegerType()),
        *(T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32")),
        T.StructField("task", T.IntegerType()),
        T.StructField("turn", T.LongType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    schema = T.StructType(fields)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from tokenizers import Tokenizer

        task = TaskContext.get().partitionId()
        ids_of_pieces = spaced_piece_encoder(Tokenizer.from_str(vocabulary), KEPT_PIECES)
        ids_of_words = word_encoder(vocabulary, BYTE_PIECES, lower=False)
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches_of(batches, BATCH_ROWS, BATCH_BYTES):
            split = words_with_spaces(texts_of(batch.column(1)))
            # Distinct words are cut in Arrow; Python sees each distinct piece once.
            counts, places, parts, whole = spaced_pieces(pa.array(split.words, pa.large_string()))
            with collector_off():
                ids = Ragged(ids_of_pieces(parts) + ids_of_words(whole), np.uint32)
            in_words = np.concatenate([[0], np.cumsum(counts)])
            words = Ragged.of(ids.take(places), sums_between(ids.sizes[places], in_words))
            flat = words.take(split.codes)
            ends = np.cumsum(sums_between(words.sizes[split.codes], split.bounds))
            flat = np.ascontiguousarray(np.insert(flat, ends, end_id), dtype="<u4")
            sizes = np.diff(ends, prepend=0) + 1
            count = -(-sizes // capacity)
            row = np.repeat(np.arange(len(sizes)), count)
            number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            # Only the first piece may be shorter.
            head = sizes - (count - 1) * capacity
            length = np.where(number == 0, head[row], capacity)
            start = np.where(number == 0, 0, head[row] + (number - 1) * capacity)
            bounds = np.concatenate([[0], np.cumsum(length)])
            data = memoryview(flat).cast("B")
            crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(bounds, bounds[1:])]
            by_length = np.argsort(length, kind="stable")
            ordered = length[by_length]
            turn = np.empty(len(length), np.int64)
            turn[by_length] = np.arange(len(length)) - np.searchsorted(ordered, ordered)
            turn += seen[length]
            seen += np.bincount(length, minlength=capacity + 1)
            columns = [
                batch.column(0).take(pa.array(row)), pa.array(number, pa.int32()),
                pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
                pa.array(np.full(len(row), task), pa.int32()), pa.array(turn),
            ]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(
                    pa.array(bounds, pa.int32()), pa.array(flat.astype(np.int32))
                ))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(cut, schema)


def pack(
    docs: DataFrame, path: str, end_id: int = 2, limits: Limits = Limits(),
    rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Documents are the ids of the byte-level ``tokenizers`` file at ``path`` and ``end_id``;
    those of more than ``limits.tokens`` are cut, so that only the first piece is shorter.
    ``start`` counts the ids of the document before the piece, ``offset`` the tokens before it in
    its sequence.  ``with_ids`` adds the ids.  A null text counts as empty, a piece of the end id
    alone; repeated rows and null ids are documents of their own; an empty table gives no row;
    a very long text is cut whole, in the batch that it is.  Other columns are left out.
    """
    frame = keyed_text(docs, id_col, text_col)
    cut = stored(pieces(frame, path, end_id, limits.tokens, with_ids), "packing-pieces")
    counts = materialize(
        cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "packing-counts"
    )
    by_length = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    found = best_plan({r.length: r.n for r in by_length}, limits, rules)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = materialize(
        counts.select(
            "length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
        ),
        "packing-ranks",
    )
    ranked = lookup_join(cut, offsets, ["length", "task"]).withColumn(
        "rank", F.col("before") + F.col("turn")
    )
    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    schema = T.StructType([
        *(cut.schema[name] for name in kept),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ])
    return ranked.select(*kept, "rank").mapInArrow(placer(found, schema), schema)


def placer(found: Plan, schema: T.StructType):
    """Turns length and rank into sequence and offset; the plan travels with the tasks."""
    rows = found.rows
    span = int(rows[:, 1].max(initial=0)) + 1
    # Rows sorted by length, then first rank, as one number; Python's as it may be large.
    order = np.lexsort((rows[:, 1], rows[:, 0]))
    length, first, per, base, offset = rows[order].T
    bits = max(1, math.ceil(math.log2(span + 1)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            key = (sizes << bits) + np.minimum(rank, span)
            at = np.searchsorted((length << bits) + first, key, side="right") - 1
            turn = rank - first[at]
            columns = [batch.column(name) for name in schema.names[:-2]]
            columns.append(pa.array(base[at] + turn // per[at]))
            columns.append(pa.array(offset[at] + turn % per[at] * sizes))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return place
