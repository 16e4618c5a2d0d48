"""Benchmark decontamination with a distributed positional inverted index.

The training documents become an index sharded by document: a row holds a bounded block of
documents and, for every term, the sorted positions of the term in the block.  Documents of a
block lie end to end with a gap between them, so a position tells the document and no phrase
crosses two.  Nothing is shuffled to build it, it is written once, and it knows nothing of a
benchmark, so it serves any number of searches.

A search starts from the rarest terms of each window, by their count over the whole corpus.  A
block looks only at windows whose rarest term it has.  The positions of a term, less its offset
in the window, are possible starts; the lists are intersected from rare to frequent until no
start is left or all terms agree (an exact phrase).  A proximity match asks only the rarest terms
to lie within a few words of their places.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starwright.llm.common import keyed_text, scratch_path, stored
from starwright.llm.words import batches_of, texts_of

BATCH_ROWS, BATCH_BYTES = 4096, 16 << 20
#: Bytes of words in the windows that one search ships to the tasks; a benchmark with more takes
#: more searches of the one index.
SLICE_BYTES = 16 << 20

# Fixed values of the contract: ASCII letters and digits, and everything beyond ASCII.
_KEPT = bytes([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
_ONLY_WORDS = bytes(b if b in _KEPT else 0x20 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words after A-Z are lowered; all other ASCII separates.  Null has none."""
    return (text or "").encode().translate(_ONLY_WORDS).lower().split()


class Slice(NamedTuple):
    """Part of the benchmark: its terms, its distinct windows and the ids of its items."""

    terms: dict[bytes, int]
    windows: dict[tuple[int, tuple[int, ...]], None]
    names: list[str]


def slices_of(items: Iterator[tuple], width: int, limit: int) -> Iterator[Slice]:
    """Cut items (id, text) into slices whose windows have at most ``limit`` bytes, or one window.

    A long item is cut as well, and is then in several slices.
    """
    part, size = Slice({}, {}, []), 0
    for name, text in items:
        words, named = words_of(text), False
        wide = min(width, len(words))
        for start in range(len(words) - wide + 1 if words else 0):
            window = words[start : start + wide]
            cost = sum(map(len, window))
            if part.windows and size + cost > limit:
                yield part
                part, size, named = Slice({}, {}, []), 0, False
            if not named:
                part.names.append("" if name is None else str(name))
                named = True
            size += cost
            numbers = tuple(part.terms.setdefault(word, len(part.terms)) for word in window)
            part.windows[len(part.names) - 1, numbers] = None
    yield part


INDEX_FIELDS = [
    T.StructField("starts", T.BinaryType()),
    T.StructField("sizes", T.BinaryType()),
    T.StructField("terms", T.ArrayType(T.BinaryType())),
    T.StructField("counts", T.BinaryType()),
    T.StructField("postings", T.BinaryType()),
]


def build_index(docs: DataFrame, gap: int, label: str) -> DataFrame:
    """Postings of all terms in all documents (``doc_id, row, text``), a row per block.

    Columns: ``doc_ids``, ``rows``; ``starts`` and ``sizes`` (place of a document's first word,
    number of its words); ``terms``, ``counts`` and ``postings`` (sorted places of one term after
    the other, each list as steps).
    """
    schema = T.StructType([
        T.StructField("doc_ids", T.ArrayType(docs.schema["doc_id"].dataType)),
        T.StructField("rows", T.ArrayType(T.LongType())),
        *INDEX_FIELDS,
    ])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, BATCH_ROWS, BATCH_BYTES):
            number: dict[bytes, int] = {}
            codes, sizes = [], []
            for text in texts_of(batch.column(2)):
                words = words_of(text.as_py())
                sizes.append(len(words))
                codes.append(np.fromiter(
                    (number.setdefault(w, len(number)) for w in words), np.int32, len(words)
                ))
            codes, sizes = np.concatenate(codes), np.array(sizes, np.int64)
            starts = np.cumsum(sizes + gap) - sizes - gap
            at = np.arange(len(codes)) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)
            counts = np.bincount(codes, minlength=len(number))
            places = at[np.argsort(codes, kind="stable")]
            steps = np.diff(places, prepend=0)
            first = (np.cumsum(counts) - counts)[counts > 0]
            steps[first] = places[first]
            whole = pa.array([0, batch.num_rows], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays(whole, batch.column(0)),
                    pa.ListArray.from_arrays(whole, batch.column(1)),
                    pa.array([starts.astype("<i8").tobytes()], pa.binary()),
                    pa.array([sizes.astype("<i8").tobytes()], pa.binary()),
                    pa.array([list(number)], pa.list_(pa.binary())),
                    pa.array([counts.astype("<u4").tobytes()], pa.binary()),
                    pa.array([steps.astype("<u4").tobytes()], pa.binary()),
                ],
                names=schema.names,
            )

    return stored(docs.mapInArrow(index, schema), label)


def _agree(starts: np.ndarray, offset: int, places: np.ndarray, slack: int) -> np.ndarray:
    """Starts for which a term at ``offset`` has a place at most ``slack`` words away."""
    wanted = starts + offset
    at = np.searchsorted(places, wanted - slack)
    at[at == len(places)] = len(places) - 1
    return starts[np.abs(places[at] - wanted) <= slack]


def matching_starts(lists: list[tuple[int, np.ndarray]], slack: int = 0) -> np.ndarray:
    """Starts at which all terms agree; ``lists`` has offset and places, the rarest first."""
    starts = lists[0][1] - lists[0][0]
    for offset, places in lists[1:]:
        if not len(starts):
            break
        starts = _agree(starts, offset, places, slack)
    return starts


Window = tuple[int, list[tuple[int, int]]]


def _known_terms(terms: pa.ListScalar, numbers: dict[bytes, int]) -> dict[int, int]:
    """Numbers of the terms of a slice that a block has, with their place in the block."""
    found = ((numbers.get(term), i) for i, term in enumerate(terms.as_py()))
    return {number: i for number, i in found if number is not None}


def ordered_windows(index: DataFrame, terms: Broadcast, part: Slice) -> dict[int, list[Window]]:
    """Windows that can occur, by their rarest term, each as item and (offset, term) pairs.

    Pairs go from rare to frequent.  The counts cover the corpus; as many come back as the slice
    has terms.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = terms.value
        total = np.zeros(len(numbers), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                known = _known_terms(batch.column("terms")[i], numbers)
                counts = np.frombuffer(batch.column("counts")[i].as_py(), "<u4")
                total[list(known)] += counts[list(known.values())]
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found), pa.array(total[found])], names=["term", "n"]
        )

    often = [0] * len(part.terms)
    counted = index.select("terms", "counts").mapInArrow(count, "term long, n long")
    for row in counted.groupBy("term").agg(F.sum("n").alias("n")).collect():
        often[row.term] = row.n
    by_rarest: dict[int, list[Window]] = {}
    for item, window in part.windows:
        if all(often[term] for term in window):
            order = sorted(enumerate(window), key=lambda place: (often[place[1]], place[0]))
            by_rarest.setdefault(order[0][1], []).append((item, order))
    return by_rarest


def _look(
    block: dict[str, pa.Scalar], windows: dict[int, list[Window]], names: list[str],
    numbers: dict[bytes, int], slack: int, rarest: int,
):
    """Per document of a block: number of words, exact spans, exact items, items close by."""
    starts = np.frombuffer(block["starts"].as_py(), "<i8")
    sizes = np.frombuffer(block["sizes"].as_py(), "<i8")
    known = _known_terms(block["terms"], numbers)
    ends = np.cumsum(np.frombuffer(block["counts"].as_py(), "<u4"), dtype=np.int64)
    postings = np.frombuffer(block["postings"].as_py(), "<u4")
    opened: dict[int, np.ndarray] = {}

    def places(term: int) -> np.ndarray:
        if term not in opened:
            at = known[term]
            steps = postings[ends[at - 1] if at else 0 : ends[at]]
            opened[term] = np.cumsum(steps, dtype=np.int64)
        return opened[term]

    def owner(at: np.ndarray) -> np.ndarray:
        return np.searchsorted(starts, at, side="right") - 1

    spans = [([], []) for _ in sizes]
    exact: list[set[str]] = [set() for _ in sizes]
    close: list[set[str]] = [set() for _ in sizes]
    for item, order in (pair for term in known for pair in windows.get(term, ())):
        if any(term not in known for _, term in order[:rarest]):
            continue
        head = [(offset, places(term)) for offset, term in order[:rarest]]
        near = matching_starts(head, slack)
        for doc in np.unique(owner(near + head[0][0])):
            close[doc].add(names[item])
        if not len(near) or any(term not in known for _, term in order):
            continue
        found = matching_starts([(offset, places(term)) for offset, term in order])
        for doc, start in zip(owner(found), found):
            exact[doc].add(names[item])
            spans[doc][0].append(int(start - starts[doc]))
            spans[doc][1].append(int(start - starts[doc]) + len(order))
    return sizes, spans, exact, close


def search(
    index: DataFrame, part: Slice, slack: int, rarest: int
) -> tuple[DataFrame, list[Broadcast]]:
    """Matches of a slice, a row per document, and the broadcasts that they are found with.

    ``doc_id, row, n_words``, ``spans`` (exact matches: first word and the word after the
    last), ``items`` (found exactly), ``near_items`` (found exactly or close by).
    """
    # Both are bounded by SLICE_BYTES.
    context = index.sparkSession.sparkContext
    terms = context.broadcast(part.terms)
    shipped = context.broadcast((ordered_windows(index, terms, part), part.names))
    id_type = index.schema["doc_ids"].dataType.elementType
    schema = T.StructType([
        T.StructField("doc_id", id_type),
        T.StructField("row", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("starts", T.ArrayType(T.LongType())),
        T.StructField("ends", T.ArrayType(T.LongType())),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("near_items", T.ArrayType(T.StringType())),
    ])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, names = shipped.value
        for batch in batches:
            for i in range(batch.num_rows):
                block = {name: batch.column(name)[i] for name in batch.schema.names}
                sizes, spans, exact, close = _look(
                    block, windows, names, terms.value, slack, rarest
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        block["doc_ids"].values,
                        block["rows"].values,
                        pa.array(sizes),
                        pa.array([s for s, _ in spans], pa.list_(pa.int64())),
                        pa.array([e for _, e in spans], pa.list_(pa.int64())),
                        pa.array(map(sorted, exact), pa.list_(pa.string())),
                        pa.array(map(sorted, close), pa.list_(pa.string())),
                    ],
                    names=schema.names,
                )

    found = (
        index.mapInArrow(look, schema)
        .withColumn("spans", F.arrays_zip(F.col("starts").alias("start"), F.col("ends").alias("end")))
        .drop("starts", "ends")
    )
    return found, [terms, shipped]


def covered(spans: Column) -> Column:
    """Number of words in the union of spans."""
    state = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))

    def step(seen: Column, span: Column) -> Column:
        new = F.greatest(F.lit(0), span["end"] - F.greatest(seen["end"], span["start"]))
        return F.struct(
            F.greatest(seen["end"], span["end"]).alias("end"), (seen["n"] + new).alias("n")
        )

    return F.aggregate(F.array_sort(spans), state, step, lambda seen: seen["n"])


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, width: int = 10, slack: int = 3, rarest: int = 3,
    id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``,
    then ``spans`` (exact matches), ``items`` and ``near_items`` (ids as sorted strings).

    A window is ``width`` consecutive words of a benchmark item, or all of a shorter one.  A
    word of a document is hit if it lies in an exact occurrence of a window.  ``near_items``
    are items of which the ``rarest`` terms of a window lie within ``slack`` words of their
    places; items found exactly are among them.  A null text has no words; an item without
    words is no window; rows with one item id are one item, a null id is written as the empty
    text.  Repeated documents stay rows of their own; an empty table gives no row, an empty
    benchmark no hit; texts are indexed whole, whatever their length.  Other columns are left out.
    """
    frame = keyed_text(docs, id_col, text_col).select(
        "doc_id", F.monotonically_increasing_id().alias("row"), "text"
    )
    asked = benchmark.select(F.col(item_col).alias("name"), F.col(item_text_col).alias("text"))
    parts = slices_of(((r.name, r.text) for r in asked.toLocalIterator()), width, slice_bytes)
    index = build_index(frame, width + slack, "decontam-index")
    first = next(parts)
    part = next(parts, None)
    if part is None:
        rows = search(index, first, slack, rarest)[0]
    else:
        folder = scratch_path(docs.sparkSession, "decontam-found")
        number = 0
        # What a slice finds is written before the next one is made on the driver.
        for current in chain([first, part], parts):
            found, shipped = search(index, current, slack, rarest)
            if number:
                found = found.where(F.size("near_items") > 0)
            found.write.parquet(f"{folder}/slice-{number}")
            for broadcast in shipped:
                broadcast.unpersist()
            number += 1
        rows = (
            docs.sparkSession.read.schema(found.schema)
            .option("recursiveFileLookup", "true").parquet(folder)
            .groupBy("row").agg(
                F.first("doc_id").alias("doc_id"),
                F.max("n_words").alias("n_words"),
                *(
                    F.array_sort(F.array_distinct(F.flatten(F.collect_list(name)))).alias(name)
                    for name in ("spans", "items", "near_items")
                ),
            )
        )
    return rows.select(
        "doc_id",
        "n_words",
        covered(F.col("spans")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
        "spans", "items", "near_items",
    )
