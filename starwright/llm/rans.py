"""Token ids in binary files, coded by a static range asymmetric numeral system.

Files are byte streams that Spark's text sink writes: *frames*, each with a kind, a length and
a CRC-32, ended by a line feed.  A file holds one or more segments; a segment is a range of
document ids and starts with the shared frequency table.  Its tokens are cut into blocks.  A
block is coded alone by many interleaved coders: its checkpoint (states, first token, first
document and the token inside it) is all that a reader needs to begin there.

Frequencies come from all tokens of the corpus: the ids are written once to the shared folder,
counted, and then coded from there.
"""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starwright.llm.common import keyed_text, materialize, scratch_path, shared_text, stored
from starwright.llm.words import (
    WORD_PIECES, Ragged, batches_of, coded_words, collector_off, lowered_pieces,
    piece_encoder, sums_between, texts_of, word_encoder,
)

BATCH_ROWS, BATCH_BYTES = 5000, 20 << 20
KEPT_PIECES = 400_000
SCALE_BITS = 20
LANES, BLOCK = 4096, 1 << 20
SEGMENT_TOKENS = 8_000_000
LOW = np.uint64(1 << 31)
WORD_BITS, WORD_MASK = np.uint64(32), np.uint64(0xFFFFFFFF)

TABLE, DOCS, DATA = b"TABL", b"DOCS", b"DATA"
_FRAME, _BLOCK = "<4sQI", "<QIIIQQ"
_FRAME_SIZE, _BLOCK_SIZE = struct.calcsize(_FRAME), struct.calcsize(_BLOCK)


def scaled(counts: np.ndarray, bits: int = SCALE_BITS) -> np.ndarray:
    """Frequencies that sum to ``2 ** bits``; every symbol that occurs keeps at least one."""
    total = int(counts.sum())
    if not total:
        return np.zeros(len(counts), np.uint32)
    share = counts.astype(np.float64) * (1 << bits) / total
    freq = np.where(counts > 0, np.maximum(1, share.astype(np.int64)), 0)
    excess = int(freq.sum()) - (1 << bits)
    for symbol in np.argsort(-freq, kind="stable"):
        if excess <= 0:
            freq[symbol] -= excess
            break
        cut = min(excess, int(freq[symbol]) - 1)
        freq[symbol] -= cut
        excess -= cut
    return freq.astype(np.uint32)


class Model:
    """A frequency table with what coding and decoding look up in it."""

    def __init__(self, freq: np.ndarray, bits: int = SCALE_BITS) -> None:
        self.bits = np.uint64(bits)
        self.mask = np.uint64((1 << bits) - 1)
        self.freq = freq.astype(np.uint64)
        self.first = np.cumsum(self.freq) - self.freq
        self._symbols: np.ndarray | None = None

    @property
    def symbols(self) -> np.ndarray:
        if self._symbols is None:
            self._symbols = np.repeat(
                np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64)
            )
        return self._symbols

    def encode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Final states and words of a block; token i belongs to coder ``i % lanes``."""
        lanes = min(LANES, len(ids))
        states = np.full(lanes, LOW)
        room = np.uint64(63) - self.bits
        words = []
        for start in range((len(ids) - 1) // lanes * lanes, -1, -lanes):
            part = ids[start : start + lanes]
            freq, state = self.freq[part], states[: len(part)]
            over = state >= (freq << room)
            words.append((state[over] & WORD_MASK).astype("<u4"))
            state = np.where(over, state >> WORD_BITS, state)
            share, rest = np.divmod(state, freq)
            states[: len(part)] = (share << self.bits) + rest + self.first[part]
        return states, np.concatenate(words[::-1])

    def decode(self, size: int, states: np.ndarray, words: np.ndarray) -> np.ndarray:
        ids = np.empty(size, np.uint32)
        states, words, used = states.astype(np.uint64), words.astype(np.uint64), 0
        for start in range(0, size, len(states)):
            state = states[: size - start]
            slot = state & self.mask
            part = self.symbols[slot]
            ids[start : start + len(part)] = part
            state = self.freq[part] * (state >> self.bits) + slot - self.first[part]
            under = np.flatnonzero(state < LOW)
            state[under] = (state[under] << WORD_BITS) | words[used : used + len(under)]
            used += len(under)
            states[: len(part)] = state
        if used != len(words) or (states != LOW).any():
            raise ValueError("a block does not end where it was begun")
        return ids


def frame(kind: bytes, body: bytes) -> bytes:
    return struct.pack(_FRAME, kind, len(body), zlib.crc32(body)) + body


def frames(content: memoryview) -> Iterator[tuple[bytes, memoryview]]:
    """Frames of a file, each checked against its CRC-32."""
    at = 0
    while at < len(content):
        kind, size, crc = struct.unpack_from(_FRAME, content, at)
        body = content[at + _FRAME_SIZE : at + _FRAME_SIZE + size]
        if len(body) < size or zlib.crc32(body) != crc:
            raise ValueError(f"a damaged frame at byte {at}")
        yield kind, body
        at += _FRAME_SIZE + size + 1


def block_frame(model: Model, ids: np.ndarray, first: int, doc: int, inside: int) -> bytes:
    """A block with its checkpoint: its first token is number ``inside`` of document ``doc``."""
    states, words = model.encode(ids)
    crc = zlib.crc32(ids.astype("<u4"))
    head = struct.pack(_BLOCK, first, len(ids), len(states), crc, doc, inside)
    return frame(DATA, head + states.astype("<u8").tobytes() + words.tobytes())


def read_block(model: Model, body: memoryview) -> tuple[int, np.ndarray]:
    """Number of the first token in the segment, and the tokens."""
    first, size, lanes, crc, _, _ = struct.unpack_from(_BLOCK, body)
    states = np.frombuffer(body, "<u8", lanes, _BLOCK_SIZE)
    words = np.frombuffer(body, "<u4", offset=_BLOCK_SIZE + 8 * lanes)
    ids = model.decode(size, states, words)
    if zlib.crc32(ids.astype("<u4")) != crc:
        raise ValueError("the ids of a block differ from their checksum")
    return first, ids


class Checkpoint(NamedTuple):
    """Where a reader can begin: byte of the frame, first token, tokens, and document of the first.

    ``doc`` counts the documents of the segment, ``inside`` the tokens of that document before.
    """

    segment: int
    at: int
    first: int
    size: int
    doc: int
    inside: int


def checkpoints(content: memoryview) -> list[Checkpoint]:
    """Checkpoints of a file, from the heads of its frames; no body is read."""
    found, at, segment = [], 0, 0
    while at < len(content):
        kind, size, _ = struct.unpack_from(_FRAME, content, at)
        body = at + _FRAME_SIZE
        if kind == TABLE:
            segment = struct.unpack_from("<Q", content, body)[0]
        elif kind == DATA:
            first, tokens, _, _, doc, inside = struct.unpack_from(_BLOCK, content, body)
            found.append(Checkpoint(segment, at, first, tokens, doc, inside))
        at = body + size + 1
    return found


def table_of(content: memoryview, segment: int) -> Model:
    """The frequency table that the blocks of a segment are coded with."""
    for kind, body in frames(content):
        if kind == TABLE and struct.unpack_from("<Q", body)[0] == segment:
            return Model(np.frombuffer(zlib.decompress(body[8:]), "<u4"))
    raise ValueError(f"no segment {segment}")


def read_from(content: memoryview, model: Model, start: Checkpoint) -> np.ndarray:
    """The tokens of one block, decoded from its checkpoint alone and checked."""
    _, body = next(frames(content[start.at :]))
    return read_block(model, body)[1]


def read_tokens(spark: SparkSession, folder: str, first: int, last: int) -> DataFrame:
    """Tokens ``first`` up to ``last`` of every segment: ``segment, first, doc, inside, ids``.

    Only blocks that hold some of them are decoded, each from its own checkpoint.  A row is a
    block's share: its first token's number, the document it lies in (counted in the segment) and
    its place in that document.  A span beyond a segment gives no row.
    """
    schema = T.StructType([
        *(T.StructField(n, T.LongType()) for n in ("segment", "first", "doc", "inside")),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                data, tables = memoryview(content.as_buffer()), {}
                for start in checkpoints(data):
                    low, high = max(first, start.first), min(last, start.first + start.size)
                    if low >= high:
                        continue
                    if start.segment not in tables:
                        tables = {start.segment: table_of(data, start.segment)}
                    ids = read_from(data, tables[start.segment], start)
                    ids = ids[low - start.first : high - start.first].astype(np.int32)
                    # Where the block's first token is asked for, its checkpoint tells the place.
                    whole = low == start.first
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([start.segment]), pa.array([low]),
                            pa.array([start.doc if whole else None], pa.int64()),
                            pa.array([start.inside if whole else None], pa.int64()),
                            pa.array([ids], pa.list_(pa.int32())),
                        ],
                        names=schema.names,
                    )

    files = spark.read.format("binaryFile").load(folder).select("content")
    return files.mapInArrow(read, schema)


def tokenized(docs: DataFrame, vocabulary: str, end_id: int, kind: str) -> DataFrame:
    """``doc_id, ids``: ids packed as ``kind``, with the end id."""
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType),
        T.StructField("ids", T.BinaryType()),
    ])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(vocabulary)
        ids_of_pieces = piece_encoder(tokenizer, KEPT_PIECES)
        ids_of_words = word_encoder(vocabulary, WORD_PIECES, lower=True)
        for batch in batches_of(batches, BATCH_ROWS, BATCH_BYTES):
            bounds, codes, words = coded_words(texts_of(batch.column(1)))
            # Distinct words are cut in Arrow; Python sees each distinct piece once.
            counts, places, pieces, whole = lowered_pieces(words)
            with collector_off():
                ids = Ragged(ids_of_pieces(pieces) + ids_of_words(whole), np.uint32)
            in_words = np.concatenate([[0], np.cumsum(counts)])
            of_word = Ragged.of(ids.take(places), sums_between(ids.sizes[places], in_words))
            flat = of_word.take(codes)
            ends = np.cumsum(sums_between(of_word.sizes[codes], bounds))
            flat = np.insert(flat, ends, end_id).astype(kind)
            bounds = flat.itemsize * np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])
            packed = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(ends),
                [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(flat)],
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), packed.cast(pa.binary())], names=schema.names
            )

    return docs.mapInArrow(encode, schema)


def token_counts(ids: DataFrame, size: int, kind: str) -> np.ndarray:
    """How often each of ``size`` ids occurs in the corpus; a row per id reaches the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size, np.int64)
        for batch in batches:
            column = batch.column(0).cast(pa.large_binary())
            bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset :]
            flat = np.frombuffer(column.buffers()[2] or b"", np.uint8)
            ids = flat[bounds[0] : bounds[len(column)]].view(kind)
            seen += np.bincount(ids, minlength=size)
        found = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found), pa.array(seen[found])], names=["id", "n"]
        )

    counts = np.zeros(size, np.int64)
    rows = ids.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n"))
    for number, n in rows.collect():
        counts[number] = n
    return counts


def _segment(
    batches: Iterator[pa.RecordBatch], freq: np.ndarray, number: int, kind: str
) -> Iterator[bytes]:
    """Frames of one segment, with a bounded part of it in memory."""
    model = Model(freq)
    held, sizes, first, doc, inside = np.empty(0, np.uint32), [], 0, 0, 0
    begun = False
    for batch in batches:
        if not batch.num_rows:
            continue
        if not begun:
            yield frame(TABLE, struct.pack("<Q", number) + zlib.compress(freq.tobytes()))
            begun = True
        new = [np.frombuffer(x.as_buffer(), kind) for x in batch.column(1)]
        lengths = np.fromiter(map(len, new), np.int64, len(new))
        sink = io.BytesIO()
        table = pa.record_batch([batch.column(0), pa.array(lengths)], names=["doc_id", "size"])
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_batch(table)
        yield frame(DOCS, sink.getvalue())
        sizes.append(lengths)
        held = np.concatenate([held, *new])
        while len(held) >= BLOCK:
            yield block_frame(model, held[:BLOCK], first, doc, inside)
            first, held = first + BLOCK, held[BLOCK:]
            doc, inside, sizes = _advance(sizes, doc, inside)
    if len(held):
        yield block_frame(model, held, first, doc, inside)


def _advance(sizes: list[np.ndarray], doc: int, inside: int):
    """The document and the token inside it one block further on."""
    ahead = np.concatenate(sizes)
    ends = np.cumsum(ahead) - inside
    passed = int(np.searchsorted(ends, BLOCK, side="right"))
    before = int(ends[passed - 1]) if passed else -inside
    return doc + passed, BLOCK - before, [ahead[passed:]]


def write_files(
    docs: DataFrame, path: str, folder: str, end_id: int,
    id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Encode all documents with the tokenizer file at ``path``; write them by ascending id.

    Null ids come first; equal ids are ordered by a hash of their tokens.  Null texts are the end id.
    """
    from tokenizers import Tokenizer

    vocabulary = shared_text(path)
    size = Tokenizer.from_str(vocabulary).get_vocab_size(with_added_tokens=True)
    size = max(size, end_id + 1)
    kind = "<u2" if size <= 1 << 16 else "<u4"
    texts = keyed_text(docs, id_col, text_col)
    ids = stored(tokenized(texts, vocabulary, end_id, kind), "rans-ids")
    counts = token_counts(ids, size, kind)
    freq = scaled(counts)
    segments = max(1, -(-int(counts.sum()) // SEGMENT_TOKENS))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        for data in _segment(batches_of(batches, 65536, BATCH_BYTES), freq, number, kind):
            yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["frame"])

    (
        # Bounds are drawn from ids and hashes; tokens would be much to sample.
        ids.withColumn("tie", F.xxhash64("ids"))
        .repartitionByRange(segments, "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie", "ids")
        .select("doc_id", "ids")
        .mapInArrow(encode, "frame binary")
        # The sink writes the bytes of a string as they are.
        .select(F.col("frame").cast("string").alias("value"))
        .write.text(folder, lineSep="\n")
    )


def read_files(
    spark: SparkSession, folder: str, id_type: T.DataType, with_ids: bool = False
) -> DataFrame:
    """``segment, place, doc_id, n_tokens, ids_crc32`` and, if asked for, ``ids`` (array)."""
    fields = [
        T.StructField("segment", T.LongType()),
        T.StructField("place", T.LongType()),
        T.StructField("doc_id", id_type),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    names = [field.name for field in fields]

    def rows(number: int, docs: list[pa.RecordBatch], blocks: list) -> pa.RecordBatch:
        ids = np.concatenate([part for _, part in sorted(blocks, key=lambda block: block[0])])
        table = pa.Table.from_batches(docs).combine_chunks()
        sizes = table["size"].to_numpy()
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        if bounds[-1] != len(ids):
            raise ValueError("a segment has not the tokens that its documents count")
        packed = memoryview(ids.astype("<u4")).cast("B")
        crc = [zlib.crc32(packed[4 * a : 4 * b]) for a, b in zip(bounds, bounds[1:])]
        columns = [
            pa.array(np.full(len(sizes), number)), pa.array(np.arange(len(sizes))),
            table["doc_id"].combine_chunks(), pa.array(sizes), pa.array(crc, pa.int64()),
        ]
        if with_ids:
            columns.append(
                pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32)))
            )
        return pa.RecordBatch.from_arrays(columns, names=names)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                model, number, docs, blocks = None, 0, [], []
                for kind, body in frames(memoryview(content.as_buffer())):
                    if kind == TABLE:
                        if blocks:
                            yield rows(number, docs, blocks)
                        number = struct.unpack_from("<Q", body)[0]
                        table = zlib.decompress(body[8:])
                        model, docs, blocks = Model(np.frombuffer(table, "<u4")), [], []
                    elif kind == DOCS:
                        docs += pa.ipc.open_stream(bytes(body)).read_all().to_batches()
                    elif kind == DATA:
                        blocks.append(read_block(model, body))
                if blocks:
                    yield rows(number, docs, blocks)

    files = spark.read.format("binaryFile").load(folder).select("content")
    return files.mapInArrow(decode, T.StructType(fields))


def encode_read_back(
    docs: DataFrame, path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
    folder: str | None = None,
) -> DataFrame:
    """Write the files and describe each document from them: ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all documents before it, ``n_tokens`` has the end id in it,
    ``ids_crc32`` is taken of the ids as little-endian 32-bit numbers.  Repeated rows stay
    rows of their own; an empty table gives no row.  Other columns of ``docs`` are left out.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "rans-files")
    write_files(docs, path, folder, end_id, id_col, text_col)
    found = materialize(
        read_files(spark, folder, docs.schema[id_col].dataType), "rans-documents"
    )
    # A row per segment; segments are numbered in the order of the ids.
    order = Window.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        found.groupBy("segment").agg(F.sum("n_tokens").alias("n"))
        .select("segment", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    )
    inside = Window.partitionBy("segment").orderBy("place").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        found.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(before, "segment")
        .select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
    )
