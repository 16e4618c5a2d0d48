"""Byte-level BPE over a distinct-word table.

Documents are packed into *chunks* of bounded size.  A chunk keeps its distinct words, dealt
into buckets by their CRC-32, and, per document, the places of its words among them.  The words
of all chunks are shuffled by bucket, so each distinct word is encoded once; its ids go back to
the chunks that hold it, by place.  Common words thus travel once per chunk instead of once per
occurrence.  The chunks are written as a table bucketed by chunk, so they stay where they are
while the ids come to them.  Decoding joins ids with the vocabulary's pieces by id, on the
distinct words of a chunk, and puts the pieces together by place.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starwright.llm.common import (
    keyed_text, partitions, shared_text, stored_by,
)
from starwright.llm.words import (
    BYTE_PIECES, PLAIN, Ragged, batches_of, byte_letters, texts_of, word_encoder,
    words_with_spaces,
)

BATCH_ROWS, BATCH_BYTES = 4096, 16 << 20
CHUNK_WORDS, CHUNK_DISTINCT = 2_400_000, 400_000


def _cut(word: str) -> list[str]:
    """Pre-tokens of a word with the white space before it; unusual words stay whole."""
    return BYTE_PIECES.findall(word) if PLAIN.fullmatch(word) and "<|" not in word else [word]


class _Chunk:
    """Documents gathered so far, as places in a growing list of distinct words."""

    def __init__(self) -> None:
        self.place: dict[str, int] = {}
        self.ids: list[pa.Array] = []
        self.sizes: list[np.ndarray] = []
        self.places: list[np.ndarray] = []
        self.total = 0

    def add(self, ids: pa.Array, texts: pa.Array) -> None:
        place = self.place
        split = words_with_spaces(texts)
        pieces = Ragged(
            [[place.setdefault(p, len(place)) for p in _cut(word)] for word in split.words],
            np.uint32,
        )
        counts = pieces.sizes[split.codes]
        running = np.concatenate([[0], np.cumsum(counts)])
        self.ids.append(ids)
        self.sizes.append(np.diff(running[split.bounds]))
        self.places.append(pieces.take(split.codes))
        self.total += len(self.places[-1])

    def full(self) -> bool:
        return self.total >= CHUNK_WORDS or len(self.place) >= CHUNK_DISTINCT

    def row(self, number: int, buckets: int, schema: pa.Schema) -> pa.RecordBatch:
        """The chunk, with low places for frequent words, and sorted words in each bucket."""
        from zstandard import ZstdCompressor

        words = np.array([*self.place, None], dtype=object)[:-1]
        old = np.concatenate(self.places)
        order = np.argsort(-np.bincount(old, minlength=len(words)), kind="stable")
        rank = np.empty(len(words), np.uint32)
        rank[order] = np.arange(len(words), dtype=np.uint32)
        stream = ZstdCompressor(level=3).compress(_short(rank[old]))
        dealt: dict[int, list[int]] = {}
        for i in sorted(range(len(words)), key=words.__getitem__):
            dealt.setdefault(zlib.crc32(words[i].encode()) % buckets, []).append(i)
        parts = [
            {"bucket": k, **_packed_words(words[own].tolist()), "places": rank[own].tolist()}
            for k, own in dealt.items()
        ]
        ids = pa.concat_arrays(self.ids)
        columns = [
            pa.array([number], pa.int64()),
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            pa.array([np.concatenate(self.sizes)], pa.list_(pa.int64())),
            pa.array([stream], pa.binary()),
            pa.array([parts], schema.field("parts").type),
        ]
        return pa.RecordBatch.from_arrays(columns, schema=schema)


def _short(places: np.ndarray) -> bytes:
    """Two bytes for places below 0xFFFF; the others follow in four bytes each."""
    low = np.minimum(places, 0xFFFF).astype("<u2")
    rest = places[low == 0xFFFF].astype("<u4")
    return len(places).to_bytes(8, "little") + low.tobytes() + rest.tobytes()


def _long(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    places = np.frombuffer(data, "<u2", n, 8).astype(np.int64)
    places[places == 0xFFFF] = np.frombuffer(data, "<u4", offset=8 + 2 * n)
    return places


def chunks_of(docs: DataFrame, buckets: int, label: str) -> DataFrame:
    """``chunk, doc_ids, doc_words, stream, parts``, written once, bucketed by chunk.

    A chunk's number is its task's range plus its turn.  The table is written before anything
    is joined with it, so a repeated task cannot number words in another way.
    """
    schema = T.StructType([
        T.StructField("chunk", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(docs.schema["doc_id"].dataType)),
        T.StructField("doc_words", T.ArrayType(T.LongType())),
        T.StructField("stream", T.BinaryType()),
        T.StructField("parts", T.ArrayType(T.StructType([
            T.StructField("bucket", T.IntegerType()),
            T.StructField("words", T.BinaryType()),
            T.StructField("lengths", T.BinaryType()),
            T.StructField("places", T.ArrayType(T.IntegerType())),
        ]))),
    ])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = pa.struct([
            ("bucket", pa.int32()), ("words", pa.binary()), ("lengths", pa.binary()),
            ("places", pa.list_(pa.int32())),
        ])
        number, chunk = TaskContext.get().partitionId() << 32, _Chunk()
        for batch in batches_of(batches, BATCH_ROWS, BATCH_BYTES):
            fields = pa.schema([
                ("chunk", pa.int64()), ("doc_ids", pa.list_(batch.schema.field(0).type)),
                ("doc_words", pa.list_(pa.int64())), ("stream", pa.binary()),
                ("parts", pa.list_(part)),
            ])
            chunk.add(batch.column(0), texts_of(batch.column(1)))
            if chunk.full():
                yield chunk.row(number, buckets, fields)
                number, chunk = number + 1, _Chunk()
        if chunk.ids:
            yield chunk.row(number, buckets, fields)

    return stored_by(docs.mapInArrow(pack, schema), "chunk", buckets, label)


def encode_distinct(parts: DataFrame, vocabulary: str) -> DataFrame:
    """Ids of every distinct word, for ``chunk, bucket, words, lengths``.

    Gives ``chunk, bucket, sizes, ids``, both packed; ``sizes`` has the number of ids of each
    word, in the words' order.  All words of a bucket come to one task, which keeps the ids of
    that bucket only.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_encoder(vocabulary, BYTE_PIECES, lower=False, most=1)
        known: dict[str, list[int]] = {}
        current = None
        for batch in batches_of(batches, 64, BATCH_BYTES):
            for i, bucket in enumerate(batch.column(1).to_pylist()):
                if bucket != current:
                    known, current = {}, bucket
                words = _unpacked_words(batch.column(2)[i].as_py(), batch.column(3)[i].as_py())
                new = [word for word in words if word not in known]
                known.update(zip(new, coder(new)))
                rows = [known[word] for word in words]
                sizes = np.fromiter(map(len, rows), "<u4", len(rows))
                ids = np.fromiter(chain.from_iterable(rows), "<u4")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, 1), batch.column(1).slice(i, 1),
                        pa.array([_packed(sizes)], pa.binary()),
                        pa.array([_packed(ids)], pa.binary()),
                    ],
                    names=["chunk", "bucket", "sizes", "ids"],
                )

    dealt = parts.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(encode, "chunk long, bucket int, sizes binary, ids binary")


def _packed(numbers: np.ndarray) -> bytes:
    from zstandard import ZstdCompressor

    return ZstdCompressor(level=1).compress(numbers.tobytes())


def _packed_words(words: list[str]) -> dict[str, bytes]:
    """Words end to end, and their lengths: half of what a shuffle of strings would move."""
    from zstandard import ZstdCompressor

    lengths = np.fromiter(map(len, words), "<u4", len(words))
    text = ZstdCompressor(level=3).compress("".join(words).encode())
    return {"words": text, "lengths": _packed(lengths)}


def _unpacked_words(words: bytes, lengths: bytes) -> list[str]:
    from zstandard import ZstdDecompressor

    unpack = ZstdDecompressor()
    text = unpack.decompress(words).decode()
    ends = np.cumsum(np.frombuffer(unpack.decompress(lengths), "<u4")).tolist()
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def _words_by_place(
    buckets: list[int], places: list[np.ndarray], found: pa.Table
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of a chunk's words end to end, and start and size of each word by its place."""
    from zstandard import ZstdDecompressor

    unpack = ZstdDecompressor()

    def column(name: str, row: int) -> np.ndarray:
        return np.frombuffer(unpack.decompress(found[name][row].as_py()), "<u4")

    row_of = {bucket: row for row, bucket in enumerate(found["bucket"].to_pylist())}
    rows = [row_of[bucket] for bucket in buckets]
    none = np.empty(0, np.uint32)
    sizes = np.concatenate([none, *(column("sizes", row) for row in rows)]).astype(np.int64)
    flat = np.concatenate([none, *(column("ids", row) for row in rows)])
    by_place = np.argsort(np.concatenate([none, *places]), kind="stable")
    return flat, (np.cumsum(sizes) - sizes)[by_place], sizes[by_place]


def pieces_of(vocabulary: str) -> list[bytes]:
    """Bytes of each id's piece, by id; as long as the vocabulary."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(vocabulary)
    byte_of = {letter: b for b, letter in enumerate(byte_letters())}
    added = tokenizer.get_added_tokens_decoder()
    pieces = [b""] * tokenizer.get_vocab_size(with_added_tokens=True)
    for token, number in tokenizer.get_vocab(with_added_tokens=True).items():
        plain = number not in added and all(c in byte_of for c in token)
        pieces[number] = bytes(byte_of[c] for c in token) if plain else token.encode()
    return pieces


def encode_decode(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
    with_ids: bool = False, with_text: bool = False,
) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    ``path`` is a byte-level ``tokenizers`` file; ids are those of its library without added
    special tokens, where special strings inside a text count as their tokens.  ``with_ids``
    adds the ids (array of int), ``with_text`` the decoded text.  A null text counts as empty.
    Repeated rows and null ids stay rows of their own; an empty table gives no row; a text
    longer than a chunk is a chunk of its own.  Other columns are left out.
    """
    vocabulary = shared_text(path)
    pieces = pieces_of(vocabulary)
    frame = keyed_text(docs, id_col, text_col)
    buckets = partitions(docs.sparkSession)
    chunks = chunks_of(frame, buckets, "bpe-chunks")
    encoded = encode_distinct(
        chunks.select("chunk", F.explode("parts").alias("part")).select(
            "chunk", "part.bucket", "part.words", "part.lengths"
        ),
        vocabulary,
    )
    fields = [
        T.StructField("doc_id", frame.schema["doc_id"].dataType),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    if with_text:
        fields.append(T.StructField("decoded", T.StringType()))
    schema = T.StructType(fields)

    def assemble(packed: pa.Table, found: pa.Table) -> pa.Table:
        from zstandard import ZstdDecompressor

        buckets = packed["buckets"][0].as_py()
        places = [x.values.to_numpy() for x in packed["places"][0]]
        flat, starts, counts = _words_by_place(buckets, places, found)
        listed, starts, ends = flat.tolist(), starts.tolist(), (starts + counts).tolist()
        numbers = [",".join(map(str, listed[a:b])) for a, b in zip(starts, ends)]
        # The join of ids with pieces, once per distinct word.
        spelled = [b"".join([pieces[i] for i in listed[a:b]]) for a, b in zip(starts, ends)]
        doc_ids = packed["doc_ids"].combine_chunks().values
        sizes = packed["doc_words"][0].values.to_numpy()
        stream = _long(ZstdDecompressor().decompress(packed["stream"][0].as_py()))
        at, rows = 0, []
        for size in sizes.tolist():
            mine = stream[at : at + size]
            own = mine.tolist()
            text = b"".join([spelled[i] for i in own]).decode("utf-8", "replace")
            row = [
                int(counts[mine].sum()),
                hashlib.sha256(",".join([numbers[i] for i in own]).encode()).hexdigest(),
                hashlib.sha256(text.encode()).hexdigest(),
            ]
            if with_ids:
                row.append([n for i in own for n in listed[starts[i] : ends[i]]])
            if with_text:
                row.append(text)
            rows.append(row)
            at += size
        kinds = [pa.int64(), pa.string(), pa.string()]
        kinds += [pa.list_(pa.int32())] * with_ids + [pa.string()] * with_text
        columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
        return pa.table([doc_ids, *columns], names=schema.names)

    return (
        chunks.select(
            "chunk", "doc_ids", "doc_words", "stream",
            F.col("parts.bucket").alias("buckets"), F.col("parts.places").alias("places"),
        )
        .groupBy("chunk")
        .cogroup(encoded.groupBy("chunk"))
        .applyInArrow(assemble, schema)
    )
