"""Token counts, BPE round trips and token files against the tokenizers library."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from starwright.llm import bpe, rans, token_counts, words
from starwright.llm.common import shared_text

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def word_tokenizer():
    return Tokenizer.from_file(WORD)


@pytest.fixture(scope="module")
def byte_tokenizer():
    return Tokenizer.from_file(BYTE)


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_words_joined_are_the_text(odd_rows):
    import pyarrow as pa

    texts = [text for _, text in odd_rows]
    split = words.words_with_spaces(words.texts_of(pa.array(texts)))
    for i, text in enumerate(texts):
        codes = split.codes[split.bounds[i] : split.bounds[i + 1]]
        assert "".join(split.words[c] for c in codes) == (text or "")


def test_whole_tokens_are_single_tokens(word_tokenizer):
    whole = token_counts.whole_tokens(shared_text(WORD))
    assert 10_000 < len(whole) <= word_tokenizer.get_vocab_size()
    assert "the" in whole and "thethe" not in whole


def test_counts_equal_the_library(odd, odd_rows, word_tokenizer):
    got = Counter(map(tuple, token_counts.count_tokens(odd, WORD, over=100).collect()))
    sizes = [len(ids_of(word_tokenizer, text)) for _, text in odd_rows]
    assert got == Counter(
        (i, len((text or "").encode()), n, n > 100) for (i, text), n in zip(odd_rows, sizes)
    )


def test_counts_of_an_empty_table(empty):
    found = token_counts.count_tokens(empty, WORD)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert found.count() == 0


def described(tokenizer, text):
    ids = ids_of(tokenizer, text)
    decoded = tokenizer.decode(ids, skip_special_tokens=False)
    listed = ",".join(map(str, ids))
    return (
        len(ids), hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(decoded.encode()).hexdigest(),
    )


@pytest.mark.parametrize("chunk", [1, 500, 10**9])
def test_bpe_equals_the_library(odd, odd_rows, byte_tokenizer, monkeypatch, chunk):
    monkeypatch.setattr(bpe, "CHUNK_WORDS", chunk)
    monkeypatch.setattr(bpe, "BATCH_ROWS", 50)
    got = Counter(map(tuple, bpe.encode_decode(odd, BYTE).collect()))
    assert got == Counter((i, *described(byte_tokenizer, text)) for i, text in odd_rows)


def test_bpe_returns_ids_and_text(odd, odd_rows, byte_tokenizer):
    rows = bpe.encode_decode(odd, BYTE, with_ids=True, with_text=True).collect()
    got = Counter((row.doc_id, tuple(row.ids), row.decoded) for row in rows)
    assert got == Counter(
        (i, tuple(ids_of(byte_tokenizer, text)), text or "") for i, text in odd_rows
    )


@pytest.mark.parametrize("limit", ["32m", "2000000b", "1g"])
def test_the_session_keeps_its_arrow_setting(spark, conf, odd, odd_rows, limit):
    """Frames built before others run as if alone, whatever is set; no table stays behind."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    conf(name, limit)
    tables = [t.name for t in spark.catalog.listTables()]
    encoded = bpe.encode_decode(odd, BYTE)
    counted = token_counts.count_tokens(odd, WORD)
    assert counted.count() == encoded.count() == len(odd_rows)
    assert spark.conf.get(name) == limit
    assert [t.name for t in spark.catalog.listTables()] == tables


def test_bpe_of_an_empty_table(empty):
    assert bpe.encode_decode(empty, BYTE).count() == 0


def test_bpe_of_texts_without_words(spark):
    docs = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")
    assert [row.n_tokens for row in bpe.encode_decode(docs, BYTE).collect()] == [0, 0]


def test_chunks_are_not_shuffled(odd):
    plan = bpe.encode_decode(odd, BYTE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2, plan


@pytest.mark.parametrize("size", [1, 5, 4095, 4096, 4097, 70_000])
def test_blocks_decode_to_what_was_coded(size):
    rng = np.random.default_rng(size)
    ids = (rng.zipf(1.2, size) % 40_000).astype(np.uint32)
    model = rans.Model(rans.scaled(np.bincount(ids, minlength=49_408)))
    body = rans.block_frame(model, ids, 9, 0, 0)[rans._FRAME_SIZE :]
    first, found = rans.read_block(model, memoryview(body))
    assert first == 9 and (found == ids).all()


def test_a_single_symbol_and_the_rarest_keep_a_share():
    assert rans.scaled(np.array([0, 7, 0])).tolist() == [0, 1 << rans.SCALE_BITS, 0]
    counts = np.concatenate([np.ones(60_000, np.int64), [10**12]])
    freq = rans.scaled(counts)
    assert freq.sum() == 1 << rans.SCALE_BITS and freq.min() == 1


def test_a_damaged_frame_is_refused():
    data = bytearray(rans.frame(rans.DOCS, b"some documents") + b"\n")
    assert [bytes(body) for _, body in rans.frames(memoryview(bytes(data)))] == [b"some documents"]
    data[-3] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        list(rans.frames(memoryview(bytes(data))))


@pytest.mark.parametrize("segment", [2_000, 10**9])
def test_files_hold_all_documents_in_order(odd, odd_rows, word_tokenizer, monkeypatch, segment):
    monkeypatch.setattr(rans, "SEGMENT_TOKENS", segment)
    monkeypatch.setattr(rans, "BLOCK", 1000)
    got = sorted(map(tuple, rans.encode_read_back(odd, WORD).collect()), key=lambda row: row[1])
    packed = [
        (i is not None, i or 0, np.array([*ids_of(word_tokenizer, text), 2], "<u2").tobytes(), i)
        for i, text in odd_rows
    ]
    want, start = [], 0
    for _, _, data, i in sorted(packed, key=lambda row: row[:3]):
        ids = np.frombuffer(data, "<u2").astype("<u4")
        want.append((i, start, len(ids), zlib.crc32(ids)))
        start += len(ids)
    assert got == want


def test_files_give_the_ids(spark, word_tokenizer, tmp_path):
    docs = spark.createDataFrame([(2, "second one"), (1, "first")], "doc_id long, text string")
    rans.write_files(docs, WORD, str(tmp_path / "files"), end_id=2)
    rows = rans.read_files(spark, str(tmp_path / "files"), docs.schema["doc_id"].dataType, True)
    got = {row.doc_id: row.ids for row in rows.collect()}
    assert got == {
        1: [*ids_of(word_tokenizer, "first"), 2], 2: [*ids_of(word_tokenizer, "second one"), 2],
    }


def test_a_middle_block_is_read_from_its_checkpoint(
    spark, odd, odd_rows, word_tokenizer, monkeypatch, tmp_path
):
    monkeypatch.setattr(rans, "BLOCK", 1000)
    monkeypatch.setattr(rans, "SEGMENT_TOKENS", 10**9)
    folder = str(tmp_path / "files")
    rans.write_files(odd, WORD, folder, end_id=2)
    rows = rans.read_files(spark, folder, odd.schema["doc_id"].dataType, True)
    docs = [row.ids for row in sorted(rows.collect(), key=lambda row: row.place)]
    every = np.concatenate(docs)
    starts = np.concatenate([[0], np.cumsum([len(ids) for ids in docs])])
    (path,) = [p for p in (tmp_path / "files").iterdir() if p.suffix == ".txt"]
    content = memoryview(path.read_bytes())
    points = rans.checkpoints(content)
    assert [p.first for p in points] == list(range(0, len(every), 1000)) and len(points) > 20
    model = rans.table_of(content, 0)
    for point in (points[0], points[len(points) // 2], points[-1]):
        ids = rans.read_from(content, model, point)
        assert (ids == every[point.first : point.first + point.size]).all()
        assert starts[point.doc] + point.inside == point.first
    # Other blocks may be damaged.
    damaged = bytearray(content)
    damaged[points[3].at + 60] ^= 1
    assert len(rans.read_from(memoryview(bytes(damaged)), model, points[4])) == 1000
    with pytest.raises(ValueError, match="damaged"):
        rans.read_from(memoryview(bytes(damaged)), model, points[3])
    parts = sorted(map(tuple, rans.read_tokens(spark, folder, 1500, 3200).collect()))
    assert [part[1:4] for part in parts][1:] == [
        (p.first, p.doc, p.inside) for p in points[2:4]
    ]
    assert np.concatenate([part[4] for part in parts]).tolist() == every[1500:3200].tolist()
    assert rans.read_tokens(spark, folder, len(every), len(every) + 9).count() == 0


def test_files_of_an_empty_table(empty):
    assert rans.encode_read_back(empty, WORD).count() == 0
