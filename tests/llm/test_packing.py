"""Best-fit packing against the rule applied piece by piece, and ids against the library."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from starwright.llm import packing
from starwright.llm.packing import RULES, Limits, Rule

BYTE = public_tokenizers.path("byte_bpe_50k.json")


def one_by_one(counts, limits, rule):
    """Where every piece goes, as a bag of (length, sequence, offset), and the sequences."""
    whole = limits.vector
    room, placed = [], Counter()
    for length in sorted(counts, reverse=True):
        demand = np.array([length, 1, length * length])
        for _ in range(counts[length]):
            best = None
            for i, residual in enumerate(room):
                if (residual >= demand).all():
                    score = rule.score(residual[None], demand, whole)[0]
                    if best is None or score < best[0]:
                        best = score, i
            if best is None:
                room.append(whole.copy())
            i = len(room) - 1 if best is None else best[1]
            placed[length, i, int(whole[0] - room[i][0])] += 1
            room[i] = room[i] - demand
    return placed, len(room)


def spelled_out(found, counts):
    placed = Counter()
    for length, n in counts.items():
        rows = [row for row in found.rows.tolist() if row[0] == length]
        ends = [row[1] for row in rows[1:]] + [n]
        for (_, first, per, base, offset), end in zip(rows, ends):
            for turn in range(end - first):
                placed[length, base + turn // per, offset + turn % per * length] += 1
    return placed


@pytest.mark.parametrize("rule", RULES, ids=str)
@pytest.mark.parametrize("seed", range(8))
def test_groups_give_what_single_pieces_give(rule, seed):
    rng = random.Random(seed)
    cap = rng.choice([8, 20, 64])
    limits = rng.choice([
        Limits(cap), Limits(cap, documents=3),
        Limits(cap, documents=rng.randint(1, 9), attention=cap * cap + 5),
    ])
    counts = Counter(rng.randint(1, cap) for _ in range(rng.randint(0, 150)))
    found = packing.plan(counts, limits, rule)
    placed, used = one_by_one(counts, limits, rule)
    assert spelled_out(found, counts) == placed and found.sequences == used


def test_limits_and_rules_are_checked():
    with pytest.raises(ValueError, match="capacity"):
        Limits(10, attention=99).vector
    with pytest.raises(ValueError, match="capacity"):
        Limits(10, documents=0).vector
    with pytest.raises(ValueError, match="rule"):
        packing.plan({1: 1, 2: 1}, Limits(10), Rule("other"))


@pytest.mark.parametrize("limits", [Limits(64), Limits(64, documents=2), Limits(64, 5, 5000)])
def test_every_piece_has_its_place(odd, odd_rows, limits, monkeypatch):
    monkeypatch.setattr(packing, "BATCH_ROWS", 40)
    tokenizer = Tokenizer.from_file(BYTE)
    rows = packing.pack(odd, BYTE, limits=limits, with_ids=True).collect()
    want = Counter()
    for doc_id, text in odd_rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        count = -(-len(ids) // limits.tokens)
        ends = [len(ids) - k * limits.tokens for k in range(count - 1, -1, -1)]
        for piece, (a, b) in enumerate(zip([0, *ends], ends)):
            crc = zlib.crc32(np.array(ids[a:b], "<u4").tobytes())
            want[doc_id, piece, a, b - a, crc, tuple(ids[a:b])] += 1
    got = Counter(
        (r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in rows
    )
    assert got == want
    sequences = {}
    for row in rows:
        sequences.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        demand = np.array([[n, 1, n * n] for _, n in members]).sum(axis=0)
        assert (demand <= limits.vector).all()


def test_few_sequences(spark):
    """Near the least number that the tokens need."""
    rng = random.Random(5)
    counts = Counter(min(1024, int(rng.lognormvariate(5, 1)) + 1) for _ in range(20_000))
    total = sum(length * n for length, n in counts.items())
    found = packing.best_plan(counts, Limits(1024))
    assert found.sequences <= -(-total // 1024) * 1.005


def test_one_length_for_all(spark):
    docs = spark.range(5000).selectExpr("id doc_id", "'one two' text").repartition(7)
    rows = packing.pack(docs, BYTE, limits=Limits(30)).collect()
    assert Counter(Counter(r.sequence_id for r in rows).values()) == {10: 500}
    assert Counter(r.offset for r in rows) == {k: 500 for k in range(0, 30, 3)}


def test_an_empty_table_has_no_pieces(empty):
    found = packing.pack(empty, BYTE)
    assert found.columns == [
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    ]
    assert found.count() == 0


def test_pieces_cut_in_arrow_are_those_of_the_library(odd_rows):
    import pyarrow as pa

    from starwright.llm import words

    tokenizer = Tokenizer.from_file(BYTE)
    texts = [text or "" for _, text in odd_rows if len(text or "") < 10_000] + [
        "\nWas it\n\nhere, ", "  two  blanks", " \xb5m, x\xb2 caf\xe9. na\xefve; 3rd no. 7!", "\x1c a\x85b",
        "it's 'quoted' <b> a_b --", "ɐipa ǅx", "á e", "(see)", ", ,", "\n ,x", "\n x",
    ]
    split = words.words_with_spaces(words.texts_of(pa.array(texts)))
    counts, places, pieces, whole = words.spaced_pieces(pa.array(split.words, pa.large_string()))
    ids = words.spaced_piece_encoder(tokenizer, 10)(pieces)
    ids += words.word_encoder(tokenizer.to_str(), words.BYTE_PIECES, lower=False)(whole)
    ends = np.cumsum(counts)
    for word, start, end in zip(split.words, ends - counts, ends):
        got = [i for place in places[start:end] for i in ids[place]]
        assert got == tokenizer.encode(word, add_special_tokens=False).ids, word
