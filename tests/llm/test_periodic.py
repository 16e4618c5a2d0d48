"""Runs of words against a comparison of all words with those a period on."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from starwright.llm import periodic, registry


def plain_runs(words, least=24, periods=3):
    found, n = {}, len(words)
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(least, periods * q) and i > start:
                found.setdefault((start, i - start + q), q)
            i += 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = (None,) * 4
    if runs:
        s, size, q = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        best = s, size, q, 1000 * size // q
    dropped = {i for s, size, q in runs for i in range(s + q, s + size)}
    return (
        doc_id, len(runs), *best,
        hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest(),
        hashlib.sha256(
            " ".join(w for i, w in enumerate(words) if i not in dropped).encode()
        ).hexdigest(),
    )


def sample(rng):
    """Words of few or many kinds, with planted periods, breaks and Fibonacci words."""
    n, kinds, way = rng.choice([0, 1, 23, 24, 25, 60, 300]), rng.choice([1, 2, 3, 50]), rng.random()
    words = [rng.randrange(kinds) for _ in range(n)]
    if way > 0.9 and n:
        short, word = "a", "ab"
        while len(word) < n:
            short, word = word, word + short
        return [ord(letter) for letter in word[:n]]
    if way < 0.5 and n > 3:
        at = rng.randrange(n)
        period = 1 + rng.randrange(max(1, (n - at) // 3))
        words = [words[i] if i < at else words[at + (i - at) % period] for i in range(n)]
        if way < 0.2:
            words[rng.randrange(n)] = 99
    return words


@pytest.mark.parametrize("least, periods", [(24, 3), (3, 3), (10, 4), (40, 3)])
@pytest.mark.parametrize("seed", range(6))
def test_runs_of_a_batch(seed, least, periods, monkeypatch):
    monkeypatch.setattr(periodic, "PROBES", 100)
    rng = random.Random(seed)
    texts = [sample(rng) for _ in range(25)]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    codes = np.array([w for t in texts for w in t], np.int32)
    got = [[] for _ in texts]
    for text, start, length, period in zip(*periodic.find(codes, bounds, least, periods)):
        got[text].append((int(start), int(length), int(period)))
    assert got == [plain_runs(text, least, periods) for text in texts]


@pytest.mark.parametrize("seed", range(4))
def test_extensions_are_exact(seed):
    rng = np.random.default_rng(seed)
    symbols = rng.integers(0, 2 + seed, 400)
    symbols[200:320] = np.resize(symbols[200:211], 120)
    found = periodic.Extensions(symbols)
    i, j = rng.integers(0, 400, (2, 3000))
    i, j = i[i != j], j[i != j]

    def plain_shared(a, b):
        n = 0
        while max(a, b) + n < 400 and symbols[a + n] == symbols[b + n]:
            n += 1
        return n

    assert found.shared(i, j).tolist() == [plain_shared(a, b) for a, b in zip(i, j)]


def test_range_minima():
    values = np.random.default_rng(2).integers(0, 1000, 500)
    low = np.random.default_rng(3).integers(0, 500, 4000)
    high = np.minimum(499, low + np.random.default_rng(4).integers(0, 300, 4000))
    least = periodic.RangeMinimum(values).between(low, high)
    assert least.tolist() == [values[a : b + 1].min() for a, b in zip(low, high)]


def test_a_text_of_one_word_takes_no_square_time():
    found = periodic.find(np.zeros(300_000, np.int32), np.array([0, 300_000]))
    assert [part.tolist() for part in found] == [[0], [0], [300_000], [1]]


def test_two_periods_are_too_few():
    with pytest.raises(ValueError, match="three"):
        periodic.find(np.zeros(9, np.int32), np.array([0, 9]), 2, 2)


def test_query_on_odd_texts(spark, odd, odd_rows, monkeypatch, tmp_path):
    monkeypatch.setattr(periodic, "BATCH_ROWS", 30)
    rows = [
        *(row for row in odd_rows if len(row[1] or "") < 10_000),
        (6, "word " * 3000), (6, " ".join(["a b c"] * 40) + "\x0b tail " + "x\ty " * 30),
        *((1000 + i, " ".join(str(k % (3 + i)) for k in range(100))) for i in range(60)),
        (2000, "  ".join("ab" * 40)), (None, "z " * 30),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = registry.op13_periodic_runs(spark, str(tmp_path)).collect()
    assert Counter(map(tuple, got)) == Counter(plain(*row) for row in rows)


def test_runs_and_texts_without_repetitions(spark):
    text = "start " + "la li " * 30 + "end"
    row = periodic.periodic_runs(
        spark.createDataFrame([(1, text, "own")], "doc_id long, text string, runs string")
    ).first()
    assert [tuple(run) for run in row.runs] == [(1, 60, 2)]
    assert row.collapsed == "start la li end" and row.exponent_milli == 30_000


def test_an_empty_table_has_no_rows(empty):
    assert periodic.periodic_runs(empty).count() == 0


def test_equal_exponents_go_to_the_first():
    assert periodic.strongest([(0, 30, 3), (5, 40, 4), (50, 31, 3)]) == (50, 31, 3)
    assert periodic.strongest([(0, 30, 3), (5, 40, 4)]) == (0, 30, 3)
