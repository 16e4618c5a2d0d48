"""Runs of words: stretches that repeat with a period, found through difference-cover extensions.

The texts of a batch are one sequence of numbers, in which no two texts share a number, so no
common extension leaves its text.  Only suffixes at places of a difference cover are sorted
(three of seven places); any two places reach sampled ones after the same few words, which are
compared one by one, and a range minimum over the common prefixes of sorted neighbours gives the
rest.  The same over the reversed sequence gives extensions to the left.

A run of period q has at least ``length - q`` consecutive places that equal the place q further
on.  So probes on a grid of that width, for every q, meet every run: about ``n log n`` probes for
n words.  Texts in which no sampled block of words occurs twice have no run and are not probed.

Texts are read in place, without a shuffle; a task holds one batch, or one text if that is longer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from starwright.llm.common import keyed_text
from starwright.llm.words import batches_of, coded_words, texts_of

LEAST_WORDS, LEAST_PERIODS = 24, 3
BATCH_ROWS, BATCH_BYTES = 4000, 6 << 20
PROBES = 1 << 20

#: Any difference modulo seven is one of two of these places.
COVER = 7
PLACES = np.array([0, 1, 3])
_SAMPLE = np.full(COVER, -1)
_SAMPLE[PLACES] = np.arange(len(PLACES))
#: Words after which two places, by their remainders, are both sampled.
_AHEAD = np.array([
    [min(d for d in range(COVER) if _SAMPLE[(i + d) % COVER] >= 0 <= _SAMPLE[(j + d) % COVER])
     for j in range(COVER)]
    for i in range(COVER)
])


class RangeMinimum:
    """Least value between two places: a sparse table over blocks, running minima inside them."""

    WIDTH = 16

    def __init__(self, values: np.ndarray) -> None:
        blocks = len(values) // self.WIDTH + 1
        most = np.iinfo(np.int32).max
        self.values = np.full(blocks * self.WIDTH, most, np.int32)
        self.values[: len(values)] = values
        grid = self.values.reshape(blocks, self.WIDTH)
        self.up_to = np.minimum.accumulate(grid, axis=1).ravel()
        self.onward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        self.tables = [grid.min(axis=1)]
        while 1 << len(self.tables) <= blocks:
            last, half = self.tables[-1], 1 << len(self.tables) - 1
            self.tables.append(np.minimum(last[:-half], last[half:]))

    def between(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minimum of ``values[low : high + 1]``, for arrays of places."""
        first, last = low // self.WIDTH, high // self.WIDTH
        found = np.minimum(self.onward[low], self.up_to[high])
        inside = np.flatnonzero(first == last)
        if len(inside):
            at, end = low[inside], high[inside]
            least = self.values[at]
            for step in range(1, self.WIDTH):
                least = np.minimum(least, self.values[np.minimum(at + step, end)])
            found[inside] = least
        wide = np.flatnonzero(last - first > 1)
        if len(wide):
            begin, end = first[wide] + 1, last[wide]
            power = np.frexp((end - begin).astype(np.float64))[1] - 1
            for k in np.unique(power):
                some = power == k
                table, at = self.tables[k], wide[some]
                part = np.minimum(table[begin[some]], table[end[some] - (1 << int(k))])
                found[at] = np.minimum(found[at], part)
        return found


class Extensions:
    """Common extensions to the right of places of a sequence of numbers."""

    def __init__(self, symbols: np.ndarray) -> None:
        size, top = len(symbols), int(symbols.max(initial=0)) + 1
        blocks = size // COVER + 1
        # The padding holds numbers that occur once.
        self.symbols = np.concatenate([symbols, top + np.arange((blocks + 1) * COVER - size)])
        self.count = blocks * len(PLACES)
        self.at = (np.arange(blocks)[:, None] * COVER + PLACES).ravel()
        self._sort()
        self.least = RangeMinimum(self._neighbours())

    def _sort(self) -> None:
        """Order of the sampled suffixes, and their ranks by 7, 14, 28 … words."""
        bits = int(self.symbols.max()).bit_length()
        chunk = max(1, 63 // bits)
        self.order = np.arange(self.count)
        self.rank = np.zeros(self.count, np.int32)
        open_slots = np.arange(self.count)
        for first in range(0, COVER, chunk):
            key = np.zeros(len(open_slots), np.int64)
            places = self.at[self.order[open_slots]]
            for step in range(first, min(first + chunk, COVER)):
                key = key << bits | self.symbols[places + step]
            open_slots = self._refine(open_slots, key)
        self.levels = [self.rank.copy()]
        shift = len(PLACES)
        while len(open_slots):
            ahead = self.order[open_slots] + shift
            past = ahead >= self.count
            key = self.levels[-1][np.where(past, 0, ahead)].astype(np.int64)
            # Suffixes that end are told apart by the padding before.
            key[past] = -1
            open_slots = self._refine(open_slots, key)
            self.levels.append(self.rank.copy())
            shift *= 2

    def _refine(self, slots: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Sort groups of equal suffixes by a key; gives the slots of groups that are left."""
        samples = self.order[slots]
        group = self.rank[samples]
        by_key = np.lexsort((key, group)) if group.any() else np.argsort(key, kind="stable")
        samples, group, key = samples[by_key], group[by_key], key[by_key]
        self.order[slots] = samples
        new = np.ones(len(slots), bool)
        new[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
        self.rank[samples] = np.maximum.accumulate(np.where(new, slots, 0))
        alone = new.copy()
        alone[:-1] &= new[1:]
        return slots[~alone]

    def _neighbours(self) -> np.ndarray:
        """Words that each sorted suffix shares with the one before it."""
        left, right = self.order[:-1].copy(), self.order[1:].copy()
        shared = np.zeros(len(left), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            rank, step = self.levels[level], len(PLACES) << level
            inside = np.maximum(left, right) < self.count
            same = inside & (
                rank[np.where(inside, left, 0)] == rank[np.where(inside, right, 0)]
            )
            left, right = left + same * step, right + same * step
            shared += same * (COVER << level)
        self.levels = []
        end = self.count - 1
        left, right = self.at[np.minimum(left, end)], self.at[np.minimum(right, end)]
        alive = np.ones(len(left), bool)
        for step in range(COVER - 1):
            alive &= self.symbols[left + step] == self.symbols[right + step]
            shared += alive
        # Place k is the minimum's place for suffixes k - 1 and k.
        return np.concatenate([[0], shared])

    def shared(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that follow alike from places ``i`` and ``j``, which differ."""
        ahead = _AHEAD[i % COVER, j % COVER]
        found = np.zeros(len(i), np.int64)
        alive = np.ones(len(i), bool)
        for step in range(COVER - 1):
            asked = alive & (step < ahead)
            if not asked.any():
                break
            same = self.symbols[i + step] == self.symbols[j + step]
            alive &= same | ~asked
            found += asked & same
        left = np.flatnonzero(alive)
        if len(left):
            i, j = i[left] + ahead[left], j[left] + ahead[left]
            a = self.rank[i // COVER * len(PLACES) + _SAMPLE[i % COVER]]
            b = self.rank[j // COVER * len(PLACES) + _SAMPLE[j % COVER]]
            found[left] += self.least.between(np.minimum(a, b) + 1, np.maximum(a, b))
        return found


class Runs(NamedTuple):
    """One entry per run: its text, first word, number of words and period."""

    text: np.ndarray
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def may_repeat(codes: np.ndarray, bounds: np.ndarray, words: int) -> np.ndarray:
    """Texts in which a sampled block of so many words may occur twice; no other one has a run.

    Blocks are compared by a hash, so a chance collision costs time and no result.
    """
    sizes = np.diff(bounds)
    at = (np.arange(len(codes) // COVER + 1)[:, None] * COVER + PLACES).ravel()
    at = at[at + words <= len(codes)]
    text = np.searchsorted(bounds, at, side="right") - 1
    inside = at + words <= bounds[text + 1]
    at, text = at[inside], text[inside].astype(np.uint64)
    key = text.copy()
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    for step in range(words):
        key = key * np.uint64(0xD6E8FEB86659FD93) + mixed[at + step]
    key ^= key >> np.uint64(32)
    # The low bits name the text, so that sorted keys need no second array.
    bits = np.uint64(max(1, len(sizes)).bit_length())
    key = np.sort(key << bits | text)
    twice = key[1:][key[1:] == key[:-1]] & ((np.uint64(1) << bits) - np.uint64(1))
    found = np.zeros(len(sizes), bool)
    found[twice.astype(np.int64)] = True
    return found


def find(
    codes: np.ndarray, bounds: np.ndarray, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS
) -> Runs:
    """All runs of texts ``codes[bounds[i]:bounds[i + 1]]``, by text, start and period.

    A run has smallest period q and at least ``max(least, periods * q)`` words, and neither
    neighbour continues it.  ``periods`` is three or more: then the smallest period of a stretch
    divides all that were probed, and is itself among them.
    """
    if periods < 3:
        raise ValueError("runs of fewer than three periods are not told apart")
    none = np.zeros(0, np.int64)
    # The narrowest zone of places that equal the place q further on, over all q.
    every = np.arange(1, least + 1)
    narrow = int((np.maximum(least, periods * every) - every).min())
    kept = np.diff(bounds) >= least
    if narrow >= 2 * COVER:
        kept &= may_repeat(codes, bounds, narrow - COVER + 1)
    texts = np.flatnonzero(kept)
    if not len(texts):
        return Runs(none, none, none, none)
    sizes = np.diff(bounds)[texts]
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(texts)), sizes)
    flat = codes[np.arange(len(owner)) - np.repeat(starts - bounds[texts], sizes)]
    # Numbers that no two texts share.
    symbols = np.unique(owner * (int(flat.max()) + 1) + flat, return_inverse=True)[1]
    onward, back = Extensions(symbols), Extensions(symbols[::-1])
    found = [
        _zones(symbols, onward, back, i, q, zone)
        for i, q, zone in _probes(symbols, starts, sizes, least, periods)
    ]
    start, length, period = (np.concatenate(part) for part in zip(*found))
    # Of one stretch the smallest period counts; the others are its multiples.
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[first], length[first], period[first]
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    text = owner[start]
    return Runs(texts[text], start - starts[text], length, period)


def _probes(
    symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray, least: int, periods: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places on the grid of each period that equal the place a period on, some at a time."""
    most = sizes // periods
    text = np.repeat(np.arange(len(sizes)), most)
    period = np.arange(len(text)) - np.repeat(np.cumsum(most) - most, most) + 1
    zone = np.maximum(least, periods * period) - period
    count = (sizes[text] - period - 1) // zone + 1
    ends = np.cumsum(count)
    first = 0
    while first < len(text):
        before = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + PROBES, side="right")))
        n = count[first:last]
        of = np.repeat(np.arange(first, last), n)
        step = np.arange(int(n.sum())) - np.repeat(ends[first:last] - n - before, n)
        i, q = starts[text[of]] + step * zone[of], period[of]
        same = np.flatnonzero(symbols[i] == symbols[i + q])
        yield i[same], q[same], zone[of[same]]
        first = last


def _zones(
    symbols: np.ndarray, onward: Extensions, back: Extensions,
    i: np.ndarray, q: np.ndarray, zone: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of the stretches that probes lie in, if long enough."""
    right = onward.shared(i, i + q)
    end = len(symbols) - 1
    # Reversed, the word at i is at end - i; both probed words are alike, so it counts itself.
    left = back.shared(end - i, end - i - q) - 1
    wide = np.flatnonzero(left + right >= zone)
    start, length, q = (i - left)[wide], (left + right + q)[wide], q[wide]
    # Several probes meet one stretch.
    order = np.lexsort((q, start))
    start, length, q = start[order], length[order], q[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (q[1:] != q[:-1])
    return start[new], length[new], q[new]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The run with the greatest length over period; of equal ones the first, then shortest period."""
    best = runs[0]
    for run in runs[1:]:
        if run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


Rewrite = Callable[[object, int], tuple[int, int] | None]


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    rewrite: Rewrite | None = None, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS,
) -> DataFrame:
    """Runs of the words of every whole text, and the texts without their repetitions.

    One row per document: ``doc_id, n_runs``, ``start, length, period, exponent_milli`` of the
    strongest run (null without one), ``runs`` (by start, then period) and ``collapsed``, the
    words that are not in a run after its first period, joined by a space.  Words are what
    stands between ASCII white space.

    ``rewrite`` gives, for an id and its number of words, a place and a period from which on
    the words are to repeat, or None; it is not asked for texts without words.  A null or empty
    text has no word and no run; repeated rows and null ids stay rows of their own; an empty
    table gives no row; a very long text is a batch of its own, searched whole.  Other columns
    of ``docs`` are left out.
    """
    frame = keyed_text(docs, id_col, text_col)
    number = T.LongType()
    run = T.StructType([T.StructField(n, number) for n in ("start", "length", "period")])
    schema = T.StructType([
        T.StructField("doc_id", frame.schema["doc_id"].dataType),
        T.StructField("n_runs", number),
        *(T.StructField(n, number) for n in ("start", "length", "period", "exponent_milli")),
        T.StructField("runs", T.ArrayType(run)),
        T.StructField("collapsed", T.StringType()),
    ])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, BATCH_ROWS, BATCH_BYTES):
            bounds, codes, words = coded_words(texts_of(batch.column(1)))
            bounds, codes = _without_empty(bounds, codes, words)
            if rewrite is not None:
                ids = batch.column(0).to_pylist()
                for i in np.flatnonzero(np.diff(bounds)):
                    n = int(bounds[i + 1] - bounds[i])
                    if (change := rewrite(ids[i], n)) is not None:
                        at, period = change
                        part = codes[bounds[i] + at : bounds[i + 1]]
                        part[:] = part[np.arange(len(part)) % period]
            found = find(codes, bounds, least, periods)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), *_described(found, batch.num_rows),
                    _collapsed(found, codes, bounds, words),
                ],
                names=schema.names,
            )

    return frame.mapInArrow(search, schema)


def _without_empty(
    bounds: np.ndarray, codes: np.ndarray, words: pa.Array
) -> tuple[np.ndarray, np.ndarray]:
    """Bounds and codes without the empty words that runs of white space leave."""
    empty = pc.index(words, pa.scalar("", words.type)).as_py()
    if empty < 0:
        return bounds, codes.copy()
    real = codes != empty
    before = np.concatenate([[0], np.cumsum(real)])
    return before[bounds], codes[real]


def _described(found: Runs, rows: int) -> list[pa.Array]:
    """Number of runs, the strongest one and the list of all, per text."""
    counts = np.bincount(found.text, minlength=rows)
    ends = np.cumsum(counts)
    best = np.zeros((rows, 4), np.int64)
    none = counts == 0
    for i in np.flatnonzero(counts):
        span = slice(ends[i] - counts[i], ends[i])
        start, length, period = strongest(list(zip(
            found.start[span].tolist(), found.length[span].tolist(), found.period[span].tolist()
        )))
        best[i] = start, length, period, 1000 * length // period
    lists = pa.StructArray.from_arrays(
        [pa.array(x, pa.int64()) for x in found[1:]], names=["start", "length", "period"]
    )
    offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
    return [
        pa.array(counts, pa.int64()),
        *(pa.array(best[:, k], pa.int64(), mask=none) for k in range(4)),
        pa.ListArray.from_arrays(offsets, lists),
    ]


def _collapsed(
    found: Runs, codes: np.ndarray, bounds: np.ndarray, words: pa.Array
) -> pa.Array:
    """The words that stay, joined by a space."""
    change = np.zeros(len(codes) + 1, np.int64)
    at = bounds[found.text] + found.start
    np.add.at(change, at + found.period, 1)
    np.add.at(change, at + found.length, -1)
    stays = np.cumsum(change[:-1]) == 0
    kept = np.concatenate([[0], np.cumsum(stays)])[bounds]
    parts = words.take(pa.array(codes[stays]))
    lists = pa.LargeListArray.from_arrays(pa.array(kept, pa.int64()), parts)
    return pc.binary_join(lists, pa.scalar(" ", parts.type)).cast(pa.string())
