"""Splitting texts into words that a tokenizer may encode one by one.

A batch of texts becomes a dictionary of its distinct words and a code per occurrence; both
steps run in Arrow, so Python sees each distinct word of a batch once.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The white space of the tokenizers' patterns.
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# Characters for which the `re` classes below mean what the tokenizers' patterns mean.
PLAIN = re.compile("[\x00-\x1b -\x84\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f\u2010-\u2027]*")
BYTE_PIECES = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
)
WORD_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")

# Words that Arrow may cut: plain ones, without contractions, added tokens and the one letter
# that Arrow lowers to another text than the tokenizers do.
_CUTTABLE = "^[\x01-\x1b -&(-;=-\x84\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\u012f\u0131-\u024f\u2010-\u2027]*$"
_RUNS = r"(\p{L}+|\p{N}|[^\p{L}\p{N}]+)"

_RUN = f"[{SPACES}][{SPACES}]"
_SPACED = re.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")
_MARK = "\x1f"


class Split(NamedTuple):
    """``codes[bounds[i]:bounds[i + 1]]`` are the words of text i, as places in ``words``."""

    bounds: np.ndarray
    codes: np.ndarray
    words: list[str]


def texts_of(column: pa.Array) -> pa.Array:
    """A column of texts with the empty text for null."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def _coded(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Bounds, codes and distinct values of lists."""
    bounds = np.asarray(lists.offsets, dtype=np.int64)
    values = lists.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
    return bounds - bounds[0], np.asarray(values.indices, dtype=np.int32), values.dictionary


def coded_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words between ASCII white space, as in ``Split``, but with the words still in Arrow."""
    return _coded(pc.ascii_split_whitespace(texts))


def words_between_spaces(texts: pa.Array) -> Split:
    """Words between ASCII white space; runs of it leave empty words, which mean nothing."""
    bounds, codes, words = coded_words(texts)
    return Split(bounds, codes, words.to_pylist())


def words_with_spaces(texts: pa.Array) -> Split:
    """Words together with the white space before them; joined, they are the text again.

    Where no text has two white-space characters in a row, a mark before each blank or line
    feed and one split in Arrow do it.  Other texts are cut by a pattern.
    """
    simple = pc.invert(pc.match_substring_regex(texts, f"{_RUN}|{_MARK}"))
    marked = pc.replace_substring(
        pc.replace_substring(pc.if_else(simple, texts, ""), " ", f"{_MARK} "), "\n", f"{_MARK}\n"
    )
    bounds, codes, words = _coded(pc.split_pattern(marked, _MARK))
    fast = Split(bounds, codes, words.to_pylist())
    rest = np.flatnonzero(~np.asarray(simple, dtype=bool))
    if not len(rest):
        return fast
    place = {word: i for i, word in enumerate(fast.words)}
    parts = np.split(fast.codes, fast.bounds[1:-1])
    for i in rest:
        found = _SPACED.findall(texts[i].as_py())
        parts[i] = np.fromiter(
            (place.setdefault(word, len(place)) for word in found), np.int32, len(found)
        )
    bounds = np.concatenate([[0], np.cumsum([len(part) for part in parts])])
    return Split(bounds, np.concatenate(parts), list(place))


@contextmanager
def collector_off() -> Iterator[None]:
    """Many short lists, none in a cycle: searching them for cycles would cost more than they."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


class Ragged:
    """Rows of numbers of different lengths, stored end to end."""

    def __init__(self, rows: list, dtype) -> None:
        self.sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.flat = np.fromiter(chain.from_iterable(rows), dtype, int(self.starts[-1]))

    @classmethod
    def of(cls, flat: np.ndarray, sizes: np.ndarray) -> Ragged:
        ragged = cls.__new__(cls)
        ragged.flat, ragged.sizes = flat, sizes
        ragged.starts = np.concatenate([[0], np.cumsum(sizes)])
        return ragged

    def take(self, places: np.ndarray) -> np.ndarray:
        """The rows at ``places`` end to end."""
        sizes = self.sizes[places]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.starts[places] - (ends - sizes), sizes)
        return self.flat[at]


def sums_between(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` in each span of ``bounds``."""
    running = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return running[bounds[1:]] - running[bounds[:-1]]


def batches_of(
    batches: Iterator[pa.RecordBatch], rows: int, size: int
) -> Iterator[pa.RecordBatch]:
    """Batches of about ``rows`` rows or ``size`` bytes, whichever is less; cut or put together.

    Spark sends small batches, so that neither side buffers much; a dictionary of distinct
    words pays with larger ones.  A single row may be larger.
    """
    held: list[pa.RecordBatch] = []
    count = weight = 0
    for batch in batches:
        step = max(1, min(rows, int(batch.num_rows * size / max(1, batch.nbytes))))
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            if held and (count + part.num_rows > rows or weight + part.nbytes > size):
                yield _joined(held)
                held, count, weight = [], 0, 0
            held.append(part)
            count, weight = count + part.num_rows, weight + part.nbytes
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.concat_batches(parts)


def lowered_pieces(words: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str], list[str]]:
    """Sizes and codes of words, distinct pieces, and words that stay whole.

    Pieces are runs of letters, digits, and runs of other signs, in lower case.  A word that
    Arrow cannot cut as the tokenizers do is whole; its code counts on after the pieces.
    """
    cuttable = pc.match_substring_regex(words, _CUTTABLE)
    texts = pc.utf8_lower(pc.if_else(cuttable, words, ""))
    # Most words are letters only, for which the pattern would be slow.
    mixed = pc.invert(pc.utf8_is_alpha(texts))
    cut = pc.replace_substring_regex(
        texts.filter(mixed), pattern=_RUNS, replacement=f"\\1{_MARK}"
    )
    none, mark = (pa.scalar(x, texts.type) for x in ("", _MARK))
    ended = pc.binary_join_element_wise(texts, none, mark)
    marked = pc.replace_with_mask(ended, mixed, cut)
    bounds, codes, pieces = _coded(pc.split_pattern(marked, _MARK))
    # A mark follows each piece, so an empty piece ends every word.
    sizes = np.diff(bounds) - 1
    codes = np.delete(codes, bounds[1:] - 1)
    whole = np.flatnonzero(~np.asarray(cuttable, dtype=bool))
    codes = np.insert(
        codes, np.cumsum(sizes)[whole], len(pieces) + np.arange(len(whole), dtype=np.int32)
    )
    sizes[whole] = 1
    return sizes, codes, pieces.to_pylist(), words.take(pa.array(whole)).to_pylist()


# Words of plain signs after at most one blank or line feed, without contractions and added
# tokens; a word that the pattern of byte-level tokenizers cuts as ``_SPACED_RUNS`` does.
_SPACED_CUTTABLE = (
    "^[ \n]?[!-&(-;=-\x84\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f\u2010-\u2027]+$"
)
_SPACED_RUNS = r"(\n| ?(?:\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+))"


def _short_letters(words: pa.Array) -> np.ndarray:
    """Words that are, after at most blanks, letters below U+0240 only; a few others may miss it."""
    at = np.frombuffer(words.buffers()[1], np.int64)[words.offset :][: len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    # Lead bytes of other signs; the letters among those that 0xC2 leads take the longer way.
    other = (data >= 0xC9) | (data == 0xC2)
    before = np.concatenate([[0], np.cumsum(other)])
    letters = pc.utf8_is_alpha(pc.utf8_ltrim(words, characters=" "))
    return np.asarray(letters, dtype=bool) & (before[at[1:]] == before[at[:-1]])


# Signs that are a piece of their own where they end a word of letters.
_ENDING = pa.array(list('!"#$%&()*+,-./:;=>?@[]^_`{|}~'), pa.large_string())


def _marked_letters(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of letters, or of letters and one sign, with a mark after each piece; and which."""
    none, mark = (pa.scalar(x, words.type) for x in ("", _MARK))
    stem, last = pc.utf8_slice_codeunits(words, 0, -1), pc.utf8_slice_codeunits(words, -1)
    ended = _short_letters(stem) & np.asarray(pc.is_in(last, _ENDING), dtype=bool)
    marked = pc.if_else(
        pa.array(ended),
        pc.binary_join_element_wise(stem, last, none, mark),
        pc.binary_join_element_wise(words, none, mark),
    )
    return marked, ended | _short_letters(words)


def spaced_pieces(words: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str], list[str]]:
    """Like ``lowered_pieces``, for words with the blank before them and in their own case.

    ``words`` is an array of large strings.
    """
    none, mark = (pa.scalar(x, words.type) for x in ("", _MARK))
    # Most words are letters after a blank or a line feed, and need no pattern.
    line = pc.starts_with(words, "\n")
    core = pc.if_else(line, pc.utf8_slice_codeunits(words, 1), words)
    marked, known = _marked_letters(core)
    marked = pc.if_else(
        line, pc.binary_join_element_wise(pa.scalar("\n", words.type), marked, mark), marked
    )
    blank = pc.if_else(line, pc.starts_with(core, " "), pc.starts_with(core, "  "))
    known &= ~np.asarray(blank, dtype=bool)
    rest = words.filter(pa.array(~known))
    cuttable = pc.match_substring_regex(rest, _SPACED_CUTTABLE)
    cut = pc.replace_substring_regex(
        pc.if_else(cuttable, rest, ""), pattern=_SPACED_RUNS, replacement=f"\\1{_MARK}"
    )
    marked = pc.replace_with_mask(marked, pa.array(~known), cut)
    bounds, codes, pieces = _coded(pc.split_pattern(marked, _MARK))
    # A mark follows each piece, so an empty piece ends every word.
    sizes = np.diff(bounds) - 1
    codes = np.delete(codes, bounds[1:] - 1)
    whole = np.flatnonzero(~known)[~np.asarray(cuttable, dtype=bool)]
    codes = np.insert(
        codes, np.cumsum(sizes)[whole], len(pieces) + np.arange(len(whole), dtype=np.int32)
    )
    sizes[whole] = 1
    return sizes, codes, pieces.to_pylist(), words.take(pa.array(whole)).to_pylist()


def spell_all(pieces: list[str]) -> list[str]:
    """Letters of the UTF-8 bytes of pieces without the zero byte, all in one step."""
    letters = np.array([ord(letter) for letter in byte_letters()], "<u2")
    data = np.frombuffer("\0".join(pieces).encode(), np.uint8)
    return letters[data].tobytes().decode("utf-16-le").split(chr(letters[0])) if pieces else []


def spaced_piece_encoder(tokenizer, most: int) -> Callable[[list[str]], list[list[int]]]:
    """Ids of pieces of ``spaced_pieces``, remembering ``most`` of them."""
    merge = tokenizer.model.tokenize
    return memo(
        lambda pieces: [[token.id for token in merge(p)] for p in spell_all(pieces)], most
    )


def memo(encode: Callable[[list[str]], list], most: int) -> Callable[[list[str]], list]:
    """``encode`` with a memory of at most ``most`` words besides those of one call."""
    known: dict[str, object] = {}

    def look_up(words: list[str]) -> list:
        new = [word for word in words if word not in known]
        if len(known) + len(new) > most:
            known.clear()
            new = words
        known.update(zip(new, encode(new)))
        return [known[word] for word in words]

    return look_up


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


def spelling() -> Callable[[str], str]:
    """Turns a text into the letters of its UTF-8 bytes."""
    table = dict(enumerate(byte_letters()))
    return lambda text: text.encode().decode("latin-1").translate(table)


def piece_finder(tokenizer, pattern: re.Pattern, lower: bool) -> Callable[[str], list[str] | None]:
    """Cuts a word into spelled pre-tokens; None if the word holds an added token.

    Plain words are cut by ``pattern``, all others by the tokenizer's own steps.
    """
    spell = spelling()
    marks = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
    before, split = tokenizer.normalizer, tokenizer.pre_tokenizer

    def find(word: str) -> list[str] | None:
        if any(mark in word for mark in marks):
            return None
        if PLAIN.fullmatch(word):
            pieces = pattern.findall(word.lower() if lower else word)
            return pieces if word.isascii() and word.isprintable() and " " not in word else [
                spell(piece) for piece in pieces
            ]
        text = before.normalize_str(word) if before else word
        return [piece for piece, _ in split.pre_tokenize_str(text)]

    return find


def piece_encoder(tokenizer, most: int) -> Callable[[list[str]], list[list[int]]]:
    """Ids of pieces (texts of one pre-token), remembering ``most`` of them."""
    spell, merge = spelling(), tokenizer.model.tokenize

    def encode(pieces: list[str]) -> list[list[int]]:
        spelled = [p if p.isascii() and p.isprintable() else spell(p) for p in pieces]
        return [[token.id for token in merge(p)] for p in spelled]

    return memo(encode, most)


def word_encoder(
    vocabulary: str, pattern: re.Pattern, lower: bool, most: int = 300_000
) -> Callable[[list[str]], list[list[int]]]:
    """Encodes distinct words exactly as the tokenizer of ``vocabulary`` encodes each alone."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(vocabulary)
    find = piece_finder(tokenizer, pattern, lower)
    merge = memo(
        lambda pieces: [[t.id for t in tokenizer.model.tokenize(p)] for p in pieces], most
    )

    def encode(words: list[str]) -> list[list[int]]:
        found = [find(word) for word in words]
        distinct = list({piece for pieces in found for piece in pieces or ()})
        ids = dict(zip(distinct, merge(distinct)))
        return [
            tokenizer.encode(word, add_special_tokens=False).ids
            if pieces is None
            else [i for piece in pieces for i in ids[piece]]
            for word, pieces in zip(words, found)
        ]

    return encode
