"""Token counts through whole-token shortcuts.

Offline, every vocabulary string that ends a word is encoded alone; those that come back as
their own single id are *proven whole*.  A pre-token among them counts one without any merge;
only the other pre-tokens are merged.  The count runs where the text is read, without a
shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from starwright.llm.common import keyed_text, shared_text
from starwright.llm.words import (
    WORD_PIECES, batches_of, byte_letters, memo, piece_finder, sums_between, texts_of,
    words_between_spaces,
)

BATCH_ROWS, BATCH_BYTES, KEPT_WORDS = 5000, 20 << 20, 300_000


def whole_tokens(vocabulary: str) -> frozenset[str]:
    """Spelled pre-tokens proven to be one token; at most as many as the vocabulary has."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(vocabulary)
    ending = tokenizer.model.end_of_word_suffix or ""
    byte_of = {letter: b for b, letter in enumerate(byte_letters())}
    proven = set()
    for token, number in tokenizer.get_vocab(with_added_tokens=False).items():
        spelled = token[: len(token) - len(ending)]
        if not spelled or not token.endswith(ending) or not all(c in byte_of for c in spelled):
            continue
        try:
            text = bytes(byte_of[c] for c in spelled).decode()
        except UnicodeDecodeError:
            continue
        if tokenizer.encode(text, add_special_tokens=False).ids == [number]:
            proven.add(spelled)
    return frozenset(proven)


def count_tokens(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
    over: int = 2048,
) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_tokens, over_limit``.

    ``path`` is a ``tokenizers`` file that splits words at white space and ends them with a
    suffix.  A null text counts as empty: no byte, no token.  Repeated rows and null ids stay
    rows of their own; an empty table gives no row; texts are counted whole, whatever their
    length.  Other columns of ``docs`` are left out.
    """
    vocabulary = shared_text(path)
    whole = whole_tokens(vocabulary)
    frame = keyed_text(docs, id_col, text_col)
    schema = T.StructType([
        T.StructField("doc_id", frame.schema["doc_id"].dataType),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("over_limit", T.BooleanType()),
    ])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(vocabulary)
        find = piece_finder(tokenizer, WORD_PIECES, lower=True)
        merged = memo(
            lambda pieces: [len(tokenizer.model.tokenize(p)) for p in pieces], KEPT_WORDS
        )

        def sizes(words: list[str]) -> np.ndarray:
            found = [find(word) for word in words]
            rest = list({p for pieces in found for p in pieces or () if p not in whole})
            cost = dict(zip(rest, merged(rest)))
            return np.fromiter(
                (
                    len(tokenizer.encode(word, add_special_tokens=False).ids)
                    if pieces is None
                    else sum(cost.get(piece, 1) for piece in pieces)
                    for word, pieces in zip(words, found)
                ),
                np.int64, len(words),
            )

        for batch in batches_of(batches, BATCH_ROWS, BATCH_BYTES):
            texts = texts_of(batch.column(1))
            split = words_between_spaces(texts)
            tokens = sums_between(sizes(split.words)[split.codes], split.bounds)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pc.binary_length(texts).cast(pa.int64()),
                    pa.array(tokens),
                    pa.array(tokens > over),
                ],
                names=schema.names,
            )

    return frame.mapInArrow(count, schema)
