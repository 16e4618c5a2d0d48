"""Language identification by compression.

Each language has a raw-content zstandard dictionary, made of some of its texts.  A text is
reduced to lower-case words, as the dictionaries are, and cut into blocks; every block is
compressed with every dictionary, and the language with the smallest total wins.  A narrow
margin to the second is a rejection.  Dictionaries are bounded together, so they travel with the
tasks, which open some of them at a time; texts are read once and nothing is shuffled.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starwright.llm.common import first_by_hash, keyed_text, lookup_join, materialize
from starwright.llm.words import batches_of, texts_of

BATCH_ROWS, BATCH_BYTES = 2048, 8 << 20
#: Bound of the learning sample: texts per language, and bytes of each and of a dictionary.  Texts
#: share a dictionary equally, so each of 400 gives 240 bytes, and each of 48 or fewer 2,000.
SAMPLE_TEXTS, SAMPLE_BYTES, DICTIONARY_BYTES = 400, 2_000, 96_000
#: Bytes of all dictionaries; with more languages than fit at their full size, each is smaller.
ALL_BYTES = 64 << 20
#: Least bytes that a text of the sample gives; small dictionaries are made of fewer texts.
LEAST_SHARE = 240
#: Dictionaries that a task holds open at once, and sizes (documents by languages) it keeps.
OPEN_LANGUAGES, MOST_SIZES = 200, 1 << 22
BLOCK_BYTES, LEVEL = 2048, 3
# Matches from three bytes on, found greedily: words are short.
MATCH, STRATEGY = 3, 3

_BETWEEN = re.compile(r"[\W\d_]+")


def reduced(text: str) -> bytes:
    """Lower-case words with one blank between them."""
    return _BETWEEN.sub(" ", text.lower()).encode()


def learn(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text",
) -> dict[str, bytes]:
    """A dictionary for every language, the most frequent first, from a sample of distinct texts.

    The sample is taken by the hash of the text, so copies count once and no id matters.  Each
    text gives an equal share of the dictionary, 2,000 characters at most, from a place that
    its hash chooses: 240 bytes, if a language has ``SAMPLE_TEXTS`` or more texts.  At most ``ALL_BYTES`` reach the driver, as each text is cut to its share of the dictionary
    before.  Rows without language or text teach nothing.
    """
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(
        F.col("lang").isNotNull() & (F.length("text") > 0)
    )
    langs = [
        row.lang
        for row in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    ]
    size = max(1, min(DICTIONARY_BYTES, ALL_BYTES // max(1, len(langs))))
    texts = min(SAMPLE_TEXTS, max(1, size // LEAST_SHARE))
    hashed = rows.select("lang", F.xxhash64("text").alias("h"))
    # Distinct before ranking: a group of copies, however large, is one candidate.
    chosen = materialize(
        first_by_hash(hashed.distinct(), "lang", "h", texts)
        .select("lang", "h", F.count("*").over(Window.partitionBy("lang")).alias("n")),
        "langid-sample",
    )
    # Openings are often the same.  A text that is no longer than the least share is taken whole;
    # a longer one from a place anywhere, and on from its opening if a larger share asks for it.
    places = F.greatest(F.length("text") - size // texts, F.lit(0)) + 1
    start = F.pmod(F.xxhash64("text"), places.cast("long")).cast("int") + 1
    piece = F.concat_ws(
        "\n",
        F.substring("text", start, F.lit(SAMPLE_BYTES)),
        F.substring("text", F.lit(1), F.least(start - 1, F.lit(SAMPLE_BYTES))),
    ).substr(1, SAMPLE_BYTES)
    found = (
        lookup_join(
            rows.select("lang", F.xxhash64("text").alias("h"), piece.alias("piece")),
            chosen, ["lang", "h"],
        )
        .groupBy("lang", "h").agg(F.min("piece").alias("piece"), F.first("n").alias("n"))
        .mapInArrow(partial(_shares, size=size), "lang string, h long, share binary")
        .orderBy("lang", "h")
    )
    shares: dict[str, list[bytes]] = {}
    for row in found.collect():
        shares.setdefault(row.lang, []).append(bytes(row.share))
    return {lang: b"\n".join(shares[lang])[:size] for lang in langs}


def _shares(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """An equal share of each of the ``n`` texts of a language: ``lang, h, share``."""
    for batch in batches:
        shares = [
            reduced(text.as_py())[: max(1, size // n.as_py())]
            for text, n in zip(batch.column("piece"), batch.column("n"))
        ]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("lang").cast(pa.string()), batch.column("h"),
                pa.array(shares, pa.binary()),
            ],
            names=["lang", "h", "share"],
        )


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def predict(
    docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = 0.01,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, lang_pred, score, rejected``.

    ``lang_pred`` is the language of the smallest size, ties to the one learned first;
    ``und`` if the text is null, has no letter, or no language was learned.  ``score`` is the
    share of that language among all by size; ``rejected`` tells that the second smallest
    size is within ``min_margin`` of the smallest, or that there is no language.  Repeated
    rows and null ids stay rows of their own; an empty table gives no row; long texts are
    compressed whole, in blocks of ``BLOCK_BYTES``.  Other columns of ``docs`` are left out.
    """
    frame = keyed_text(docs, id_col, text_col)
    langs = list(dictionaries)
    schema = T.StructType([
        T.StructField("doc_id", frame.schema["doc_id"].dataType),
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("rejected", T.BooleanType()),
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard as zstd

        settings = zstd.ZstdCompressionParameters.from_level(
            LEVEL, min_match=MATCH, strategy=STRATEGY, write_content_size=False,
            write_dict_id=False,
        )
        groups = [langs[i : i + OPEN_LANGUAGES] for i in range(0, len(langs), OPEN_LANGUAGES)]

        def opened(group: list[str]) -> list[zstd.ZstdCompressor]:
            coders = []
            for lang in group:
                raw = zstd.ZstdCompressionDict(dictionaries[lang], zstd.DICT_TYPE_RAWCONTENT)
                raw.precompute_compress(compression_params=settings)
                coders.append(zstd.ZstdCompressor(dict_data=raw, compression_params=settings))
            return coders

        # One group stays open; several are opened in turn for each batch.
        kept = opened(groups[0]) if len(groups) == 1 else None

        def sizes_of(texts: list[bytes]) -> np.ndarray:
            """Compressed size of each text (down) with each dictionary (across)."""
            blocks = [
                [data[i : i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]
                for data in texts
            ]
            parts = [np.zeros((len(texts), 0), np.int64)]
            for group in groups:
                coders = kept or opened(group)
                parts.append(np.array(
                    [[sum(len(c.compress(b)) for b in cut) for c in coders] for cut in blocks],
                    np.int64,
                ).reshape(len(texts), len(group)))
            return np.concatenate(parts, axis=1)

        def decide(sizes: np.ndarray) -> tuple[str, float, bool]:
            order = np.argsort(sizes, kind="stable")
            best = int(sizes[order[0]])
            # Bits saved against the others, as weights of a distribution over languages.
            weights = np.exp2(-np.minimum(8.0 * (sizes - best), 60.0) / math.sqrt(best))
            margin = (int(sizes[order[1]]) - best) / best if len(langs) > 1 else 1.0
            return langs[order[0]], float(1 / weights.sum()), margin < min_margin

        most_rows = max(1, min(BATCH_ROWS, MOST_SIZES // max(1, len(langs))))
        for batch in batches_of(batches, most_rows, BATCH_BYTES):
            texts = [text.as_py() for text in texts_of(batch.column(1))]
            judged = [bool(langs) and has_letter(text) for text in texts]
            sizes = iter(sizes_of([reduced(t) for t, ok in zip(texts, judged) if ok]))
            found = [decide(next(sizes)) if ok else ("und", 0.0, True) for ok in judged]
            kinds = (pa.string(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(zip(*found), kinds))],
                names=schema.names,
            )

    return frame.mapInArrow(work, schema)
