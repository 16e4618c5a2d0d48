"""Near-duplicate documents by SimHash, found with meet-in-the-middle ball hashing.

Fingerprints are first made distinct, so a group of equal copies is one row.  Two distinct
fingerprints within r bits have a middle: a value within ceil(r/2) bits of one and floor(r/2)
bits of the other.  Each fingerprint emits the values within half the radius; a shuffle brings
equal values together.  A value has few fingerprints near it (65 within one bit of 64), so no
bucket grows with the data, and linking each member to the smallest one (a *star*) replaces
the pairs of a bucket.  All links are verified by their bit distance.

For the even part of the radius every fingerprint emits its ball of that half radius.  The odd
bit (radius 3: one fingerprint moves two bits, the other one) would need balls of radius two,
2,081 values each.  They are emitted only where they can matter: of two fingerprints within
three bits, one *half* of the bits differs in at most one bit, so a group of half-values that
holds two unconnected ones is looked for first, by minima and maxima that combine map-side.  And of
three differing bits two lie in the same half, so pairs of flips inside a half suffice.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starwright.llm.common import keyed_text, lookup_join, materialize, spread
from starwright.llm.components import smallest_reachable
from starwright.llm.words import batches_of, texts_of

BITS, HALF, SEED = 64, 32, 42
BATCH_ROWS, BATCH_BYTES, PIECE = 2048, 8 << 20, 1 << 18


def fingerprint_of(words: list[bytes], shingle: int) -> int:
    """Majority bits of the XXH64 of all shingles; zero without words."""
    from xxhash import xxh64_intdigest

    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    votes = np.zeros(BITS, np.int64)
    for start in range(0, n, PIECE):
        stop = min(n, start + PIECE)
        parts = [words[start + j : stop + j] for j in range(min(shingle, len(words)))]
        hashes = np.fromiter(
            (xxh64_intdigest(b" ".join(s), SEED) for s in zip(*parts)), "<u8", stop - start
        )
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, BITS)
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, fingerprint`` (a signed long with the 64 bits) for every row."""
    frame = keyed_text(docs, id_col, text_col)
    schema = T.StructType([
        T.StructField("doc_id", frame.schema["doc_id"].dataType),
        T.StructField("fingerprint", T.LongType()),
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, BATCH_ROWS, BATCH_BYTES):
            # For bytes, lower() and split() know ASCII letters and white space only.
            found = np.array(
                [
                    fingerprint_of(text.as_py().encode().lower().split(), shingle)
                    for text in texts_of(batch.column(1))
                ],
                np.uint64,
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64))], names=schema.names
            )

    return frame.mapInArrow(work, schema)


def _flips(positions: list[tuple[int, ...]]) -> Column:
    """Literal array of longs with the given bits set."""
    masks = np.array([sum(1 << p for p in bits) for bits in positions], np.uint64)
    return F.lit(masks.view(np.int64).tolist())


def _ball(radius: int) -> list[tuple[int, ...]]:
    return [bits for n in range(radius + 1) for bits in combinations(range(BITS), n)]


def _distance(left: Column, right: Column) -> Column:
    return F.bit_count(left.bitwiseXOR(right))


def _stars(met: DataFrame, max_bits: int, label: str) -> DataFrame:
    """Links from each member of a bucket to its hub, verified by their distance.

    ``met``: ``middle, fingerprint, near``; the hub is the smallest fingerprint among those
    marked near.  Only the few values that at least two fingerprints reach are kept.
    """
    shared = materialize(
        met.groupBy("middle")
        .agg(
            F.min(F.when(F.col("near"), F.col("fingerprint"))).alias("hub"),
            F.count("*").alias("members"),
        )
        .where((F.col("members") > 1) & F.col("hub").isNotNull())
        .select("middle", "hub"),
        label,
    )
    return (
        lookup_join(met, shared, "middle")
        .where(_distance(F.col("fingerprint"), F.col("hub")).between(1, max_bits))
        .select(F.col("fingerprint").alias("src"), F.col("hub").alias("dst"))
        .distinct()
    )


def _emit(prints: DataFrame, flips: list[tuple[int, ...]], near: bool) -> DataFrame:
    return spread(prints).select("fingerprint", F.explode(_flips(flips)).alias("flip")).select(
        F.col("fingerprint").bitwiseXOR(F.col("flip")).alias("middle"),
        "fingerprint",
        F.lit(near).alias("near"),
    )


def links_even(prints: DataFrame, max_bits: int) -> DataFrame:
    """Links that connect all fingerprints within ``2 * (max_bits // 2)`` bits."""
    return _stars(_emit(prints, _ball(max_bits // 2), True), max_bits, "simhash-even-middles")


def hubs_of(prints: DataFrame, links: DataFrame) -> DataFrame:
    """``fingerprint, hub``: the smallest fingerprint two links away, or the fingerprint itself.

    Fingerprints with one hub are connected, so they need no further link; that is all that
    the search for odd distances asks, and it spares the whole components at this point.
    """
    first = links.groupBy("src").agg(F.min("dst").alias("hub"))
    second = first.select(F.col("src").alias("hub"), F.col("hub").alias("next"))
    far = first.join(second, "hub", "left").select(
        F.col("src").alias("fingerprint"), F.coalesce(F.least("hub", "next"), "hub").alias("hub")
    )
    return prints.join(far, "fingerprint", "left").select(
        "fingerprint", F.least("fingerprint", "hub").alias("hub")
    )


def suspects(labelled: DataFrame, half_radius: int) -> DataFrame:
    """Fingerprints of which a half is within ``half_radius`` of that of another hub's.

    ``labelled``: ``fingerprint, hub``.  One of two such fingerprints is the *centre*, the
    other one emits the centre's half among its variants.  A group keeps extremes only.
    """
    flips = [b for b in _ball(half_radius) if all(p < HALF for p in b)]
    low = F.col("fingerprint").bitwiseAND(F.lit((1 << HALF) - 1))
    high = F.shiftrightunsigned("fingerprint", HALF)
    # One long per half-value: the half's number is bit 32.
    halves = F.array(low, high.bitwiseOR(F.lit(1 << HALF)))
    keyed = (
        spread(labelled)
        .select("fingerprint", "hub", F.explode(halves).alias("half"))
        .select("fingerprint", "hub", "half", F.explode(_flips(flips)).alias("flip"))
        .select(
            "fingerprint",
            "hub",
            F.col("half").bitwiseXOR(F.col("flip")).alias("key"),
            (F.col("flip") == 0).alias("centre"),
        )
    )
    mixed = materialize(
        keyed.groupBy("key")
        .agg(
            F.min("hub").alias("low"),
            F.max("hub").alias("high"),
            F.bool_or("centre").alias("centred"),
        )
        .where((F.col("low") != F.col("high")) & F.col("centred"))
        .select("key"),
        "simhash-mixed",
    )
    return lookup_join(keyed, mixed, "key", "left_semi").select("fingerprint").distinct()


def links_odd(prints: DataFrame, max_bits: int) -> DataFrame:
    """Links for fingerprints at the full odd distance ``max_bits``, one or three."""
    if max_bits == 1:
        near, far = [()], _ball(1)[1:]
    else:
        near = _ball(1)
        far = [b for b in combinations(range(BITS), 2) if (b[0] < HALF) == (b[1] < HALF)]
    met = _emit(prints, near, True).unionAll(_emit(prints, far, False))
    return _stars(met, max_bits, "simhash-odd-middles")


def near_duplicates(
    docs: DataFrame, shingle: int = 3, max_bits: int = 3,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    Words are what lies between ASCII white space after A-Z are lowered; a text of fewer words
    than ``shingle`` is one shingle; a null or empty text has fingerprint zero.  Documents
    whose fingerprints differ in at most ``max_bits`` (0 to 3) bits are linked;
    ``component_id`` is the smallest ``doc_id`` reachable (null ids count as larger than all).
    Repeated rows stay rows of one component.  Other columns of ``docs`` are left out.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits must be from 0 to 3")
    rows = materialize(fingerprints(docs, shingle, id_col, text_col), "simhash-rows")
    prints = materialize(
        rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first_doc")), "simhash-prints"
    )
    alone = prints.select("fingerprint")
    links = materialize(links_even(alone, max_bits), "simhash-links")
    if max_bits % 2:
        labelled = hubs_of(alone, links)
        found = materialize(suspects(labelled, max_bits // 2), "simhash-suspects")
        links = links.unionAll(links_odd(found, max_bits))
    labels = smallest_reachable(links, "simhash-components")
    joined = prints.join(labels, prints.fingerprint == labels.node, "left").select(
        "fingerprint", "first_doc", F.coalesce("component", "fingerprint").alias("component")
    )
    linked = labels.select("component").distinct()
    smallest = (
        joined.join(linked, "component", "left_semi")
        .groupBy("component")
        .agg(F.min("first_doc").alias("component_id"))
    )
    reached = joined.join(smallest, "component", "left").select(
        "fingerprint", F.coalesce("component_id", "first_doc").alias("component_id")
    )
    return rows.join(reached, "fingerprint").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        "component_id",
    )
