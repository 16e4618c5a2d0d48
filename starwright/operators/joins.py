"""Joins that stay small for a small batch, and balanced when one key, or NULL, is hot."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starwright.session import beyond_broadcast, materialize

#: Bits of a key filter: so many for each key, up to a most of 32 MB; beyond it lets more rows pass.
BITS_PER_KEY, MOST_BITS = 8, 1 << 28
#: Bits that a key sets, at most; fewer where keys have few bits each.
MOST_HASHES = 3
#: Bits in a row of a filter, as Spark's bitmap functions make them, and in a word of it.
_ROW_OF_BITS, _WORD = 1 << 15, 64


def left_join_sparse(left: DataFrame, right: DataFrame, key: str, spread_by: str) -> DataFrame:
    """Left join on a whole-number key that many rows of ``left`` lack.

    All NULL keys would hash to one task.  They match nothing, so a second join column
    spreads them; it is zero on every row that can match.  Adaptive execution splits a large
    partition only where both inputs of a join come straight from a shuffle; this join also
    serves a right side that was just aggregated.
    """
    # Several values for each task, so that no task gets many by chance.
    ways = 8 * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(spread_by), F.lit(ways)))
    salted = left.withColumn("_spread", F.coalesce(spread, F.lit(0).cast("long")))
    # Zero written as a function of the key, or the optimiser folds the column away.
    zero = F.pmod(F.col(key).cast("long"), F.lit(1).cast("long"))
    return salted.join(right.withColumn("_spread", zero), [key, "_spread"], "left").drop("_spread")


def members_used(big: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Rows of a large table whose key occurs in a batch.

    The batch is a written table, so a small one is broadcast and the large table is
    filtered where it is scanned instead of being shuffled.
    """
    return big.join(batch.select(key).distinct(), key, "left_semi").select(*big.columns)


@dataclass(frozen=True)
class KeyFilter:
    """Which keys a large written table may have, as a bitmap of their hashes.

    A table that meets it in a join need not be shuffled where the filter tells that a row has no
    match.  The filter is broadcast, and bounded; keys that share a bit with another one pass as
    well, so it stands before an exact join, never in its place.
    """

    bitmap: DataFrame
    bits: int
    hashes: int = 1

    def split(self, df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
        """Rows whose key may be in the table, and rows whose key is not."""
        bits = _bits_of(key, self.bits, self.hashes)
        tested = df.withColumns({"_bits_row": _row_of(key, self.bits), **bits}).join(
            F.broadcast(self.bitmap), "_bits_row", "left"
        )
        is_set = F.coalesce(reduce(and_, [_is_set(bit) for bit in bits]), F.lit(False))
        return (
            tested.where(is_set).select(*df.columns), tested.where(~is_set).select(*df.columns)
        )

    def may_match(self, df: DataFrame, key: str) -> DataFrame:
        return self.split(df, key)[0]


def _row_of(key: str, bits: int) -> Column:
    return F.floor(F.pmod(F.xxhash64(key), F.lit(bits)) / F.lit(_ROW_OF_BITS))


def _bits_of(key: str, bits: int, hashes: int) -> dict[str, Column]:
    """The bits of a key, all in its row, so that one lookup finds them."""
    slots = [F.pmod(F.xxhash64(key), F.lit(bits))]
    slots += [F.xxhash64(key, F.lit(number)) for number in range(1, hashes)]
    return {f"_bit{i}": F.pmod(slot, F.lit(_ROW_OF_BITS)) for i, slot in enumerate(slots)}


def _words(bitmap: str) -> Column:
    """A bitmap as words, of which a test reads one by its place and makes no text."""
    return F.expr(
        f"transform(sequence(0, {_ROW_OF_BITS // _WORD - 1}), i ->"
        f" CAST(conv(hex(substring({bitmap}, {_WORD // 8} * i + 1, {_WORD // 8})), 16, -10)"
        " AS BIGINT))"
    )


def _is_set(bit: str) -> Column:
    # The first byte of a word is its highest, and a bit counts from the lowest end of its byte.
    place = f"CAST(({bit} % {_WORD}) ^ {_WORD - 8} AS INT)"
    return F.expr(f"shiftright(_words[CAST({bit} DIV {_WORD} AS INT)], {place}) & 1 = 1")


def key_filter(written: DataFrame, key: str, lasting: bool = False) -> KeyFilter:
    """A filter of the keys of a written table; only its bits are shuffled.

    A ``lasting`` one outlives a step that removes its scratch tables.
    """
    keys = written.count()
    wanted = max(_ROW_OF_BITS, BITS_PER_KEY * keys)
    bits = min(MOST_BITS, 1 << (wanted - 1).bit_length())
    # Half of the bits are set at 0.7 times as many hashes as a key has bits; more pass more rows.
    hashes = max(1, min(MOST_HASHES, 7 * bits // (10 * max(1, keys))))
    rows = (
        written.select(
            _row_of(key, bits).alias("_bits_row"),
            F.explode(F.array(*_bits_of(key, bits, hashes).values())).alias("_bit"),
        )
        .groupBy("_bits_row")
        .agg(F.bitmap_construct_agg("_bit").alias("_bitmap"))
        .select("_bits_row", _words("_bitmap").alias("_words"))
    )
    bitmap = materialize(rows, "key-filter", lasting, compression="zstd")
    return KeyFilter(bitmap, bits, hashes)


@dataclass(frozen=True)
class ExactKeys:
    """Which rows of one table have a key of a written one, with few rows left to be looked for.

    ``passing`` is a filter of the keys, ``spared`` one of those keys of the table that pass it without
    being among them.
    """

    written: DataFrame
    key: str
    passing: KeyFilter
    spared: KeyFilter

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Rows that have such a key, rows that may have one, rows that have none."""
        found, without = self.passing.split(df, self.key)
        unsure, sure = self.spared.split(found, self.key)
        return sure, unsure, without

    def matching(self, df: DataFrame) -> DataFrame:
        """The rows that have such a key; only those that may have one are joined."""
        sure, unsure, _ = self.split(df)
        return sure.unionByName(
            unsure.join(self.written.select(self.key), self.key, "left_semi").select(*df.columns)
        )

    def others(self, df: DataFrame) -> DataFrame:
        """The rows that have no such key; only those that may have one are joined."""
        _, unsure, without = self.split(df)
        return without.unionByName(
            unsure.join(self.written.select(self.key), self.key, "left_anti").select(*df.columns)
        )


def exact_keys(df: DataFrame, written: DataFrame, key: str) -> ExactKeys:
    """What ``ExactKeys`` has to know of ``df``, whose rows may meet a written table."""
    passing = key_filter(written, key)
    spared = materialize(
        passing.may_match(df.select(key), key).join(written.select(key), key, "left_anti"),
        "spared-keys", compression="zstd",
    )
    return ExactKeys(written, key, passing, key_filter(spared, key))


def may_meet(df: DataFrame, written: DataFrame, key: str) -> DataFrame:
    """``df`` without most rows whose key a written table lacks, if that is too large to broadcast."""
    return key_filter(written, key).may_match(df, key) if beyond_broadcast(written) else df
