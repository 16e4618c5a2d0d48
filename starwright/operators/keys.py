"""Surrogate keys and unknown members."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starwright.operators.shaping import conform_to_schema
from starwright.session import materialize

UNKNOWN_KEY = -1

# Spark's generated row id holds the partition number above these low bits.
_ROW_BITS = 33


def stamp_rows(df: DataFrame, column: str = "row_stamp") -> DataFrame:
    """Add a unique id per row; fixed only once the frame has been written."""
    return df.withColumn(column, F.monotonically_increasing_id())


def dense_numbers(
    stamped: DataFrame, number: str, start: int, column: str = "row_stamp"
) -> DataFrame:
    """Turn the stamps of a *written* frame into consecutive numbers after ``start``.

    Each task of the write has a block of numbers.  The blocks are a small written table, one row
    per task, that is joined; so neither the plan nor the driver grows with the partitions, and
    the numbers come without a shuffle or a window over all rows.
    """
    part = F.shiftright(column, _ROW_BITS)
    position = F.col(column) - F.shiftleft(part, _ROW_BITS)
    counts = stamped.groupBy(part.alias("_block")).agg((F.max(position) + 1).alias("_rows"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = materialize(
        counts.select("_block", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first")),
        "blocks",
    )
    numbered = stamped.withColumn("_block", part).join(F.broadcast(blocks), "_block")
    value = F.lit(start) + F.col("_first") + position + 1
    return numbered.withColumn(number, value.cast("long")).drop(column, "_block", "_first")


def stage_in_order(df: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """Write ``df`` range-partitioned and sorted by ``order``, with row stamps."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(stamp_rows(ranged), label, compression="zstd")


def number_in_order(
    df: DataFrame, order: Sequence[str], number: str, start: int, label: str = "numbered"
) -> DataFrame:
    """Consecutive numbers in the order of ``order``, as ``row_number`` without a partition.

    The frame is written before it is numbered, since a recomputed range partitioning may
    draw other boundaries.
    """
    return dense_numbers(stage_in_order(df, order, label), number, start)


def last_key(df: DataFrame, key: str) -> int:
    """Highest surrogate key in use, 0 for a table that holds only the unknown member."""
    return max(df.agg(F.max(key)).first()[0] or 0, 0)


def unknown_member(
    reference: DataFrame, table: str, key: str, business_key: str, labels: dict[str, str]
) -> DataFrame:
    """The ``-1`` row of a dimension, all other columns at their defaults."""
    values = {key: f"{UNKNOWN_KEY}", business_key: f"{UNKNOWN_KEY}"}
    values |= {column: f"'{label}'" for column, label in labels.items()}
    one_row = reference.sparkSession.range(1)
    row = one_row.selectExpr(*[f"{v} AS {c}" for c, v in values.items()])
    return conform_to_schema(row, table)


def seed_unknown(
    dim: DataFrame, table: str, key: str, business_key: str, labels: dict[str, str]
) -> DataFrame:
    """``dim`` with its unknown member; a row already present wins."""
    seed = unknown_member(dim, table, key, business_key, labels)
    missing = seed.join(dim.select(key), key, "left_anti").select(*dim.columns)
    return dim.unionByName(missing)
