"""One row per key.

``row_number() = 1`` lets Spark place a group limit before the shuffle: every map task
sends at most one row per key, so a key that holds a third of all rows does not end up in
one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pick_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(window))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    mark: str = "modified_at",
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """The most recently modified row of each key; ties fall to the larger tie-break values."""
    return pick_first(df, keys, [F.col(c).desc_nulls_last() for c in (mark, *tie_break)])


def lowest_per_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """Smallest non-NULL ``value`` of each key, as a hash aggregate with map-side combine."""
    return df.groupBy(key).agg(F.min(value).alias(value))
