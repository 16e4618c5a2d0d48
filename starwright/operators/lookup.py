"""Surrogate-key lookups.

Each lookup is a left join with a dimension reduced to one row per business key, so it
never multiplies fact rows.  The reduced side is written first.  Its true size then decides
between a broadcast, under the session's threshold, and a shuffle; and as a plain scan it
lets adaptive execution split the partitions of a hot or missing key, which it does not do
for a side that ends in an aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starwright.operators.keys import UNKNOWN_KEY
from starwright.session import materialize


def one_row_per_key(
    dim: DataFrame, business_key: str, key: str, attributes: Mapping[str, str] | None = None
) -> DataFrame:
    """Highest surrogate key of each business key among the current versions.

    ``attributes`` maps attributes of that version to their output names.
    """
    if "is_current" in dim.columns:
        dim = dim.where("is_current")
    return dim.groupBy(business_key).agg(
        F.max(key).alias(key),
        *[F.max_by(a, key).alias(name) for a, name in (attributes or {}).items()],
    )


def lookup_side(
    dim: DataFrame, business_key: str, key: str, attributes: Mapping[str, str] | None = None
) -> DataFrame:
    """The reduced dimension as a written table."""
    reduced = one_row_per_key(dim, business_key, key, attributes)
    return materialize(reduced, f"lookup-{key}", compression="zstd")


def join_side(df: DataFrame, side: DataFrame, business_key: str, key: str) -> DataFrame:
    """Add the columns of a lookup side; a key that is missing becomes ``-1``."""
    joined = df.join(side, business_key, "left")
    return joined.withColumn(key, F.coalesce(key, F.lit(UNKNOWN_KEY).cast("long")))


def lookup_current(
    df: DataFrame,
    dim: DataFrame,
    business_key: str,
    key: str,
    attributes: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add the key of the current version, ``-1`` when there is none.

    Works for both dimension types; type 1 tables have no version column.
    """
    return join_side(df, lookup_side(dim, business_key, key, attributes), business_key, key)


def lookup_as_of(
    df: DataFrame,
    dim: DataFrame,
    business_key: str,
    day: str,
    key: str,
    attributes: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add the key of the version in force on ``day``, ``-1`` when there is none.

    Versions and the distinct asked days of a business key are merged by day, and the last
    version that has begun is carried forward to the days after it; so the work per key grows
    with its versions and days, not with their product.  If versions overlap, the one that
    began last counts, and of those that began together the highest key.  The wide frame then
    joins on key and day, so a hot business key spreads over its days.
    """
    attributes = dict(attributes or {})
    versions = dim.where(F.col("valid_from") < F.col("valid_to")).select(
        F.col(business_key).alias("_bk"),
        F.col("valid_from").alias("_day"),
        F.struct("valid_to", key, *attributes).alias("_version"),
        F.col(key).alias("_order"),
        F.lit(None).cast(df.schema[day].dataType).alias("_asked"),
    )
    asked = df.select(business_key, day).dropna().distinct().select(
        F.col(business_key).alias("_bk"),
        F.col(day).cast("date").alias("_day"),
        F.lit(None).cast(versions.schema["_version"].dataType).alias("_version"),
        # On its first day a version is in force already.
        F.lit(2**63 - 1).alias("_order"),
        F.col(day).alias("_asked"),
    )
    by_day = Window.partitionBy("_bk").orderBy("_day", "_order")
    resolved = (
        versions.unionByName(asked)
        .withColumn("_version", F.last("_version", ignorenulls=True).over(by_day))
        .where(F.col("_asked").isNotNull() & (F.col("_day") < F.col("_version.valid_to")))
        .select(
            F.col("_bk").alias(business_key),
            F.col("_asked").alias(day),
            F.col(f"_version.{key}").alias(key),
            *[F.col(f"_version.{a}").alias(name) for a, name in attributes.items()],
        )
    )
    side = materialize(resolved, f"as-of-{key}")
    joined = df.join(side, [business_key, day], "left")
    return joined.withColumn(key, F.coalesce(key, F.lit(UNKNOWN_KEY).cast("long")))
