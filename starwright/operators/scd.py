"""Slowly changing dimensions as set-based merges."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starwright.functions.scalars import row_hash
from starwright.operators.dedup import pick_first
from starwright.operators.joins import members_used
from starwright.operators.keys import last_key, dense_numbers, number_in_order, stage_in_order
from starwright.schemas import OPEN_END

NEW, UNCHANGED, SAME_DAY, CHANGED = "NEW", "UNCHANGED", "SAME_DAY", "CHANGED"


def _as_date(load_date: str) -> Column:
    return F.lit(load_date).cast("date")


# --- type 1 -------------------------------------------------------------------------


def scd1_upsert(
    dim: DataFrame, staged: DataFrame, business_key: str, key: str, attributes: Sequence[str]
) -> DataFrame:
    """Overwrite the attributes of known keys, insert unknown ones; surrogates are kept."""
    incoming = staged.select(
        F.col(business_key).alias("_bk"), F.lit(True).alias("_hit"),
        *[F.col(a).alias(f"_{a}") for a in attributes],
    )
    kept = dim.join(incoming, F.col(business_key) == F.col("_bk"), "left").select(
        key,
        business_key,
        *[F.when(F.col("_hit"), F.col(f"_{a}")).otherwise(F.col(a)).alias(a) for a in attributes],
    )
    known = members_used(dim, staged, business_key).select(business_key)
    fresh = staged.join(known, business_key, "left_anti").select(business_key, *attributes)
    inserted = number_in_order(fresh, [business_key], key, last_key(dim, key), "scd1")
    return kept.unionByName(inserted).select(*dim.columns)


# --- type 2 -------------------------------------------------------------------------


def with_hash(staged: DataFrame, attributes: Sequence[str], strict: bool = False) -> DataFrame:
    return staged.withColumn("row_hash", row_hash([F.col(a) for a in attributes], strict))


def scd2_classify(
    dim: DataFrame,
    staged: DataFrame,
    business_key: str,
    key: str,
    attributes: Sequence[str],
    load_date: str,
    strict: bool = False,
) -> DataFrame:
    """Each staged row with the ``action`` its business key needs.

    A seeded row has no hash, so hashes are compared null-safely.  Should a key have several
    current versions, the one with the highest surrogate key counts, so that no staged row
    is multiplied.  ``previous_from`` is the start of the version compared with.
    """
    versions = members_used(dim.where("is_current"), staged, business_key)
    current = pick_first(versions, [business_key], [F.col(key).desc()]).select(
        F.col(business_key).alias("_bk"),
        F.col(key),
        F.col("row_hash").alias("_old_hash"),
        F.col("valid_from").alias("previous_from"),
    )
    action = (
        F.when(F.col("_bk").isNull(), NEW)
        .when(F.col("row_hash").eqNullSafe(F.col("_old_hash")), UNCHANGED)
        .when(F.col("previous_from") == _as_date(load_date), SAME_DAY)
        .otherwise(CHANGED)
    )
    hashed = with_hash(staged.select(business_key, *attributes), attributes, strict)
    return (
        hashed.join(current, F.col(business_key) == F.col("_bk"), "left")
        .withColumn("action", action)
        .drop("_bk", "_old_hash")
    )


def scd2_changes(
    dim: DataFrame,
    staged: DataFrame,
    business_key: str,
    key: str,
    attributes: Sequence[str],
    load_date: str,
    strict: bool = False,
    start: int | None = None,
) -> DataFrame:
    """The rows of a batch that alter the dimension, written as a scratch table.

    ``start`` is the highest surrogate key in use; it must be given if ``dim`` holds only the
    members that the batch touches.

    ``new_key`` numbers the rows that open a version.  Same-day rows sort last, so they
    leave no gap in those numbers.  A version cannot end before it begins, so a load date
    before the start of a version that would end is refused.
    """
    delta = (
        scd2_classify(dim, staged, business_key, key, attributes, load_date, strict)
        .where(F.col("action") != UNCHANGED)
        .withColumn("_in_place", F.col("action") == SAME_DAY)
    )
    written = stage_in_order(delta, ["_in_place", business_key], "scd2-changes")
    latest = written.agg(F.max("previous_from")).first()[0]
    if latest is not None and latest > date.fromisoformat(load_date):
        raise ValueError(f"load date {load_date} is before a version that begins on {latest}")
    used = last_key(dim, key) if start is None else start
    return dense_numbers(written, "new_key", used).drop("_in_place")


def scd2_apply(
    current: DataFrame,
    changes: DataFrame,
    business_key: str,
    key: str,
    attributes: Sequence[str],
    load_date: str,
    first_from: str | None = None,
) -> DataFrame:
    """Current versions after a batch, together with those the batch has closed.

    The first version of a member begins on ``first_from``, by default the load date.
    """
    today = _as_date(load_date)
    begins = F.when(F.col("action") == NEW, _as_date(first_from or load_date)).otherwise(today)
    tracked = [*attributes, "row_hash"]
    touched = changes.where(F.col("action").isin(SAME_DAY, CHANGED)).select(
        F.col(key).alias("_key"), "action", *[F.col(c).alias(f"_{c}") for c in tracked]
    )
    in_place = F.col("action") == SAME_DAY
    closed = F.coalesce(F.col("action") == CHANGED, F.lit(False))
    survivors = current.join(touched, F.col(key) == F.col("_key"), "left").select(
        key,
        business_key,
        *[F.when(in_place, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in attributes],
        "valid_from",
        F.when(closed, today).otherwise(F.col("valid_to")).alias("valid_to"),
        (F.col("is_current") & ~closed).alias("is_current"),
        F.when(in_place, F.col("_row_hash")).otherwise(F.col("row_hash")).alias("row_hash"),
    )
    opened = changes.where(F.col("action").isin(NEW, CHANGED)).select(
        F.col("new_key").alias(key),
        business_key,
        *attributes,
        begins.alias("valid_from"),
        F.lit(OPEN_END).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
        "row_hash",
    )
    return survivors.unionByName(opened)


def scd2_merge(
    dim: DataFrame,
    staged: DataFrame,
    business_key: str,
    key: str,
    attributes: Sequence[str],
    load_date: str,
    strict: bool = False,
    first_from: str | None = None,
) -> DataFrame:
    """All versions after a batch; closed history passes through untouched."""
    changes = scd2_changes(dim, staged, business_key, key, attributes, load_date, strict)
    current = scd2_apply(
        dim.where("is_current"), changes, business_key, key, attributes, load_date, first_from
    )
    return dim.where("NOT is_current").unionByName(current.select(*dim.columns))


def scd2_replay(
    history: DataFrame,
    business_key: str,
    moment: str,
    attributes: Sequence[str],
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Versions that one merge per day over a change history would leave behind.

    The last row of each key and day survives (pre-combined before the shuffle); a version
    opens where its hash differs from the day before, and ends where the next one opens.
    Afterwards a key has at most one row per day, however many changes it had.
    """
    daily = pick_first(
        history.withColumn("valid_from", F.to_date(moment)),
        [business_key, "valid_from"],
        [F.col(c).desc_nulls_last() for c in (moment, *tie_break)],
    )
    by_day = Window.partitionBy(business_key).orderBy("valid_from")
    opened = (
        with_hash(daily.select(business_key, "valid_from", *attributes), attributes)
        .withColumn("_previous", F.lag("row_hash").over(by_day))
        .where(F.col("_previous").isNull() | (F.col("_previous") != F.col("row_hash")))
        .drop("_previous")
    )
    following = F.lead("valid_from").over(by_day)
    return opened.withColumn(
        "valid_to", F.coalesce(following, F.lit(OPEN_END).cast("date"))
    ).withColumn("is_current", F.col("valid_to") == F.lit(OPEN_END).cast("date"))
