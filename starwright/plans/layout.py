"""Which part of a stored table a row lies in, and which parts a batch needs.

Type 2 dimensions keep current versions by ranges of the business key (``current-RANGE``), and
closed ones in pieces by range and by the year in which they end (``closed.RANGE.YEAR.VERSION``).
The index of fact keys lies in ranges of the natural key, the fact itself in order months, and
its totals by order in ranges of the order's number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starwright.functions.scalars import month_of_key
from starwright.plans.model import (
    KEY_RANGE,
    MEMBER_RANGE,
    NATURAL_KEY,
    ORDER_KEY,
    ORDER_RANGE,
    DimensionSpec,
)
from starwright.sources.store import TableStore

CURRENT, CLOSED = "current", "closed"
#: Parts of orders whose name does not end with a number.
OTHER_RANGES = 64


def current_parts(store: TableStore, spec: DimensionSpec) -> list[str] | None:
    """The parts with current versions; None, for all, of a table without history."""
    if spec.scd_type == 1:
        return None
    return [part for part in store.live_parts(spec.table) if part.startswith(CURRENT)]


def range_number(business_key: str) -> Column:
    return F.floor(F.col(business_key) / F.lit(MEMBER_RANGE)).cast("string")


def member_range(business_key: str) -> Column:
    """The part of a type 2 dimension that a member's current version belongs to."""
    return F.concat(F.lit(f"{CURRENT}-"), range_number(business_key))


def closed_piece(business_key: str, version: int) -> Column:
    """The part that a version belongs to which a load has closed."""
    return F.concat_ws(
        ".", F.lit(CLOSED), range_number(business_key), F.year("valid_to"), F.lit(version)
    )


def as_of_parts(
    store: TableStore, spec: DimensionSpec, staged: DataFrame, day: str = "order_date"
) -> list[str] | None:
    """Parts that may hold a version in force for a batch: its members, from its first day on.

    A version in force on a day ends after it, so closed versions of earlier years are left out.
    """
    if spec.scd_type == 1:
        return None
    asked = staged.groupBy(range_number(spec.business_key).alias("range")).agg(
        F.min(F.year(day)).alias("year")
    )
    first = {row.range: row.year for row in asked.collect() if None not in row}
    parts = []
    for part in store.live_parts(spec.table):
        if part.startswith(CURRENT):
            in_force = part.removeprefix(f"{CURRENT}-") in first
        else:
            _, number, year, _ = part.split(".")
            in_force = number in first and int(year) >= first[number]
        if in_force:
            parts.append(part)
    return parts


def range_of(part: str) -> str:
    """The range of members that a part of a type 2 dimension belongs to."""
    if part.startswith(CURRENT):
        return part.removeprefix(f"{CURRENT}-")
    return part.split(".")[1]


def order_month() -> Column:
    """The part of the fact that an order line belongs to."""
    return month_of_key(F.col("order_date_key")).cast("string")


def key_range() -> Column:
    """The part of the key index that a natural key belongs to."""
    return F.floor(F.col(NATURAL_KEY) / F.lit(KEY_RANGE)).cast("string")


def order_range() -> Column:
    """The part of the totals by order that an order belongs to.

    Names that end with a number go by its range, others by hash.
    """
    number = F.regexp_extract(ORDER_KEY, "([0-9]{1,18})$", 1).try_cast("long")
    other = F.concat(F.lit("other-"), F.pmod(F.xxhash64(ORDER_KEY), F.lit(OTHER_RANGES)))
    return F.coalesce(F.floor(number / F.lit(ORDER_RANGE)).cast("string"), other)
