"""Column expressions of the sales model.  All stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(14,4)"

# Separator of the change-detection hash.
HASH_SEPARATOR = "|"


def later_of(first: Column, second: Column) -> Column:
    """The later timestamp; a NULL ``second`` gives NULL, a NULL ``first`` gives ``second``.

    ``greatest`` would skip NULLs, so it is not the same function.
    """
    return F.when(first >= second, first).otherwise(second)


def full_name(first: Column, last: Column) -> Column:
    """First and last name; NULL as soon as one part is NULL."""
    return F.concat(first, F.lit(" "), last)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL on a zero denominator instead of an ANSI error."""
    return numerator / F.nullif(denominator, F.lit(0))


def percent(numerator: Column, denominator: Column) -> Column:
    """100 * ratio, rounded half up to two decimals."""
    return F.round(safe_ratio(F.lit(100) * numerator, denominator), 2)


def allocate_share(amount: Column, line_total: Column, subtotal: Column) -> Column:
    """Share of a header amount that falls on one line, rounded to four decimals.

    Zero when the subtotal is zero, NULL when it is NULL.
    """
    amount, line_total, subtotal = (c.cast(MONEY) for c in (amount, line_total, subtotal))
    share = safe_ratio(amount * line_total, subtotal)
    return F.when(subtotal == 0, F.lit(0).cast(MONEY)).otherwise(share.cast(MONEY))


def discount_amount(unit_price: Column, quantity: Column, rate: Column) -> Column:
    """Price times quantity times discount rate; the INT cast keeps the decimal scale."""
    return (unit_price * quantity.cast("int") * rate).cast(MONEY)


def date_key(day: Column) -> Column:
    """Integer key YYYYMMDD of a date; NULL stays NULL."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def month_of_key(key: Column) -> Column:
    """YYYYMM part of a date key."""
    return F.floor(key / 100).cast("int")


def row_hash(columns: Sequence[Column], strict: bool = False) -> Column:
    """MD5 over attribute texts, used to detect a changed dimension row.

    By default NULL and the empty text hash alike.  ``strict`` prefixes each text with its
    length and marks NULL, so no two different attribute lists share an input text.
    Hash decimals, integers and strings only: the text of a double is engine specific.
    """
    texts = [c.cast("string") for c in columns]
    if strict:
        texts = [
            F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.length(t), F.lit(":"), t))
            for t in texts
        ]
    return F.md5(F.concat_ws(HASH_SEPARATOR, *[F.coalesce(t, F.lit("")) for t in texts]))


def nan_to_null(column: Column) -> Column:
    return F.when(~F.isnan(column), column)


def date_or_null(text: Column) -> Column:
    """Date part of a text; unparseable input gives NULL."""
    return F.to_date(F.try_to_timestamp(text))
