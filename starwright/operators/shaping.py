"""Schema conformance, incremental filters and batch bounds."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starwright.schemas import default_of, schema


def conform_to_schema(df: DataFrame, table: str, also: Sequence[str] = ()) -> DataFrame:
    """Project ``df`` onto the declared columns of ``table``, and those in ``also``.

    Values are cast (decimals round half up, timestamps lose their time in a DATE column).
    A column that is absent takes its default; a NULL that is present stays NULL.
    """
    return df.selectExpr(
        *also,
        *[
            f"CAST({f.name if f.name in df.columns else default_of(table, f.name)}"
            f" AS {f.dataType.simpleString()}) AS {f.name}"
            for f in schema(table)
        ]
    )


def rename_guarded(df: DataFrame, old: str, new: str) -> DataFrame:
    """Rename a column only if the old name exists and the new one does not."""
    if old in df.columns and new not in df.columns:
        return df.withColumnRenamed(old, new)
    return df


def is_changed_since(
    marks: Sequence[Column], watermark: Column, until: Column | None = None
) -> Column:
    """True when any modification time lies strictly after the watermark, up to ``until``."""
    late = [mark > watermark for mark in marks]
    if until is not None:
        late = [after & (mark <= until) for after, mark in zip(late, marks)]
    return reduce(or_, late)


def changed_since(
    df: DataFrame, marks: Sequence[str], watermark: Column, until: Column | None = None
) -> DataFrame:
    return df.where(is_changed_since([F.col(m) for m in marks], watermark, until))


def next_watermark(df: DataFrame, mark: str = "modified_at") -> DataFrame:
    """One row: number of rows and latest modification time of a batch."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.max(mark).alias("watermark"))


def rows_without(df: DataFrame, column: str) -> int:
    return df.where(F.col(column).isNull()).count()


def date_range(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: first and last day found in any of ``columns``, NULLs skipped."""
    days = [F.col(c).cast("date") for c in columns]
    first = F.least(*days) if len(days) > 1 else days[0]
    last = F.greatest(*days) if len(days) > 1 else days[0]
    return df.agg(F.min(first).alias("first_day"), F.max(last).alias("last_day"))
