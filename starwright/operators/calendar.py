"""The calendar dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwright.functions.calendar import DAY_NAMES, MONTH_NAMES, calendar_columns
from starwright.operators.shaping import conform_to_schema, date_range

MOST_DAYS = 200 * 366


def calendar_over(
    bounds: DataFrame,
    day_names: Sequence[str] = DAY_NAMES,
    month_names: Sequence[str] = MONTH_NAMES,
) -> DataFrame:
    """Calendar rows from ``first_day`` to ``last_day`` of a one-row frame.

    More than ``MOST_DAYS`` days are refused: they come from a date that cannot be right, and
    joins broadcast calendars.
    """
    length = F.datediff("last_day", "first_day") + 1
    too_long = F.raise_error(F.concat(
        F.lit("a calendar from "), F.col("first_day").cast("string"), F.lit(" to "),
        F.col("last_day").cast("string"), F.lit(" is too long"),
    )).cast("array<date>")
    every_day = F.when(length > MOST_DAYS, too_long).otherwise(F.sequence("first_day", "last_day"))
    days = bounds.where(F.col("first_day").isNotNull()).select(F.explode(every_day).alias("day"))
    calendar = days.select(calendar_columns(F.col("day"), day_names, month_names))
    return conform_to_schema(calendar, "dw.dim_date")


def calendar_between(spark, first_day: str, last_day: str, **labels) -> DataFrame:
    """Calendar rows of a closed range of days, for example 2005-01-01 to 2030-12-31."""
    bounds = spark.range(1).select(
        F.lit(first_day).cast("date").alias("first_day"),
        F.lit(last_day).cast("date").alias("last_day"),
    )
    return calendar_over(bounds, **labels)


def calendar_for(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Calendar rows that cover every date found in ``columns`` of ``df``."""
    return calendar_over(date_range(df, columns))


def missing_days(calendar: DataFrame, needed: DataFrame) -> DataFrame:
    """Rows of ``needed`` whose day is not yet in ``calendar``."""
    return needed.join(calendar.select("date_key"), "date_key", "left_anti").select(
        *needed.columns
    )


def insert_missing_days(calendar: DataFrame, needed: DataFrame) -> DataFrame:
    """``calendar`` plus the missing days; days already present keep their labels."""
    return calendar.unionByName(missing_days(calendar, needed))
