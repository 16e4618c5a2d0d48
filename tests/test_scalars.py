from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starwright.functions import calendar, scalars
from starwright.operators.calendar import calendar_between, calendar_for, insert_missing_days
from starwright.operators.shaping import (
    changed_since,
    conform_to_schema,
    date_range,
    next_watermark,
    rename_guarded,
)
from starwright.sources.extracts import mark_column
from tests.tiny import content, frame

EARLY, LATE = datetime(2024, 1, 1), datetime(2024, 1, 2)


def value(df, column):
    return df.select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "first, second, expected",
    [(EARLY, LATE, LATE), (LATE, EARLY, LATE), (EARLY, None, None), (None, LATE, LATE)],
)
def test_later_of_is_not_greatest(spark, first, second, expected):
    df = frame(spark, "a TIMESTAMP_NTZ, b TIMESTAMP_NTZ", (first, second))
    assert value(df, scalars.later_of(F.col("a"), F.col("b"))) == expected


def test_full_name_propagates_null(spark):
    df = frame(spark, "a STRING, b STRING", ("Ana", None))
    assert value(df, scalars.full_name(F.col("a"), F.col("b"))) is None


@pytest.mark.parametrize(
    "subtotal, expected",
    [("30", Decimal("1.6667")), ("0", Decimal("0.0000")), (None, None)],
)
def test_allocate_share(spark, subtotal, expected):
    df = frame(spark, "s STRING", (subtotal,))
    share = scalars.allocate_share(F.lit(5), F.lit(10), F.col("s").cast("decimal(14,4)"))
    assert value(df, share) == expected


def test_shares_add_up_to_the_header(spark):
    df = spark.range(1, 8).select((F.col("id") * 10).cast("decimal(14,4)").alias("line"))
    total = F.lit(280).cast("decimal(14,4)")
    shared = df.select(scalars.allocate_share(F.lit("99.99"), F.col("line"), total).alias("s"))
    assert abs(shared.agg(F.sum("s")).first()[0] - Decimal("99.99")) < Decimal("0.001")


def test_percent_of_zero_is_null(spark):
    df = frame(spark, "a INT, b INT", (5, 0))
    assert value(df, scalars.percent(F.col("a"), F.col("b"))) is None


def test_discount_amount_keeps_scale(spark):
    df = frame(spark, "q BIGINT", (3,))
    price, rate = (F.lit(x).cast("decimal(12,4)") for x in ("1.2345", "0.1"))
    assert value(df, scalars.discount_amount(price, F.col("q"), rate)) == Decimal("0.3704")


def test_date_key(spark):
    df = frame(spark, "d DATE", (date(2024, 3, 9),), (None,))
    assert content(df.select(scalars.date_key(F.col("d")))) == [(20240309,), (None,)]


def test_row_hash_treats_null_as_empty_unless_strict(spark):
    df = frame(spark, "a STRING, b STRING", ("a|", "b"), ("a", "|b"), ("", None), (None, ""))
    columns = [F.col("a"), F.col("b")]
    loose = {r[0] for r in df.select(scalars.row_hash(columns)).collect()}
    strict = {r[0] for r in df.select(scalars.row_hash(columns, strict=True)).collect()}
    assert (len(loose), len(strict)) == (2, 4)


def test_nan_becomes_null(spark):
    df = frame(spark, "x DOUBLE", (float("nan"),), (1.5,), (None,))
    assert content(df.select(scalars.nan_to_null(F.col("x")))) == [(1.5,), (None,), (None,)]


def test_unparseable_dates_become_null(spark):
    df = frame(spark, "t STRING", ("2024-02-30",), ("junk",), ("2024-02-29 10:00:00",))
    parsed = {r[0] for r in df.select(scalars.date_or_null(F.col("t"))).collect()}
    assert parsed == {None, date(2024, 2, 29)}


def test_calendar_attributes(spark):
    days = {r.date_key: r for r in calendar_between(spark, "2024-06-30", "2024-07-01").collect()}
    june, july = days[20240630], days[20240701]
    assert (june.day_name, june.day_of_week, june.is_weekend) == ("Domingo", 7, True)
    assert (june.fiscal_year, june.fiscal_quarter) == (2024, 4)
    assert (july.month_name, july.quarter) == ("Julho", 3)
    assert (july.fiscal_year, july.fiscal_quarter) == (2025, 1)


def test_default_calendar_has_every_day(spark):
    years = calendar_between(spark, "2005-01-01", "2030-12-31")
    assert years.count() == 9496
    wrong = years.where(
        (F.col("fiscal_year") != F.col("year") + (F.col("month_number") >= 7).cast("int"))
        | (F.col("fiscal_quarter") != F.pmod(F.col("quarter") + 1, F.lit(4)) + 1)
    )
    assert wrong.isEmpty()


def test_calendar_is_extended_not_relabelled(spark):
    dates = frame(
        spark, "a DATE, b DATE", (date(2024, 1, 1), None), (date(2024, 1, 4), date(2024, 1, 2))
    )
    present = calendar_between(spark, "2024-01-01", "2024-01-02", day_names=["x"] * 7)
    full = insert_missing_days(present, calendar_for(dates, ["a", "b"]))
    assert content(full, "date_key", "day_name") == [
        (20240101, "x"), (20240102, "x"), (20240103, "Quarta-feira"), (20240104, "Quinta-feira"),
    ]


def test_no_dates_give_no_calendar(spark):
    assert calendar_for(frame(spark, "a DATE", (None,)), ["a"]).isEmpty()
    assert tuple(date_range(frame(spark, "a DATE", (None,)), ["a"]).first()) == (None, None)


def test_label_positions_count_from_one(spark):
    df = frame(spark, "n INT", (1,), (7,))
    labels = df.select(calendar.label(calendar.DAY_NAMES, F.col("n")))
    assert content(labels) == [("Domingo",), ("Segunda-feira",)]


def test_conform_rounds_truncates_and_fills(spark):
    raw = frame(
        spark, "order_line_id INT, order_date TIMESTAMP_NTZ, line_total DOUBLE, junk INT",
        (1, datetime(2024, 1, 5, 23, 59), 1.00005, 9),
    )
    row = conform_to_schema(raw, "stg.order_line").first()
    assert (row.order_date, row.line_total) == (date(2024, 1, 5), Decimal("1.0001"))
    assert row.customer_id is None and "junk" not in row


def test_defaults_fill_absent_columns_only(spark):
    raw = frame(spark, "customer_id INT, valid_from DATE", (1, None))
    row = conform_to_schema(raw, "dw.dim_customer").first()
    assert row.valid_from is None
    assert (row.valid_to, row.is_current) == (date(9999, 12, 31), True)


def test_rename_needs_old_and_lacks_new(spark):
    old = frame(spark, "person_name STRING", ("x",))
    assert rename_guarded(old, "person_name", "customer_name").columns == ["customer_name"]
    both = old.withColumn("customer_name", F.lit("y"))
    assert rename_guarded(both, "person_name", "customer_name").columns == both.columns


def test_incremental_filter_is_strict(spark):
    df = frame(spark, "k INT, modified_at TIMESTAMP_NTZ", (1, EARLY), (2, LATE), (3, None))
    newer = changed_since(df, ["modified_at"], mark_column(EARLY))
    assert content(newer, "k") == [(2,)]
    assert tuple(next_watermark(df).first()) == (3, LATE)
