from datetime import datetime
from decimal import Decimal

import pytest

from starwright.operators.calendar import calendar_for
from starwright.operators.dedup import keep_latest
from starwright.schemas import OPEN_START
from starwright.sources import extracts
from starwright.sources.extracts import SOURCES, Window, order_lines
from starwright.sources.readers import Split, bounds_query, jdbc_tables, split_predicates
from tests.tiny import NEW, OLD, ROWS, content, frame, tables

BETWEEN = datetime(2024, 1, 15)


def staged(spark, name, watermark=None, **changes):
    return SOURCES[name].staged(tables(spark, **changes), watermark or OPEN_START)


def test_customer_names_types_and_first_address(spark):
    rows = content(
        staged(spark, "customer"),
        "customer_id", "customer_name", "customer_type", "city", "country_region",
    )
    assert rows == [
        (1, "Ana Silva", "Individual", "Porto", "Portugal"),
        (2, "Bike World", "Store", None, None),
        (3, "Cliente desconhecido", "Individual", None, None),
        (4, "Bike World", "Store", None, None),
    ]


def test_product_without_subcategory(spark):
    rows = content(staged(spark, "product"), "product_id", "subcategory_name", "category_name")
    assert rows == [(1, "Fasteners", "Parts"), (2, None, None)]


def test_salesperson_changes_with_either_table(spark):
    rows = content(staged(spark, "salesperson", BETWEEN), "employee_id", "full_name",
                   "modified_at")
    assert rows == [(301, "Sam Low", NEW)]


def test_order_line_changes_with_its_header(spark):
    header = [row[:-1] + (NEW,) if row[0] == 1 else row for row in ROWS["order_header"]]
    lines = staged(spark, "order_line", BETWEEN, order_header=header)
    assert content(lines, "order_line_id", "modified_at") == [(11, NEW), (12, NEW)]


def test_line_and_header_may_both_change(spark):
    header = [row[:-1] + (NEW if row[0] < 3 else None,) for row in ROWS["order_header"]]
    detail = [row[:-1] + (NEW if row[1] in (12, 31) else None,) for row in ROWS["order_detail"]]
    changes = {"order_header": header, "order_detail": detail}
    # Later of the two: a missing line time gives the header's, a missing header time none.
    expected = [(11, NEW), (12, NEW), (21, NEW), (31, None)]
    for mark in (BETWEEN, None):
        lines = staged(spark, "order_line", mark, **changes)
        assert content(lines, "order_line_id", "modified_at") == expected


def test_order_line_shares_and_orphans(spark):
    rows = content(staged(spark, "order_line"), "order_line_id", "tax_amount", "freight")
    assert rows == [
        (11, Decimal("1.0000"), Decimal("0.3333")),
        (12, Decimal("2.0000"), Decimal("0.6667")),
        (21, Decimal("0.0000"), Decimal("0.0000")),
        (31, None, None),
    ]


def test_mark_itself_and_null_are_excluded(spark):
    assert content(staged(spark, "customer", OLD)) == []


def test_latest_copy_of_a_key_wins(spark):
    df = frame(
        spark, "k INT, modified_at TIMESTAMP_NTZ, v INT",
        (1, OLD, 9), (1, NEW, 2), (1, NEW, 3), (2, None, 5), (2, OLD, 1),
    )
    kept = keep_latest(df, ["k"], tie_break=["v"])
    assert content(kept, "k", "v") == [(1, 3), (2, 1)]


@pytest.mark.parametrize("values", [
    [None, 3, 3, 5, 9, 9, 9, 12], [None], [], [7, 7], list(range(50)),
    [datetime(2024, 1, 1, 5), None, datetime(2024, 3, 1), datetime(2024, 3, 1, 0, 0, 1)],
])
def test_split_predicates_part_all_rows(spark, values):
    """Every row meets one condition, whatever the shares; those without a value meet one, too."""
    kind = "timestamp_ntz" if any(isinstance(v, datetime) for v in values) else "bigint"
    rows = frame(spark, f"id BIGINT, value {kind}", *enumerate(values))
    for parts in (1, 2, 3, 8):
        split = Split("value", parts)
        rows.createOrReplaceTempView("split_source")
        bounds = spark.sql(bounds_query("SELECT * FROM split_source", "t", split)).collect()
        assert len(bounds) <= parts
        predicates = split_predicates("value", [row.bound for row in bounds])
        assert len(predicates) <= max(1, parts)
        met = [r.id for p in predicates for r in rows.where(p).select("id").collect()]
        assert sorted(met) == list(range(len(values)))


def test_shares_follow_the_rows_not_the_values(spark):
    rows = frame(spark, "value BIGINT", *[(v,) for v in [*range(90), *range(10**9, 10**9 + 10)]])
    rows.createOrReplaceTempView("gaps")
    query = bounds_query("SELECT value FROM gaps", "t", Split("value", 4))
    predicates = split_predicates("value", [row.bound for row in spark.sql(query).collect()])
    assert [rows.where(p).count() for p in predicates] == [25, 25, 25, 25]


def test_texts_in_predicates_are_quoted():
    assert split_predicates("k", ["a", "o'x"]) == ["k < 'o''x' OR k IS NULL", "k >= 'o''x'"]


def test_large_roles_may_be_split(spark):
    queries = {"customer": "SELECT 1"}
    with pytest.raises(ValueError, match="customer needs partitioning"):
        jdbc_tables(spark, {"url": "jdbc:none"}, queries)


def test_calendars_over_a_stray_date_are_refused(spark):
    rows = frame(spark, "day DATE", (OLD.date(),), (datetime(9999, 12, 31).date(),))
    with pytest.raises(Exception, match="is too long"):
        calendar_for(rows, ["day"]).collect()


def test_nothing_is_written_for_a_window_from_the_start(spark, monkeypatch):
    labels = []
    monkeypatch.setattr(
        extracts, "materialize", lambda df, label: labels.append(label) or df
    )
    source = tables(spark)
    every = content(order_lines(source, Window()), "order_line_id")
    assert not labels
    assert content(order_lines(source, Window("1900-01-02")), "order_line_id") == every
    assert sorted(labels) == ["changed-headers", "changed-lines"]
