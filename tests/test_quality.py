from datetime import date

from starwright.operators import quality
from tests.tiny import content, frame

OPEN = date(9999, 12, 31)
DAYS = [date(2024, 1, d) for d in range(1, 5)]


def test_interval_rules(spark):
    dim = frame(
        spark, "k INT, valid_from DATE, valid_to DATE, is_current BOOLEAN",
        (1, DAYS[0], DAYS[1], False), (1, DAYS[1], OPEN, True),     # clean
        (2, DAYS[0], DAYS[2], False), (2, DAYS[1], OPEN, True),     # overlap
        (3, DAYS[0], OPEN, True), (3, DAYS[1], OPEN, True),         # two current, overlap
        (4, DAYS[0], DAYS[1], True),                                # current but closed
    )
    assert content(quality.interval_violations(dim, "k"), "k", "rule") == [
        (2, "overlap"), (3, "overlap"), (3, "several current"), (3, "several current"),
        (4, "current but closed, or open but not current"),
    ]


def test_orphans_allow_null(spark):
    fact = frame(spark, "a BIGINT, b INT", (1, None), (2, 5), (2, 6))
    parent = frame(spark, "k BIGINT", (1,), (5,))
    found = quality.orphan_references(fact, {"a": (parent, "k"), "b": (parent, "k")})
    assert content(found) == [("a", 2, 2), ("b", 6, 1)]


def test_type_and_null_violations(spark):
    rows = frame(
        spark, "territory_key BIGINT, territory_id BIGINT, territory_name STRING",
        (1, None, "x" * 101), (2, 2, "x" * 100),
    )
    assert content(quality.type_violations(rows, "dw.dim_territory")) == [("territory_name", 1)]
    assert content(quality.null_violations(rows, "dw.dim_territory")) == [("territory_id", 1)]


def test_row_counts(spark):
    counts = quality.row_counts({"a": spark.range(3), "b": spark.range(0)})
    assert content(counts) == [("a", 3), ("b", 0)]
