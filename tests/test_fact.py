from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from starwright.catalog.queries import _key_properties
from starwright.operators.fact import (
    fact_upsert,
    late_keys,
    lookup_sides,
    moved_marks,
    placed_upsert,
    resolve_fact,
)
from starwright.operators.joins import exact_keys, key_filter, may_meet
from starwright.operators.lookup import lookup_as_of, lookup_current
from starwright.plans.layout import order_month
from starwright.plans.model import BY_NAME, DIMENSIONS, FACT_TABLE
from starwright.plans.star import load_dimension, load_fact
from starwright.schemas import empty_frame, schema
from starwright.session import materialize
from starwright.sources.extracts import SOURCES, mark_column
from tests.test_plans import physical
from tests.tiny import content, frame, tables

VERSIONS = "product_id BIGINT, product_key BIGINT, standard_cost DECIMAL(12,4), valid_from DATE,"
VERSIONS += " valid_to DATE, is_current BOOLEAN"
OPEN = date(9999, 12, 31)


def versions(spark):
    change = date(2024, 2, 1)
    return frame(
        spark, VERSIONS,
        (1, 10, Decimal("2.0000"), date(2024, 1, 1), change, False),
        (1, 11, Decimal("3.0000"), change, OPEN, True),
        (2, 12, Decimal("4.0000"), date(2024, 1, 1), OPEN, True),
    )


def test_current_lookup_never_multiplies(spark):
    twice = versions(spark).withColumn("is_current", F.lit(True))
    lines = frame(spark, "line INT, product_id BIGINT", (1, 1), (2, 2), (3, None), (4, 9))
    found = lookup_current(lines, twice, "product_id", "product_key", {"standard_cost": "cost"})
    assert content(found, "line", "product_key", "cost") == [
        (1, 11, Decimal("3.0000")), (2, 12, Decimal("4.0000")), (3, -1, None), (4, -1, None),
    ]


def test_as_of_lookup_takes_the_version_in_force(spark):
    lines = frame(
        spark, "line INT, product_id BIGINT, order_date DATE",
        (1, 1, date(2024, 1, 31)), (2, 1, date(2024, 2, 1)), (3, 1, date(2023, 12, 31)),
        (4, None, date(2024, 2, 1)), (5, 2, None), (6, 2, date(2030, 1, 1)),
    )
    found = lookup_as_of(lines, versions(spark), "product_id", "order_date", "product_key")
    assert content(found, "line", "product_key") == [
        (1, 10), (2, 11), (3, -1), (4, -1), (5, -1), (6, 12),
    ]


def test_missing_members_and_cost(spark):
    source = tables(spark)
    dims = {s.name: load_dimension(spark, source, s.name, "2024-01-01") for s in DIMENSIONS}
    fact = load_fact(source, dims)
    rows = content(
        fact, "order_line_id", "customer_key", "product_key", "salesperson_key", "standard_cost",
        "discount_amount", "ship_date_key",
    )
    assert rows == [
        (11, 1, 1, 1, Decimal("2.0000"), Decimal("0.0000"), None),
        (12, 1, 2, 1, Decimal("1.0000"), Decimal("0.0000"), None),
        (21, -1, -1, -1, Decimal("0.0000"), Decimal("0.5000"), 20240108),
        (31, 2, 1, 2, Decimal("2.0000"), Decimal("0.0000"), 20240304),
    ]


def unresolved(spark):
    """Staged lines with every key unknown."""
    lines = load_fact(tables(spark), {})
    return lines.withColumns(
        {s.key: F.lit(-1).cast("long") for s in BY_NAME.values()}
        | {"standard_cost": F.lit(0).cast("decimal(14,4)"), "row_number": F.col("order_line_id")}
    )


def test_upsert_keeps_keys_and_is_idempotent(spark):
    lines = unresolved(spark)
    empty = empty_frame(spark, schema(FACT_TABLE))
    first = fact_upsert(empty, lines.where("order_line_id < 20"), mark_column("2024-01-01"))
    changed = lines.where("order_line_id > 11").withColumn("quantity", F.lit(99))
    second = fact_upsert(first, changed, mark_column("2024-02-01"), start=100)
    assert content(second, "order_line_id", "sale_key", "quantity") == [
        (11, 11, 2), (12, 12, 99), (21, 121, 99), (31, 131, 99),
    ]
    again = fact_upsert(second, changed, mark_column("2024-02-01"), start=200)
    assert content(again) == content(second)


def test_as_of_costs_on_the_fact(spark):
    lines = unresolved(spark).drop("product_key", "standard_cost")
    fact = resolve_fact(lines, {"product": versions(spark)}, as_of=True)
    assert content(fact, "order_line_id", "product_key", "standard_cost") == [
        (11, 10, Decimal("2.0000")), (12, 12, Decimal("4.0000")),
        (21, -1, Decimal("0.0000")), (31, 11, Decimal("3.0000")),
    ]


KEYS = "order_line_id long, sale_key long, order_date_key int"


def test_a_placed_upsert_follows_the_rule_in_one_shuffle(spark, conf):
    """Rows that stay in their month, move to another one, are new, or are not in the batch."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    old = frame(spark, KEYS, (1, 5, 20240101), (2, 6, 20240102), (3, 7, 20240201))
    new = frame(spark, KEYS, (1, 11, 20240105), (2, 12, 20240203), (9999, 13, 20240301))
    known = old.where("order_line_id < 3")
    month = F.expr("CAST(order_date_key DIV 100 AS STRING)")
    marks = moved_marks(new, known, month)
    assert content(marks) == [(2, 6, "202401"), (2, 6, "202402")]
    want = [
        (1, 5, 20240105, "202401"), (2, 6, 20240203, "202402"), (3, 7, 20240201, "202402"),
        (9999, 13, 20240301, "202403"),
    ]
    for slices in (1, 3):
        assert content(placed_upsert(old, new, month, slices, marks)) == want
    plan = physical(placed_upsert(old, new, month, 3))
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_old_rows_that_stay_are_not_shuffled(spark, conf):
    """The rule is the same; a filter passes all its keys, and few others."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    old = spark.range(1, 5001).selectExpr(
        "id AS order_line_id", "id + 7 AS sale_key", "CAST(20240101 + id % 3 * 100 AS INT)"
        " AS order_date_key",
    )
    new = frame(spark, KEYS, (3, 9001, 20240301), (4999, 9002, 20240205), (6000, 9003, 20240105))
    known = old.join(new.select("order_line_id"), "order_line_id", "left_semi")
    month = F.expr("CAST(order_date_key DIV 100 AS STRING)")
    marks = moved_marks(new, known, month)
    replaced = key_filter(known, "order_line_id")
    maybe, gone = replaced.split(old, "order_line_id")
    assert known.join(maybe, "order_line_id", "left_anti").isEmpty()
    assert maybe.count() < 50 and maybe.count() + gone.count() == 5000
    placed = placed_upsert(old, new, month, 3, marks, replaced=replaced)
    assert content(placed) == content(placed_upsert(old, new, month, 3, marks))
    plan = physical(placed_upsert(old, new, month, 3, replaced=replaced))
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Union") == 2


def test_a_filter_has_every_key_of_its_table(spark, conf, monkeypatch):
    """Also with more keys than bits, without a key, with texts as keys, and for an empty table."""
    keys = spark.range(0, 90000, 3).selectExpr("concat('SO', id) AS k").union(
        spark.sql("SELECT CAST(NULL AS STRING)"))
    rows = spark.range(90000).selectExpr("concat('SO', id) AS k", "id")
    for most in (1 << 28, 1 << 15):
        monkeypatch.setattr("starwright.operators.joins.MOST_BITS", most)
        maybe, gone = key_filter(keys, "k").split(rows, "k")
        assert gone.where("id % 3 = 0").isEmpty() and maybe.count() + gone.count() == 90000
    assert maybe.count() < 70000
    empty = key_filter(keys.where("k = 'none'"), "k")
    assert empty.may_match(rows, "k").isEmpty()
    assert may_meet(rows, keys.limit(0), "k").count() == 90000


def test_a_filter_passes_few_other_keys(spark):
    """A key sets several bits of one row; a table with few bits for each key sets one."""
    keys = spark.range(0, 10000).select(F.col("id").alias("k"))
    others = spark.range(20000, 120000).select(F.col("id").alias("k"))
    found = key_filter(keys, "k")
    assert found.may_match(others, "k").count() < 3000
    assert found.may_match(keys, "k").count() == 10000


def test_derived_measures_are_not_shuffled(spark):
    """New rows get them where they are written; an old row keeps what it has."""
    shape = "order_line_id BIGINT, sale_key BIGINT, order_date_key INT, quantity INT, twice INT"
    old = frame(spark, shape, (1, 5, 20240105, 3, 7), (2, 6, 20240105, 3, 7))
    new = frame(spark, shape, (2, 9, 20240105, 4, 0), (3, 10, 20240105, None, 0))
    month = F.expr("CAST(order_date_key DIV 100 AS STRING)")
    twice = {"twice": F.col("quantity") * 2}
    merged = placed_upsert(old, new, month, 2, derived=twice)
    assert content(merged, "order_line_id", "sale_key", "twice") == [
        (1, 5, 7), (2, 6, 8), (3, 10, None)
    ]
    only_new = placed_upsert(old.where("false"), new, month, 2, derived=twice)
    assert content(only_new, "order_line_id", "twice") == [(2, 8), (3, None)]


def test_keys_that_occur_again_are_counted(spark):
    rows = frame(spark, KEYS, (1, 5, 1), (2, 5, 1), (3, 7, 1), (4, None, 1))
    shown = _key_properties(rows)
    assert content(shown, "order_line_id", "key_copies", "key_is_positive") == [
        (1, 2, True), (2, 2, True), (3, 1, True)
    ]
    assert "Exchange hashpartitioning" not in physical(shown)


def test_large_lookups_leave_the_wide_lines_alone(spark, conf):
    """Their columns come by natural key and order date; then the fact is that of wide lookups."""
    source = tables(spark)
    dims = {s.name: load_dimension(spark, source, s.name, "2024-01-01") for s in DIMENSIONS}
    staged = SOURCES["order_line"].staged(source)
    lines = staged.withColumns({"sale_key": F.col("order_line_id"),
                                "loaded_at": mark_column("2024-01-01")})
    sides = lookup_sides(dims)
    wide = resolve_fact(lines, dims, sides=sides)
    apart = {name: sides[name] for name in ("customer", "product")}
    near = {name: dim for name, dim in dims.items() if name not in apart}
    empty, month = empty_frame(spark, schema(FACT_TABLE)), order_month()
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    late = late_keys(lines, apart)
    merged = placed_upsert(
        empty, resolve_fact(lines, near, sides=sides), month, 3, late=late
    )
    assert content(merged.drop("part")) == content(wide.select(schema(FACT_TABLE).names))
    old = wide.where("order_line_id < 20").withColumns(
        {"sale_key": F.col("sale_key") + 100, "customer_key": F.lit(9).cast("long")}
    ).select(schema(FACT_TABLE).names)
    again = placed_upsert(old, resolve_fact(lines, near, sides=sides), month, 3, late=late)
    assert content(again, "order_line_id", "sale_key", "customer_key", "standard_cost") == [
        (i, key + 100 if i < 20 else key, customer, cost)
        for i, key, customer, cost in content(
            wide, "order_line_id", "sale_key", "customer_key", "standard_cost")
    ]


def test_a_filter_is_asked_without_making_texts(spark):
    keys = spark.range(0, 500).select(F.col("id").alias("k"))
    asked = key_filter(keys, "k").may_match(spark.range(900).select(F.col("id").alias("k")), "k")
    assert "conv(" not in physical(asked) and "hex(" not in physical(asked)


def test_old_rows_that_go_are_not_shuffled(spark, conf):
    """Marks have their keys; only rows that may go or stay, and new ones, are dealt by part."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    old = materialize(spark.range(1, 5001).selectExpr(
        "id AS order_line_id", "id + 7 AS sale_key", "CAST(20240101 + id % 3 * 100 AS INT)"
        " AS order_date_key",
    ), "old")
    new = spark.range(2500, 6000).selectExpr(
        "id AS order_line_id", "id + 90000 AS sale_key", "CAST(20240101 + id % 4 * 100 AS INT)"
        " AS order_date_key",
    )
    known = materialize(old.where("order_line_id >= 2500"), "known")
    month = F.expr("CAST(order_date_key DIV 100 AS STRING)")
    replaced = exact_keys(old, known, "order_line_id")
    sure, unsure, without = replaced.split(old)
    assert sure.count() > 2000 and sure.where("order_line_id < 2500").isEmpty()
    assert without.where("order_line_id >= 2500").isEmpty()
    assert sure.count() + unsure.count() + without.count() == 5000
    assert content(replaced.matching(old)) == content(known)
    assert content(replaced.others(old)) == content(old.where("order_line_id < 2500"))
    marks = moved_marks(new, known, month, every=True)
    placed = placed_upsert(old, new, month, 3, marks, replaced=replaced)
    plain = placed_upsert(old, new, month, 3, moved_marks(new, known, month))
    assert content(placed) == content(plain) and plain.count() == 5999


def test_an_upsert_beyond_broadcast_shuffles_wide_lines_once(spark, conf):
    """Keys of members and old rows come by row number; lines without a key, and copies, too."""
    source = tables(spark)
    dims = {s.name: load_dimension(spark, source, s.name, "2024-01-01") for s in DIMENSIONS}
    staged = SOURCES["order_line"].staged(source)
    unnamed = staged.where("order_line_id = 21").withColumn(
        "order_line_id", F.lit(None).cast("long"))
    lines = staged.unionByName(staged.where("order_line_id = 12")).unionByName(unnamed)
    lines = materialize(lines.withColumn(
        "row_number", F.expr("CAST(row_number() OVER (ORDER BY order_line_id) AS LONG)")), "lines")
    names = schema(FACT_TABLE).names
    stamp = mark_column("2024-01-02")
    old = resolve_fact(lines, dims).withColumns(
        {"sale_key": F.col("row_number") + 100, "loaded_at": mark_column("2024-01-01")}
    ).where("order_line_id IS NULL OR order_line_id IN (11, 31)").select(names)
    old = materialize(old, "old-fact")
    known = materialize(old.where("order_line_id = 11").select(
        "order_line_id", "sale_key", "order_date_key"), "known")
    want = content(fact_upsert(old, resolve_fact(lines, dims), stamp, known=known))
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    incoming = resolve_fact(lines, dims, row="row_number")
    merged = fact_upsert(old, incoming, stamp, known=known, lines=lines)
    assert content(merged) == want and len(want) == 8
    wide = [line for line in physical(incoming).split("\n")
            if "Exchange hashpartitioning" in line]
    assert sum("(row_number#" in line for line in wide) == 2
    # Of members that are joined apart, only business keys meet the dimension.
    assert physical(incoming).count("ship_date#") > 0 and len(wide) == 2 + 2 * len(DIMENSIONS)
