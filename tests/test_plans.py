"""Physical plans that must hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

from starwright.catalog.queries import QUERIES
from starwright.operators.calendar import calendar_for
from starwright.operators.dedup import keep_latest
from starwright.operators.joins import left_join_sparse
from starwright.operators import lookup
from starwright.operators.keys import dense_numbers, stamp_rows
from starwright.operators.lookup import lookup_as_of, lookup_current
from starwright.plans import kpis
from starwright.plans.star import load_fact
from starwright.session import materialize
from starwright.sources.extracts import SOURCES, Window, mark_column, order_lines
from starwright.sources.fixture import SourceTables
from tests.conftest import SMALL
from tests.tiny import content


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def physical(df) -> str:
    return plan_of(df).split("== Physical Plan ==")[1]


KPIS = [n for n in QUERIES if n.startswith("kpi")]


@pytest.mark.parametrize("name", KPIS)
def test_indicators_have_no_cross_join_and_no_python(spark, name):
    plan = physical(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "Python" not in plan and "ArrowEval" not in plan


def test_copies_of_a_key_collapse_before_the_shuffle(spark):
    plan = physical(keep_latest(SourceTables(spark, SMALL)["order_detail"], ["order_line_id"]))
    steps = ("WindowGroupLimit", "Exchange")
    top_down = [line for line in plan.splitlines() if any(step in line for step in steps)]
    assert "Final" in top_down[0] and "Exchange" in top_down[1] and "Partial" in top_down[2]


def test_revenue_by_month_reads_only_what_it_needs(spark):
    source = SourceTables(spark, SMALL)
    days = calendar_for(source["order_header"], ["order_date"])
    plan = physical(kpis.revenue_by_month(load_fact(source, {}), days))
    columns = re.findall(r"ReadSchema: struct<(.*?)>", plan)
    assert not any("l_tax" in c or "o_totalprice" in c or "o_custkey" in c for c in columns)
    # The fact is summed per day before it meets the calendar.
    assert plan.index("BroadcastHashJoin") < plan.rindex("partial_sum(line_total")


def test_the_mark_reaches_the_scan(spark):
    source = SourceTables(spark, SMALL)
    offers = SourceTables(spark, SMALL)["order_detail"].where(
        F.col("modified_at") > mark_column("2000-01-01")
    )
    assert "GreaterThan(l_shipdate" in physical(offers)
    staged = SOURCES["order_line"].staged(source)
    assert "CartesianProduct" not in physical(staged)


def test_a_small_batch_shuffles_neither_large_table(spark, conf):
    # Between the sizes of the changed rows and of the source tables.
    conf("spark.sql.autoBroadcastJoinThreshold", "15KB")
    source = SourceTables(spark, SMALL)
    plan = physical(order_lines(source, Window("2001-10-15")))
    assert plan.count("BroadcastHashJoin") == 2
    assert "Exchange hashpartitioning" not in plan


def test_a_large_batch_shuffles_rows_of_its_orders_only(spark, conf):
    window = Window("2001-10-15")
    want = sorted(map(tuple, order_lines(SourceTables(spark, SMALL), window).collect()), key=repr)
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    lines = order_lines(SourceTables(spark, SMALL), window)
    plan = physical(lines)
    # Only the two filters are broadcast.
    assert plan.count("SortMergeJoin") == 2 and plan.count("BroadcastHashJoin") == 2
    assert plan.count("Exchange hashpartitioning(order_id") == 4
    assert sorted(map(tuple, lines.collect()), key=repr) == want and want


@pytest.fixture()
def no_broadcast(conf):
    conf("spark.sql.shuffle.partitions", "16")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "200KB")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100KB")


def skewed(spark):
    """A third of the rows share one key, a third have none."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(
        F.col("id") % 3 == 2, F.col("id") % 100000
    )
    return spark.range(0, 1_000_000, 1, 8).select(
        "id", key.cast("long").alias("customer_id"), F.rand(1).alias("amount")
    )


def test_a_hot_key_is_split_in_a_lookup(spark, no_broadcast):
    dim = spark.range(100000).select(
        F.col("id").alias("customer_id"), (F.col("id") + 1).alias("customer_key"),
        F.lit(True).alias("is_current"),
    )
    found = lookup_current(skewed(spark), dim, "customer_id", "customer_key")
    counted = found.groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount")
    )
    by_key = {r.customer_key: r.n for r in counted.where("customer_key IN (-1, 8)").collect()}
    assert by_key[-1] == 333333 and by_key[8] > 333333
    counted.collect()
    assert "SortMergeJoin(skew=true)" in plan_of(counted)


def test_rows_without_a_key_spread_over_tasks(spark, no_broadcast):
    side = spark.range(100000).select(F.col("id").alias("customer_id")).groupBy(
        "customer_id"
    ).agg(F.max("customer_id").alias("found"))
    joined = left_join_sparse(skewed(spark), side, "customer_id", "id")
    matched = joined.agg(F.count("found"), F.count(F.lit(1)))
    assert content(matched) == [(666667, 1_000_000)]
    assert re.search(r"hashpartitioning\(customer_id#\d+L, _spread#\d+L", physical(joined))


def test_order_lines_are_shuffled_once(spark, no_broadcast):
    """The join leaves lines by order, and copies of a line are found where it left them."""
    plan = physical(SOURCES["order_line"].staged(SourceTables(spark, SMALL)))
    assert "Window [row_number" in plan
    above, joins = plan.split("Union", 1)
    assert "Exchange" not in above
    for branch in joins.split("SortMergeJoin")[1:]:
        assert branch.count("Exchange hashpartitioning(order_id") == 2


def test_a_first_window_shuffles_headers_alike_in_both_branches(spark, no_broadcast):
    """Then one shuffle serves both; a filter below one of the joins would tell them apart."""
    plan = physical(SOURCES["order_line"].staged(SourceTables(spark, SMALL)))
    pushed = re.findall(r"PushedFilters: \[[^\]]*o_order[^\]]*\]", plan)
    assert len(pushed) == 2 and pushed[0] == pushed[1]


def test_numbering_has_the_same_plan_for_any_number_of_partitions(spark):
    def size(partitions):
        rows = spark.range(0, 2000, 1, partitions).select("id")
        written = stage_rows(rows)
        numbered = dense_numbers(written, "number", 5)
        values = [r.number for r in numbered.collect()]
        assert sorted(values) == list(range(6, 2006))
        return len(re.sub(r"#\d+L?|/[^, ]*|\d+", "", physical(numbered)))

    assert size(200) < size(2) * 1.2


def stage_rows(rows):
    return materialize(stamp_rows(rows), "plan-test")


def test_versions_in_force_need_no_range_join(spark):
    versions = spark.createDataFrame(
        [(1, "2024-01-01", "2024-02-01", 1, "a"), (1, "2024-02-01", "9999-12-31", 2, "b"),
         (1, "2024-03-01", "2024-03-01", 3, "empty"), (2, "2024-05-01", "2024-06-01", 4, "c")],
        "bk long, valid_from string, valid_to string, k long, label string",
    ).selectExpr("bk", "CAST(valid_from AS DATE) valid_from", "CAST(valid_to AS DATE) valid_to",
                 "k", "label")
    asked = spark.createDataFrame(
        [(1, 1, "2023-12-31"), (2, 1, "2024-01-01"), (3, 1, "2024-01-31"), (4, 1, "2024-02-01"),
         (5, 1, "2024-03-01"), (6, 2, "2024-06-01"), (7, 2, "2024-05-31"), (8, 3, "2024-01-01"),
         (9, None, "2024-01-01"), (10, 1, None), (11, 1, "2024-02-01")],
        "id long, bk long, day string",
    ).selectExpr("id", "bk", "CAST(day AS DATE) day")
    found = lookup_as_of(asked, versions, "bk", "day", "k", {"label": "found"})
    assert sorted((r.id, r.k, r.found) for r in found.collect()) == [
        (1, -1, None), (2, 1, "a"), (3, 1, "a"), (4, 2, "b"), (5, 2, "b"), (6, -1, None),
        (7, 4, "c"), (8, -1, None), (9, -1, None), (10, -1, None), (11, 2, "b"),
    ]


def test_the_search_for_versions_in_force_is_linear(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(
        lookup, "materialize", lambda df, label: plans.append(physical(df)) or df
    )
    versions = spark.range(5).selectExpr(
        "id bk", "DATE '2024-01-01' valid_from", "DATE '9999-12-31' valid_to", "id k")
    asked = spark.range(5).selectExpr("id bk", "DATE '2024-01-01' day")
    assert lookup_as_of(asked, versions, "bk", "day", "k").count() == 5
    (plan,) = plans
    assert "Window" in plan and "Join" not in plan
