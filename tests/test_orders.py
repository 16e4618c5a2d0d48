"""Totals by order: against plain sums, and kept up to date by differences."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from starwright.operators.joins import key_filter
from starwright.operators.orders import (
    add_up,
    add_up_placed,
    changed_orders,
    line_shares,
    order_groups,
    orders_after,
    order_totals,
    orders_upsert,
)
from starwright.plans import kpis, layout, pipeline
from starwright.plans.model import FACT_TABLE, ORDERS_TABLE
from starwright.schemas import schema
from starwright.session import materialize
from starwright.sources.store import TableStore
from tests.test_pipeline import assert_totals, load
from tests.test_plans import physical
from tests.test_store import SOUND, moved_orders
from tests.tiny import ROWS, content

LINES = ("order_line_id long, order_number string, order_date_key int, territory_key long,"
         " salesperson_key long, line_total decimal(14,4)")


def some_lines(seed, n=400):
    """Lines of few orders, of which one has a third of all and some have several groups."""
    pick = random.Random(seed)
    return [
        (i, "SO1" if pick.random() < 0.33 else pick.choice(["", "X", "SO-7é"])
         if pick.random() < 0.1 else f"SO{pick.randrange(60)}",
         20240101 + pick.randrange(3), pick.randrange(2), pick.choice([-1, 1, 2, 3]),
         pick.choice([0, 5, 7]))
        for i in range(n)
    ]


def frame(spark, rows):
    lines = spark.createDataFrame(rows, LINES.replace("decimal(14,4)", "long"))
    return lines.withColumn("line_total", F.col("line_total").cast("decimal(14,4)"))


def plain(rows):
    groups = {}
    for _, order, day, territory, person, total in rows:
        count, revenue = groups.get((order, day, territory, person), (0, 0))
        groups[order, day, territory, person] = (count + 1, revenue + total)
    return sorted((*key, *value) for key, value in groups.items())


def flat(orders):
    rows = order_groups(orders).drop("other_groups").collect()
    return sorted(tuple(row) for row in rows)


def test_totals_equal_plain_sums(spark):
    rows = some_lines(1)
    orders = order_totals(frame(spark, rows))
    assert flat(orders) == plain(rows)
    assert orders.count() == len({row[1] for row in rows})
    assert order_totals(frame(spark, [])).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_differences_lead_to_the_same_totals(spark, seed):
    """Lines that change, move to another order, or leave an order empty."""
    before, pick = some_lines(seed), random.Random(seed)
    after = {row[0]: row for row in before}
    touched = pick.sample(sorted(after), 120)
    for i, row in zip(touched, some_lines(seed + 50, 120)):
        after[i] = (i, *row[1:])
    gone = before[5][1]
    for i, row in list(after.items()):
        if row[1] == gone:
            after[i] = (i, "SO999", *row[2:])
            touched.append(i)
    old = [row for row in before if row[0] in touched]
    new = [after[i] for i in set(touched)]
    changes = line_shares(frame(spark, new)).unionByName(line_shares(frame(spark, old), -1))
    orders = order_totals(frame(spark, before))
    changed = changed_orders(orders, changes)
    assert changed.where(F.col("order_number") == gone).first().groups == []
    result = orders_upsert(orders, changed)
    assert flat(result) == plain(after.values())
    assert result.where(F.col("order_number") == gone).isEmpty()


def test_a_line_adds_an_amount_of_fixed_width(spark):
    """Beyond 18 digits a decimal takes more than twice the bytes of a shuffled row."""
    rows = spark.sql("""SELECT 'SO1' AS order_number, 20240101 AS order_date_key, 1L AS territory_key,
        2L AS salesperson_key, CAST(9999999999.9999 AS DECIMAL(14,4)) AS line_total""")
    for sign in (1, -1):
        share = line_shares(rows, sign)
        assert share.schema["revenue"].dataType.precision <= 18
        assert str(share.first().revenue) == f"{sign * 9999999999.9999:.4f}"



def test_numbers_of_orders_equal_distinct_counts(spark):
    """Several keys share a label, and orders have several groups."""
    rows = some_lines(9)
    fact = frame(spark, rows)
    people = spark.createDataFrame(
        [(-1, "Unknown", None), (1, "Ann", "Rep"), (2, "Ann", "Rep"), (3, None, None)],
        "salesperson_key long, full_name string, job_title string")
    places = spark.createDataFrame(
        [(0, "G", "North"), (1, "G", "North")],
        "territory_key long, territory_group string, territory_name string")
    days = spark.createDataFrame(
        [(20240101, 2024), (20240102, 2024), (20240103, 2025)], "date_key int, year int")
    orders = order_totals(fact)
    wanted = fact.where("salesperson_key <> -1").join(people, "salesperson_key").groupBy(
        "full_name", "job_title"
    ).agg(F.count_distinct("order_number").alias("n"), F.sum("line_total").alias("total"))
    assert content(kpis.salesperson_performance(orders, people), "full_name", "total_revenue",
                   "order_count") == content(
        wanted, "full_name", F.round("total", 2), "n")
    assert content(kpis.sales_by_territory(orders, places), "territory_name", "order_count") == [
        ("North", len({row[1] for row in rows}))
    ]
    ticket = fact.join(days, F.col("order_date_key") == F.col("date_key")).groupBy("year").agg(
        F.round(F.sum("line_total") / F.count_distinct("order_number"), 2).alias("ticket"))
    assert content(kpis.average_ticket(orders, days)) == content(ticket)


def test_stored_totals_follow_deltas_and_folding(spark, store, monkeypatch):
    monkeypatch.setattr(layout, "ORDER_RANGE", 2)
    monkeypatch.setattr(pipeline, "FOLD_SHARE", 100)
    load(spark, store, changes=SOUND)
    assert_totals(store)
    base = dict(store.live_parts(ORDERS_TABLE))
    assert len(base) > 1
    for changes, day in zip(moved_orders(), (datetime(2024, 2, 2), datetime(2024, 2, 3))):
        load(spark, store, day, changes, merge_on_read=True, check=True)
        assert_totals(store)
    live = store.live_parts(ORDERS_TABLE)
    assert {p: live[p] for p in base} == base and len(store.deltas(ORDERS_TABLE)) == 2
    assert_totals(TableStore(spark, store.root))
    pipeline.fold_deltas(store, always=True)
    assert not store.deltas(ORDERS_TABLE)
    assert_totals(store)


def test_a_batch_rewrites_the_ranges_of_its_orders(spark, store, monkeypatch):
    monkeypatch.setattr(layout, "ORDER_RANGE", 1)
    load(spark, store)
    before = dict(store.live_parts(ORDERS_TABLE))
    detail = [
        row[:5] + (7,) + row[6:9] + (datetime(2024, 1, 20),) if row[1] == 12 else row
        for row in ROWS["order_detail"]
    ]
    load(spark, store, datetime(2024, 1, 21), {"order_detail": detail})
    after = store.live_parts(ORDERS_TABLE)
    assert sum(after[part] != path for part, path in before.items()) == 1
    assert_totals(store)


def test_a_fact_without_totals_gets_them(spark, store):
    load(spark, store)
    gone = [(ORDERS_TABLE, part, 99, None, None) for part in store.live_parts(ORDERS_TABLE)]
    store.publish(gone)
    assert not store.live_parts(ORDERS_TABLE)
    load(spark, store, datetime(2024, 1, 21), full_load=True)
    assert_totals(store)


def test_lines_without_an_order_number_are_refused(spark, store):
    header = [(row[0], None, *row[2:]) if row[0] == 1 else row for row in ROWS["order_header"]]
    with pytest.raises(ValueError, match="2 rows of stg.order_line have no order_number"):
        load(spark, store, changes={"order_header": header})
    assert not store.live_parts(FACT_TABLE)


def test_indicators_count_rows_of_the_stored_totals(spark, store):
    load(spark, store)
    orders = store.read(ORDERS_TABLE)
    for report in (
        kpis.average_ticket(orders, store.read("dw.dim_date")),
        kpis.sales_by_territory(orders, store.read("dw.dim_territory")),
        kpis.salesperson_performance(orders, store.read("dw.dim_salesperson")),
    ):
        plan = physical(report)
        assert "distinct" not in plan and "Expand" not in plan and "fact_sales" not in plan


def test_totals_lie_by_part_where_they_are_added_up(spark):
    """The same totals as without parts, and none for an order that has lost its lines."""
    rows, part = some_lines(4), F.expr("right(order_number, 1)")
    placed = add_up(line_shares(frame(spark, rows)), part)
    assert flat(placed.drop("part")) == plain(rows)
    assert placed.where(F.col("part") != part).isEmpty()
    gone = rows[0][1]
    lost = line_shares(frame(spark, [row for row in rows if row[1] == gone]), -1)
    after = orders_after(placed.drop("part"), lost, part)
    assert flat(after.drop("part")) == plain([row for row in rows if row[1] != gone])
    # Two shuffles: of sums by group, and of groups by part.  None is left for the write.
    assert physical(placed).count("Exchange hashpartitioning") == 2


def test_stored_totals_are_shuffled_once(spark):
    """The same totals in one shuffle; an order with a third of all lines and several groups too."""
    rows, part = some_lines(6), F.expr("right(order_number, 1)")
    placed = add_up_placed(line_shares(frame(spark, rows)), part)
    assert flat(placed.drop("part")) == plain(rows)
    assert placed.where(F.col("part") != part).isEmpty()
    assert physical(placed).count("Exchange") == 1
    after = orders_after(placed.drop("part"), line_shares(frame(spark, rows[:9]), -1), part)
    assert flat(after.drop("part")) == plain(rows[9:])
    assert physical(orders_after(frame_of_orders(spark), line_shares(frame(spark, rows)), part)
                    ).count("Exchange") == 1


def test_totals_of_other_orders_are_not_shuffled(spark):
    rows, part = some_lines(6), F.expr("right(order_number, 1)")
    orders = add_up_placed(line_shares(frame(spark, rows)), part).drop("part")
    lost = line_shares(frame(spark, rows[:9]), -1)
    after = orders_after(orders, lost, part, key_filter(lost, "order_number"))
    assert flat(after.drop("part")) == plain(rows[9:])
    assert after.where(F.col("part") != part).isEmpty()
    stored = materialize(orders, "totals")
    plan = physical(orders_after(stored, lost, part, key_filter(lost, "order_number")))
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Union") == 2


def frame_of_orders(spark):
    return spark.createDataFrame([], schema(ORDERS_TABLE))


def test_orders_meet_their_changes_in_one_shuffle(spark, conf):
    """What a delta of totals holds: the changed orders alone, also where a filter passes others."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = some_lines(7)
    orders = materialize(order_totals(frame(spark, rows)), "totals")
    lost = line_shares(frame(spark, rows[:9]), -1)
    concerned = {row[1] for row in rows[:9]}
    changed = changed_orders(orders, lost, key_filter(lost, "order_number"))
    assert {row.order_number for row in changed.collect()} == concerned
    assert content(changed) == content(changed_orders(orders, lost))
    assert flat(orders_upsert(orders, changed)) == plain(rows[9:])
    assert physical(changed_orders(orders, lost)).count("Exchange") == 1
