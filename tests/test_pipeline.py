from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import starwright.__main__ as command
from starwright.catalog.queries import QUERIES
from starwright.operators import quality
from starwright.operators.orders import order_totals
from starwright.plans import kpis, layout, pipeline
from starwright.plans.control import Control
from starwright.plans.model import (
    BY_NAME,
    DATE_ROLES,
    DIMENSIONS,
    FACT_KEYS_TABLE,
    FACT_TABLE,
    ORDERS_TABLE,
)
from starwright.plans.pipeline import run
from starwright.plans.star import load_star
from starwright.session import names_in
from starwright.sources import store as store_module
from starwright.sources.readers import jdbc_tables
from starwright.sources.store import TableStore
from tests.conftest import SMALL
from tests.tiny import NEW, ROWS, content, tables

FIRST_DAY, SECOND_DAY = datetime(2024, 1, 11), datetime(2024, 1, 21)


def load(spark, store, day=FIRST_DAY, changes=None, **options):
    source = tables(spark, **(changes or {}))
    return run(spark, source, store, day.date().isoformat(), day, **options)


def later_changes():
    """A new quantity on one line, a renamed territory, a new city label, a moved order."""
    detail = [
        row[:5] + (7,) + row[6:9] + (NEW,) if row[1] == 12 else row
        for row in ROWS["order_detail"]
    ]
    header = [
        row[:2] + (datetime(2024, 5, 1),) + row[3:-1] + (NEW,) if row[0] == 3 else row
        for row in ROWS["order_header"]
    ]
    customer = [(1, None, 201, NEW)] + ROWS["customer"][1:]
    territory = [(1, "Far North", "PT", "Europe", NEW)]
    return {"order_detail": detail, "order_header": header, "customer": customer,
            "territory": territory}


def test_life_of_a_warehouse(spark, store):
    first = load(spark, store)
    assert first.applied == {"customer": 4, "product": 2, "salesperson": 2, "territory": 1,
                             "promotion": 1, "ship_method": 1, "order_line": 4}
    assert_clean(store)
    assert_indicators(spark, store)
    keys = dict(content(store.read(FACT_TABLE), "order_line_id", "sale_key"))
    before = {s.table: content(store.read(s.table)) for s in DIMENSIONS}
    fact = content(store.read(FACT_TABLE).drop("loaded_at"))

    # Nothing new: staging is emptied, nothing is loaded.
    version = store.version(FACT_TABLE)
    idle = load(spark, store, SECOND_DAY)
    assert idle.applied == {} and set(idle.staged.values()) == {0}
    assert store.version(FACT_TABLE) == version
    assert store.read("stg.customer").isEmpty()

    # A full reload changes nothing but the load time.
    assert_totals(store)
    load(spark, store, SECOND_DAY, full_load=True)
    assert {s.table: content(store.read(s.table)) for s in DIMENSIONS} == before
    assert content(store.read(FACT_TABLE).drop("loaded_at")) == fact

    # Changes: new versions, an overwritten name, a line that moves to another month.
    third_day = datetime(2024, 1, 22)
    changed = load(spark, store, third_day, later_changes())
    assert changed.staged == {"customer": 1, "product": 0, "salesperson": 0, "territory": 1,
                              "promotion": 0, "ship_method": 0, "order_line": 2}
    fact = store.read(FACT_TABLE)
    assert dict(content(fact, "order_line_id", "sale_key")) == keys
    assert content(fact, "order_line_id", "quantity", "order_date_key", "customer_key",
                   "loaded_at") == [
        (11, 2, 20240105, 1, SECOND_DAY),
        (12, 7, 20240105, 5, third_day),
        (21, 1, 20240105, -1, SECOND_DAY),
        (31, 1, 20240501, 2, third_day),
    ]
    # The month the order left is empty now, so it is no longer a part of the table.
    assert sorted(store.live_parts(FACT_TABLE)) == ["202401", "202405"]
    assert content(store.read("dw.dim_territory"), "territory_key", "territory_name") == [
        (-1, "Desconhecido"), (1, "Far North"),
    ]
    assert sorted(store.live_parts("dw.dim_customer")) == [
        "closed.0.2024.3", "current--1", "current-0",
    ]
    assert_clean(store)
    assert_totals(store)


def test_a_load_without_broadcasts_gives_the_same_warehouse(spark, store, conf, monkeypatch):
    """A new store, then a batch that replaces and moves lines; no wide line meets a dimension."""
    other = TableStore(spark, f"{store.root}-other")
    load(spark, other)
    load(spark, other, SECOND_DAY, later_changes())
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    wide, resolve = [], pipeline.resolve_fact

    def watched(staged, dims, *given):
        wide.append(sorted(dims))
        return resolve(staged, dims, *given)

    monkeypatch.setattr(pipeline, "resolve_fact", watched)
    load(spark, store)
    load(spark, store, SECOND_DAY, later_changes())
    assert wide == [[], [], ["salesperson", "territory"]]
    for table in (FACT_TABLE, FACT_KEYS_TABLE, ORDERS_TABLE):
        key = "sale_key"
        rows = [store.read(table), other.read(table)]
        rows = [r.drop(key) for r in rows]
        assert content(rows[0]) == content(rows[1])
    assert_clean(store)
    assert_totals(store)


def assert_totals(store):
    """Stored totals by order are those of the stored fact; orders without lines are none."""
    kept = store.read(ORDERS_TABLE).where(F.size("groups") > 0)
    assert content(kept) == content(order_totals(store.read(FACT_TABLE)))


def assert_clean(store):
    fact = store.read(FACT_TABLE)
    calendar = store.read("dw.dim_date")
    parents = {k: (calendar, "date_key") for k in DATE_ROLES.values()}
    for spec in DIMENSIONS:
        dim = store.read(spec.table)
        parents[spec.key] = (dim, spec.key)
        unique = [spec.business_key] + (["valid_from"] if spec.scd_type == 2 else [])
        assert quality.duplicate_keys(dim, unique).isEmpty()
        assert quality.null_violations(dim, spec.table).isEmpty()
        assert quality.type_violations(dim, spec.table).isEmpty()
        if spec.scd_type == 2:
            assert quality.interval_violations(dim, spec.business_key).isEmpty()
    assert quality.orphan_references(fact, parents).isEmpty()
    assert quality.duplicate_keys(fact, ["order_line_id"]).isEmpty()
    assert quality.duplicate_keys(fact, ["sale_key"]).isEmpty()


def assert_indicators(spark, store):
    """The stored star and the lazy one give the same indicators."""
    source = tables(spark)
    fact, dims = load_star(spark, source, BY_NAME, FIRST_DAY.date().isoformat())
    stored, days = store.read(FACT_TABLE), store.read("dw.dim_date")
    territory = store.read("dw.dim_territory")
    for indicator, name in (
        (kpis.margin_by_category, "product"), (kpis.top_products, "product"),
    ):
        dim = store.read(BY_NAME[name].table)
        assert content(indicator(stored, dim)) == content(indicator(fact, dims[name]))
    for indicator in (kpis.revenue_by_month, kpis.items_by_quarter,
                      kpis.discount_rate, kpis.month_over_month_growth):
        assert content(indicator(stored, days)) == content(indicator(fact, days))
    orders, lazy = store.read(ORDERS_TABLE), order_totals(fact)
    for indicator, name in (
        (kpis.sales_by_territory, "territory"), (kpis.salesperson_performance, "salesperson"),
    ):
        dim = store.read(BY_NAME[name].table)
        assert content(indicator(orders, dim)) == content(indicator(lazy, dims[name]))
    assert content(kpis.average_ticket(orders, days)) == content(kpis.average_ticket(lazy, days))
    assert content(kpis.lead_time_by_territory(stored, days, territory)) == [("North", 3.0)]
    # March follows January: growth compares with the previous month that has sales.
    assert content(kpis.month_over_month_growth(stored, days), "month_number", "growth_pct") == [
        (1, None), (3, Decimal("-85.51")),
    ]
    free = stored.withColumn("line_total", F.lit(0).cast("decimal(14,4)"))
    margins = kpis.margin_by_category(free, store.read("dw.dim_product"))
    assert {r.margin_pct for r in margins.collect()} == {None}


def test_a_crash_before_the_mark_is_absorbed(spark, store, monkeypatch):
    def fail(*_, **__):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as broken:
        broken.setattr(Control, "advance", fail)
        with pytest.raises(RuntimeError):
            load(spark, store, dimensions=(BY_NAME["territory"],), with_fact=False)
    steps = content(Control(store).latest_steps(), "step", "status", "message")
    assert ("load_dim_territory", "ERROR", "lost the driver") in steps
    assert ("run", "ERROR", "lost the driver") in steps
    reopened = TableStore(spark, store.root)
    report = load(spark, reopened, dimensions=(BY_NAME["territory"],), with_fact=False)
    assert report.applied == {"territory": 1}
    assert reopened.read("dw.dim_territory").count() == 2


def test_marks_and_lookback(spark, store):
    control = Control(store)
    assert control.watermark("customer") == datetime(1900, 1, 1)
    control.advance("customer", NEW, FIRST_DAY, 3)
    assert control.watermark("customer") == NEW
    assert control.watermark("customer", lookback=timedelta(days=1)) == NEW - timedelta(days=1)
    assert control.watermark("customer", full_load=True) == datetime(1900, 1, 1)
    assert content(control.watermarks(), "source_name", "status", "rows_processed") == [
        ("customer", "SUCCESS", 3)
    ]


def test_a_batch_without_times_leaves_the_mark(spark, store):
    load(spark, store)
    before = Control(store).marks()["order_line"]
    detail = [row[:-1] + (NEW,) for row in ROWS["order_detail"]]
    header = [row[:-1] + (None,) for row in ROWS["order_header"]]
    untimed = load(spark, store, SECOND_DAY, {"order_detail": detail, "order_header": header})
    assert untimed.staged["order_line"] == 4
    assert Control(store).marks()["order_line"] == before
    messages = dict(content(Control(store).latest_steps().limit(20), "step", "message"))
    assert "4 rows without a modification time" in messages.values()
    again = load(spark, store, SECOND_DAY, {"order_detail": detail})
    assert again.staged["order_line"] == 4
    assert Control(store).marks()["order_line"] == NEW


def test_a_mark_never_moves_back(store):
    control = Control(store)
    control.watermark("customer")
    control.advance("customer", NEW, FIRST_DAY, 1)
    assert control.advance("customer", FIRST_DAY, FIRST_DAY, 1) == NEW
    assert control.advance("customer", None, FIRST_DAY, 1) == NEW
    assert Control(store).marks() == {"customer": NEW}


def test_rows_that_change_while_they_are_read_come_with_the_next_load(spark, store):
    until = datetime(2024, 1, 15)
    late = datetime(2024, 1, 16)
    # During the first load line 12 gets another quantity, after the load has begun.
    moved = [row[:5] + (9,) + row[6:-1] + (late,) if row[1] == 12 else row
             for row in ROWS["order_detail"]]
    load(spark, store, changes={"order_detail": moved}, until=until)
    assert 12 not in dict(content(store.read(FACT_TABLE), "order_line_id", "quantity"))
    assert Control(store).marks()["order_line"] <= until
    load(spark, store, SECOND_DAY, {"order_detail": moved})
    assert dict(content(store.read(FACT_TABLE), "order_line_id", "quantity"))[12] == 9
    assert Control(store).marks()["order_line"] == late


def test_versions_in_force_instead_of_current(spark, store):
    load(spark, store, datetime(2024, 1, 4))
    changed = [row[:6] + (Decimal("9.0000"),) + row[7:-1] + (NEW,) for row in ROWS["product"]]
    load(spark, store, datetime(2024, 2, 1), {"product": changed}, full_load=True, as_of=True)
    costs = content(store.read(FACT_TABLE), "order_line_id", "standard_cost")
    assert costs[0] == (11, Decimal("2.0000")) and costs[3] == (31, Decimal("9.0000"))


def test_failed_step_is_logged_and_raised(spark, store, monkeypatch):
    monkeypatch.setattr(pipeline, "next_watermark", lambda df: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        load(spark, store, dimensions=(BY_NAME["territory"],), with_fact=False)
    steps = content(Control(store).latest_steps(), "step", "status")
    assert steps == [("extract_territory", "ERROR"), ("run", "ERROR")]


def test_a_small_batch_reads_few_key_ranges(spark, store, monkeypatch):
    monkeypatch.setattr(layout, "KEY_RANGE", 10)
    load(spark, store)
    assert sorted(store.live_parts(FACT_KEYS_TABLE)) == ["1", "2", "3"]
    asked = []
    read = TableStore.read

    def noted(self, table, parts=None, extra=None):
        asked.append((table, None if parts is None else sorted(parts)))
        return read(self, table, parts, extra)

    monkeypatch.setattr(TableStore, "read", noted)
    before = dict(store.live_parts(FACT_KEYS_TABLE))
    changed = [row[:-1] + (NEW,) if row[1] == 31 else row for row in ROWS["order_detail"]]
    load(spark, store, SECOND_DAY, {"order_detail": changed})
    assert (FACT_KEYS_TABLE, ["3"]) in asked
    # The fact itself is read in the months of the batch only.
    assert [parts for table, parts in asked if table == FACT_TABLE] == [["202403"]]
    after = store.live_parts(FACT_KEYS_TABLE)
    assert [p for p in before if before[p] != after[p]] == ["3"]


def test_a_fact_without_an_index_gets_one(spark, store):
    load(spark, store)
    keys = dict(content(store.read(FACT_TABLE), "order_line_id", "sale_key"))
    gone = [(FACT_KEYS_TABLE, part, 99, None, None) for part in store.live_parts(FACT_KEYS_TABLE)]
    store.publish(gone)
    load(spark, store, SECOND_DAY, full_load=True)
    assert dict(content(store.read(FACT_TABLE), "order_line_id", "sale_key")) == keys
    assert dict(content(store.read(FACT_KEYS_TABLE), "order_line_id", "sale_key")) == keys


def test_files_stay_level_over_many_loads(spark, store, monkeypatch):
    monkeypatch.setattr(store_module, "MOST_LOG_FILES", 12)
    options = {"dimensions": (BY_NAME["territory"],), "with_fact": False}
    counts = []
    for i in range(10):
        day = datetime(2024, 2, 1 + i)
        load(spark, store, day, {"territory": [(1, f"North {i}", "PT", "Europe", day)]}, **options)
        folders = names_in(spark, f"{store.root}/dw.dim_territory")
        counts.append((sum(store.log_files(log) for log in store_module.LOGS), len(folders)))
    assert max(files for files, _ in counts) <= 3 * 12 + 12
    assert {folders for _, folders in counts[1:]} == {2}
    reopened = TableStore(spark, store.root)
    assert Control(reopened).marks() == {"territory": datetime(2024, 2, 10)}
    assert content(reopened.read("dw.dim_territory"), "territory_name")[-1] == ("North 9",)
    assert content(Control(reopened).latest_steps().where("step = 'load_dim_territory'"),
                   "status") == [("SUCCESS",)] * 10


def test_a_second_writer_is_refused(spark, store):
    other = TableStore(spark, store.root)
    territory = {"dimensions": (BY_NAME["territory"],), "with_fact": False}
    load(spark, store, **territory)
    with pytest.raises(RuntimeError, match="another load"):
        load(spark, other, **territory)
    other.refresh()
    load(spark, other, SECOND_DAY, full_load=True, **territory)


def test_broken_constraints_fail_the_load(spark, store):
    header = [row[:9] + (None,) + row[10:] if row[0] == 1 else row for row in ROWS["order_header"]]
    with pytest.raises(ValueError, match="not null dw.fact_sales.tax_amount"):
        load(spark, store, changes={"order_header": header}, check=True)
    steps = dict(content(Control(store).latest_steps(), "step", "status"))
    assert steps["check_constraints"] == "ERROR" and steps["load_fact_sales"] == "SUCCESS"


def test_lines_without_an_order_date_are_refused(spark, store):
    header = [row[:2] + (None,) + row[3:] if row[0] == 1 else row for row in ROWS["order_header"]]
    with pytest.raises(ValueError, match="2 order lines have no order date"):
        load(spark, store, changes={"order_header": header})
    assert not store.live_parts(FACT_TABLE)


def test_load_dates_go_forward(spark, store):
    load(spark, store, SECOND_DAY)
    changed = [row[:1] + ("Other name",) + row[2:-1] + (NEW,) for row in ROWS["product"]]
    with pytest.raises(ValueError, match="begins on 2024-01-21"):
        load(spark, store, FIRST_DAY, {"product": changed}, full_load=True)
    steps = dict(content(Control(store).latest_steps(), "step", "status"))
    assert "ERROR" in steps.values()


def test_a_calendar_has_bounds(store):
    assert pipeline.load_calendar(store) == 9496
    assert store.read("dw.dim_date").count() == 9496
    with pytest.raises(ValueError, match="too long"):
        pipeline.load_calendar(store, "2024-01-01", "9999-12-31")
    assert pipeline.load_calendar(store, day_names=tuple("abcdefg")) == 9496


def test_the_command_line(spark, tmp_path):
    folder, root = tmp_path / "tables", str(tmp_path / "warehouse")
    for role, df in tables(spark).items():
        df.write.parquet(f"{folder}/{role}.parquet")
    arguments = ["--store", root, "--tables", str(folder), "--load-date", "2024-01-21",
                 "--calendar", "2024-01-01", "2024-12-31"]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr("starwright.__main__.remove_scratch", lambda spark: None)
        assert command.main(arguments, spark) == 0
        assert command.main([*arguments, "--full-load", "--lookback-days", "3"], spark) == 0
    store = TableStore(spark, root)
    assert store.read(FACT_TABLE).count() == 4
    assert store.read("dw.dim_date").count() == 366
    with pytest.raises(SystemExit):
        command.main(["--store", root], spark)


def test_large_roles_of_a_database_need_partitioning(spark):
    queries = {"order_detail": "SELECT 1", "territory": "SELECT 1"}
    with pytest.raises(ValueError, match="order_detail needs partitioning"):
        jdbc_tables(spark, {"url": "jdbc:none"}, queries)
    with pytest.raises(ValueError, match="numPartitions"):
        jdbc_tables(spark, {"url": "jdbc:none"}, queries, {"order_detail": {
            "partitionColumn": "id", "lowerBound": "0", "upperBound": "9"}})


def test_a_batch_rewrites_the_members_it_falls_into(spark, store, monkeypatch):
    monkeypatch.setattr(layout, "MEMBER_RANGE", 2)
    options = {"dimensions": (BY_NAME["customer"],), "with_fact": False}
    load(spark, store, **options)
    before = dict(store.live_parts("dw.dim_customer"))
    assert sorted(before) == ["current--1", "current-0", "current-1", "current-2"]
    customer = [(4, None, 201, NEW) if row[0] == 4 else row for row in ROWS["customer"]]
    store_rows = [row if row[0] != 201 else (201, "Renamed") for row in ROWS["store"]]
    load(spark, store, SECOND_DAY, {"customer": customer, "store": store_rows}, **options)
    after = store.live_parts("dw.dim_customer")
    assert [p for p in before if after[p] != before[p]] == ["current-2"]
    rows = content(store.read("dw.dim_customer").where("customer_id = 4"), "customer_key",
                   "is_current")
    assert rows == [(4, False), (5, True)]


def test_the_failing_load_of_the_step_log_query_has_all_sources(spark, monkeypatch):
    logs, latest = [], Control.latest_steps

    def noted(control):
        logs.append({row.step: row for row in latest(control).collect()})
        return latest(control)

    monkeypatch.setattr(Control, "latest_steps", noted)
    assert QUERIES["step_log_error"](spark, SMALL).count() == 3
    (steps,) = logs
    names = {spec.name for spec in DIMENSIONS}
    assert {f"extract_{name}" for name in (*names, "order_line")} <= set(steps)
    assert steps["extract_order_line"].rows_affected > 1_000
    assert {n for n in names if steps[f"load_dim_{n}"].status == "ERROR"} == {"territory"}
