"""The table store: commits of several writers, deltas, history pieces, renamed columns."""

import time
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starwright.plans import constraints, layout, pipeline
from starwright.plans.control import Control
from starwright.plans.model import BY_NAME, FACT_KEYS_TABLE, FACT_TABLE, ORDERS_TABLE
from starwright.session import names_in, release, scratch_path, size_of, work_dir
from starwright.sources import commits as commits_module
from starwright.sources import store as store_module
from starwright.sources.commits import CommitLog
from starwright.sources.store import WATERMARK, TableStore
from tests.test_pipeline import FIRST_DAY, SECOND_DAY, load
from tests.test_plans import physical
from tests.tiny import NEW, ROWS, content

CUSTOMER, TERRITORY = BY_NAME["customer"], BY_NAME["territory"]
ONLY_CUSTOMERS = {"dimensions": (CUSTOMER,), "with_fact": False}
# Orders whose tax and freight can be shared out, so that no constraint is broken.
HEADERS = [row if row[9] is not None else (*row[:9], Decimal("5.0000"), *row[10:])
           for row in ROWS["order_header"]]
SOUND = {"order_header": HEADERS}


def territories(store, name):
    columns = "CAST({} AS BIGINT) territory_key, CAST({} AS BIGINT) territory_id, '{}' territory_name"
    return store.spark.range(1).selectExpr(
        *columns.format(1, 1, name).split(", "), "'PT' country_code", "'Europe' territory_group"
    )


# --- commits ----------------------------------------------------------------------------


def test_of_two_writers_of_a_table_one_wins(spark, store):
    other = TableStore(spark, store.root)
    writes = {
        s: s.write_parts(TERRITORY.table, territories(s, n), F.lit("whole"), [])
        for s, n in ((store, "one"), (other, "two"))
    }
    other.publish(writes[other])
    with pytest.raises(RuntimeError, match="another load"):
        store.publish(writes[store])
    for reader in (other, TableStore(spark, store.root)):
        assert content(reader.read(TERRITORY.table), "territory_name") == [("two",)]
    # The loser reads again and may then write.
    store.refresh()
    store.replace(TERRITORY.table, territories(store, "three"))
    assert content(TableStore(spark, store.root).read(TERRITORY.table), "territory_name") == [
        ("three",)
    ]


def test_writers_of_different_tables_both_win(spark, store):
    other = TableStore(spark, store.root)
    rows = other.write_parts("dw.dim_ship_method", other.read("dw.dim_ship_method"), F.lit("whole"), [])
    store.replace(TERRITORY.table, territories(store, "one"))
    other.publish(rows)
    assert other.version(TERRITORY.table) == 1
    with pytest.raises(RuntimeError, match="another load"):
        late = TableStore(spark, store.root)
        other.replace(TERRITORY.table, territories(other, "two"))
        # What was made from a table that has changed since is refused as well.
        late.publish(rows, reads=[TERRITORY.table])


def test_what_another_load_writes_is_not_tidied_away(spark, store):
    store.replace(TERRITORY.table, territories(store, "one"))
    other = TableStore(spark, store.root)
    rows = other.write_parts(TERRITORY.table, territories(other, "two"), F.lit("whole"), ["whole"])
    store.tidy()
    other.publish(rows)
    assert content(other.read(TERRITORY.table), "territory_name") == [("two",)]


@pytest.mark.parametrize("scheme", ["file", "hdfs"])
def test_a_number_is_given_once(spark, scheme, monkeypatch):
    """By a hard link on a local file system, by a rename elsewhere."""
    if scheme == "hdfs":
        monkeypatch.setattr(commits_module, "_LINKED", ())
    log = CommitLog(spark, scratch_path(spark, "commits"))
    assert log.create(1, [["a", 1, None]]) and not log.create(1, [["b", 2, None]])
    assert log.create(2, [["c", 3, "é"]])
    assert log.state() == (2, [(1, [["a", 1, None]]), (2, [["c", 3, "é"]])])


def test_snapshots_and_writers_far_behind(spark, monkeypatch):
    monkeypatch.setattr(commits_module, "KEPT_COMMITS", 2)
    log = CommitLog(spark, scratch_path(spark, "commits"))
    for number in range(1, 7):
        assert log.create(number, [[number]])
    log.snapshot(6, [["all"]])
    assert log.state() == (6, [(6, [["all"]])]) and log.files() == 1
    assert log.rows_of(6) == [[6]] and log.rows_of(2) is None
    # Number 2 is free again, but long past.
    assert not log.create(2, [["late"]])
    assert log.create(7, [[7]]) and log.state()[0] == 7
    assert log.files() == 2


def test_a_snapshot_keeps_the_whole_state(spark, store, monkeypatch):
    load(spark, store)
    before = {t: content(store.read(t)) for t in (FACT_TABLE, CUSTOMER.table, "dw.dim_date")}
    unchecked = store.unchecked(FACT_TABLE)
    monkeypatch.setattr(store_module, "MOST_LOG_FILES", 1)
    store.tidy()
    reopened = TableStore(spark, store.root)
    assert {t: content(reopened.read(t)) for t in before} == before
    assert reopened.last_key(FACT_TABLE) == store.last_key(FACT_TABLE) > 0
    assert reopened.version(CUSTOMER.table) == store.version(CUSTOMER.table)
    assert reopened.unchecked(FACT_TABLE) == unchecked


# --- deltas -----------------------------------------------------------------------------


def moved_orders():
    """A line with a new quantity, and an order that moves to another month and back."""
    detail = [
        row[:5] + (7,) + row[6:9] + (NEW,) if row[1] == 12 else row
        for row in ROWS["order_detail"]
    ]

    def header(month, changed):
        return [
            row[:2] + (datetime(2024, month, 1),) + row[3:-1] + (changed,) if row[0] == 3 else row
            for row in HEADERS
        ]

    return [
        {"order_detail": detail, "order_header": header(5, NEW)},
        {"order_detail": detail, "order_header": header(7, datetime(2024, 2, 1))},
    ]


def test_deltas_win_and_fold_away(spark, store, monkeypatch):
    load(spark, store, changes=SOUND)
    keys = dict(content(store.read(FACT_TABLE), "order_line_id", "sale_key"))
    base = {p: f for p, f in store.live_parts(FACT_TABLE).items()}
    days = (datetime(2024, 2, 2), datetime(2024, 2, 3))
    monkeypatch.setattr(pipeline, "FOLD_SHARE", 100)
    for changes, day in zip(moved_orders(), days):
        load(spark, store, day, changes, merge_on_read=True, check=True)
    # Nothing but two deltas was written.
    live = store.live_parts(FACT_TABLE)
    assert {p: live[p] for p in base} == base and len(store.deltas(FACT_TABLE)) == 2
    assert len(store.deltas(FACT_KEYS_TABLE)) == 2
    want = [
        (11, 2, 20240105, FIRST_DAY), (12, 7, 20240105, days[0]), (21, 1, 20240105, FIRST_DAY),
        (31, 1, 20240701, days[1]),
    ]

    def shown(table, *parts):
        return content(table.read(FACT_TABLE, *parts), "order_line_id", "quantity",
                       "order_date_key", "loaded_at")

    assert shown(store) == shown(TableStore(spark, store.root)) == want
    assert shown(store, ["202403"]) == shown(store, ["202405"]) == []
    assert shown(store, ["202407"]) == want[3:]
    assert dict(content(store.read(FACT_TABLE), "order_line_id", "sale_key")) == keys
    # While there are deltas, any batch goes to one, so that the newest stays the newest.
    load(spark, store, datetime(2024, 2, 4), SOUND, full_load=True, merge_on_read=False)
    assert len(store.deltas(FACT_TABLE)) == 3
    expected = {t: content(store.read(t)) for t in (FACT_TABLE, FACT_KEYS_TABLE)}
    pipeline.fold_deltas(store, always=True)
    assert not store.deltas(FACT_TABLE) and not store.deltas(FACT_KEYS_TABLE)
    assert {t: content(store.read(t)) for t in expected} == expected
    assert sorted(store.live_parts(FACT_TABLE)) == ["202401", "202403"]
    assert constraints.assert_constraints(store) > 70


def test_a_scattered_batch_writes_in_proportion(spark, store, monkeypatch):
    """One line of every month and key range: little is written, and no part anew."""
    monkeypatch.setattr(layout, "KEY_RANGE", 1000)
    monkeypatch.setattr(pipeline, "LEAST_DELTA_BYTES", 0)
    header, detail = [], []
    for order in range(1200):
        day = datetime(2024, 1 + order % 12, 1 + order % 28)
        header.append((order, f"SO{order}", day, None, None, 1, 301, 1, 1,
                       *ROWS["order_header"][0][9:12], datetime(2024, 1, 2)))
        detail += [(order, 10 * order + n, n, 1, 1, 1, *ROWS["order_detail"][0][6:9],
                    datetime(2024, 1, 2)) for n in range(10)]
    load(spark, store, changes={"order_header": header, "order_detail": detail})
    live = dict(store.live_parts(FACT_TABLE))
    assert len(live) == 12 and len(store.live_parts(FACT_KEYS_TABLE)) == 12
    changed = [row[:5] + (9,) + row[6:9] + (NEW,) if row[1] % 1000 == 5 else row
               for row in detail]
    load(spark, store, SECOND_DAY, {"order_header": header, "order_detail": changed})
    after = store.live_parts(FACT_TABLE)
    assert {p: after[p] for p in live} == live
    written = size_of(spark, [after[p] for p in store.deltas(FACT_TABLE)])
    assert written < size_of(spark, live.values()) / 10
    assert content(store.read(FACT_TABLE).where("quantity = 9"), "order_line_id") == [
        (n,) for n in sorted(range(5, 12000, 1000), key=lambda n: repr((n,)))
    ]
    assert store.read(FACT_TABLE).count() == 12_000


# --- history ----------------------------------------------------------------------------


def renamed(day, name):
    store_rows = [row if row[0] != 201 else (201, name) for row in ROWS["store"]]
    customer = [row[:-1] + (day,) if row[0] in (2, 4) else row for row in ROWS["customer"]]
    return {"customer": customer, "store": store_rows}


def test_history_stays_level_and_is_read_in_part(spark, store, monkeypatch):
    monkeypatch.setattr(pipeline, "MOST_PIECES", 2)
    load(spark, store, datetime(2023, 1, 1), **ONLY_CUSTOMERS)
    counts = []
    for month in range(1, 7):
        day = datetime(2024, month, 15)
        load(spark, store, day, renamed(day, f"Name {month}"), **ONLY_CUSTOMERS)
        counts.append(len(store.live_parts(CUSTOMER.table)))
    assert max(counts) <= 2 + 3
    day = datetime(2025, 1, 15)
    load(spark, store, day, renamed(day, "Last"), **ONLY_CUSTOMERS)
    dim = store.read(CUSTOMER.table)
    assert dim.where("customer_id = 2").count() == 8
    assert constraints.assert_constraints(store) > 70
    years = {p.split(".")[2] for p in store.live_parts(CUSTOMER.table) if p.startswith("closed")}
    assert years == {"2024", "2025"}

    def parts(first, customer):
        lines = spark.createDataFrame([(customer, first)], "customer_id long, order_date date")
        return layout.as_of_parts(store, CUSTOMER, lines)

    early = parts(datetime(2024, 3, 1), 2)
    late = parts(datetime(2025, 1, 1), 2)
    assert {p.split(".")[2] for p in early if p.startswith("closed")} == {"2024", "2025"}
    assert {p.split(".")[2] for p in late if p.startswith("closed")} == {"2025"}
    # Members of other ranges are not read either.
    assert parts(datetime(2024, 3, 1), 5 << 20) == []
    by_day = {
        (str(r.valid_from), r.customer_name)
        for r in store.read(CUSTOMER.table, late).where("customer_id = 2").collect()
    }
    assert ("2024-06-15", "Name 6") in by_day and ("2025-01-15", "Last") in by_day


# --- constraints ------------------------------------------------------------------------


def test_rows_without_a_business_key_are_refused(spark, store):
    for changes, message in (
        ({"customer": [(None, 101, None, OLD_DAY)]}, "1 rows of stg.customer have no customer_id"),
        ({"territory": [(None, "x", "PT", "y", OLD_DAY)] + ROWS["territory"]},
         "1 rows of stg.territory have no territory_id"),
        ({"order_detail": [row[:1] + (None,) + row[2:] for row in ROWS["order_detail"][:1]]},
         "1 rows of stg.order_line have no order_line_id"),
    ):
        with pytest.raises(ValueError, match=message):
            load(spark, store, changes=changes, full_load=True)
    assert not store.live_parts(FACT_TABLE)


OLD_DAY = datetime(2024, 1, 10)


def test_a_check_finds_twins_that_a_load_made_and_reads_no_more(spark, store, monkeypatch):
    monkeypatch.setattr(layout, "MEMBER_RANGE", 2)
    load(spark, store, changes=SOUND, check=True)
    assert all(store.unchecked(t) == [] for t in (FACT_TABLE, CUSTOMER.table, TERRITORY.table))
    customer = [row[:3] + (NEW,) if row[0] == 4 else row for row in ROWS["customer"]]
    renamed_store = [(201, "Renamed")]
    changes = {"customer": customer, "store": renamed_store, **SOUND}
    load(spark, store, SECOND_DAY, changes, **ONLY_CUSTOMERS)
    asked, read = [], TableStore.read

    def noted(self, table, parts=None, extra=None):
        asked.append((table, None if parts is None else sorted(parts)))
        return read(self, table, parts, extra)

    with monkeypatch.context() as watched:
        watched.setattr(TableStore, "read", noted)
        constraints.all_violations(store, unchecked=True).collect()
    assert (CUSTOMER.table, ["closed.2.2024.3", "current-2"]) in asked
    assert (FACT_TABLE, []) in asked and (TERRITORY.table, []) in asked
    # A second current version, made by someone else, fails the next check.
    other = TableStore(spark, store.root)
    twin = other.read(CUSTOMER.table, ["current-0"]).withColumn("customer_key", F.lit(99).cast("long"))
    both = other.read(CUSTOMER.table, ["current-0"]).unionByName(twin)
    other.replace_parts(CUSTOMER.table, both, layout.member_range("customer_id"), ["current-0"])
    store.refresh()
    with pytest.raises(ValueError, match="customer_id, valid_from: 2.*several current: 2"):
        load(spark, store, datetime(2024, 1, 22), SOUND, check=True)


def test_a_double_mark_is_found(spark, store):
    load(spark, store, **ONLY_CUSTOMERS)
    assert constraints.assert_constraints(store) > 70
    mark = Control(store).watermarks().first()
    store.append(WATERMARK, [tuple(mark)])
    with pytest.raises(ValueError, match="unique ctrl.watermark.source_name: 2"):
        constraints.assert_constraints(store)


# --- schema -----------------------------------------------------------------------------


def test_a_column_is_renamed_in_stored_parts(spark, store):
    load(spark, store, **ONLY_CUSTOMERS)
    want = content(store.read(CUSTOMER.table), "customer_id", "customer_name")
    older = store.read(CUSTOMER.table).withColumnRenamed("customer_name", "person_name")
    store.replace_parts(CUSTOMER.table, older, layout.member_range("customer_id"), [])
    assert {name for _, name in content(store.read(CUSTOMER.table), "customer_id", "customer_name")} == {None}
    assert store.rename_column(CUSTOMER.table, "person_name", "customer_name") == 2
    assert store.rename_column(CUSTOMER.table, "person_name", "customer_name") == 0
    for reader in (store, TableStore(spark, store.root)):
        assert content(reader.read(CUSTOMER.table), "customer_id", "customer_name") == want
    load(spark, store, SECOND_DAY, renamed(NEW, "Renamed"), **ONLY_CUSTOMERS)
    names = dict(content(store.read(CUSTOMER.table).where("is_current"), "customer_id", "customer_name"))
    assert names[2] == "Renamed" and names[1] == "Ana Silva"
    assert store.rename_column(TERRITORY.table, "nothing", "territory_name") == 0


def test_copies_of_a_line_in_two_orders_are_one_row(spark, store):
    copy = (3, 11, 1, 1, 1, 8, *ROWS["order_detail"][0][6:9], NEW)
    load(spark, store, SECOND_DAY, {"order_detail": ROWS["order_detail"] + [copy], **SOUND},
         check=True)
    rows = content(store.read(FACT_TABLE).where("order_line_id = 11"), "quantity", "order_number")
    assert rows == [(8, "SO3")]


def test_rows_that_no_delta_concerns_stay_where_they_lie(spark, store, monkeypatch, conf):
    """Read and folded without a broadcast, and without a window over the rows of one delta."""
    other = TableStore(spark, f"{store.root}-other")
    monkeypatch.setattr(pipeline, "FOLD_SHARE", 100)
    days = (datetime(2024, 2, 2), datetime(2024, 2, 3))
    for threshold, target in (("10m", other), ("-1", store)):
        conf("spark.sql.autoBroadcastJoinThreshold", threshold)
        load(spark, target, changes=SOUND)
        load(spark, target, days[0], moved_orders()[0], merge_on_read=True)
    plan = physical(store.read(FACT_TABLE))
    assert "Window" not in plan and plan.count("Exchange hashpartitioning") == 2
    assert "Exchange hashpartitioning" not in plan.split("FileScan")[0]

    def shown(table):
        return {t: content(table.read(t)) for t in (FACT_TABLE, FACT_KEYS_TABLE, ORDERS_TABLE)}

    assert shown(store) == shown(other)
    load(spark, store, days[1], moved_orders()[1], merge_on_read=True)
    assert len(store.deltas(FACT_TABLE)) == 2
    expected = shown(store)
    pipeline.fold_deltas(store, always=True)
    assert not store.deltas(FACT_TABLE) and shown(store) == expected
    assert constraints.assert_constraints(store) > 70


# --- what a load leaves behind ------------------------------------------------------------


def test_a_load_leaves_no_scratch_and_one_state_of_staging(spark, store):
    load(spark, store)
    before = set(names_in(spark, work_dir(spark)))
    load(spark, store, SECOND_DAY, {"order_detail": moved_orders()[0]["order_detail"]})
    left = set(names_in(spark, work_dir(spark))) - before
    assert not [name for name in left if not name.startswith(("subcategory", "category"))]
    for table in ("stg.order_line", "stg.customer"):
        assert len(names_in(spark, f"{store.root}/{table}")) == 1
    # A reader that opened the fact before the load can go on.
    assert len(names_in(spark, f"{store.root}/{FACT_TABLE}")) == 2


def test_shuffles_of_frames_that_are_gone_are_removed(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return disk.getAllFiles().size()

    spark.range(100_000).repartition(7, "id").write.format("noop").mode("overwrite").save()
    made = files()
    assert made > 0
    # Spark removes them in the background.
    for _ in range(40):
        release(spark)
        if files() < made:
            break
        time.sleep(0.25)
    assert files() < made
