"""The incremental warehouse load: extract, stage, merge dimensions, upsert the fact."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starwright.functions.scalars import date_key, month_of_key
from starwright.operators.calendar import MOST_DAYS, calendar_between, missing_days
from starwright.operators.fact import (
    existing_keys,
    fact_upsert,
    late_keys,
    line_measures,
    lookup_sides,
    moved_marks,
    placed_upsert,
    resolve_fact,
    written_rows,
)
from starwright.operators.joins import (
    ExactKeys,
    exact_keys,
    key_filter,
    may_meet,
    members_used,
)
from starwright.operators.keys import dense_numbers, seed_unknown, stamp_rows
from starwright.operators.orders import (
    GROUP,
    add_up,
    add_up_placed,
    changed_orders,
    line_shares,
    orders_after,
)
from starwright.operators.scd import CHANGED, NEW, scd1_upsert, scd2_apply, scd2_changes
from starwright.operators.shaping import next_watermark, rows_without
from starwright.plans.constraints import assert_constraints
from starwright.plans.control import Control, now
from starwright.plans.layout import (
    as_of_parts,
    CLOSED,
    closed_piece,
    current_parts,
    key_range,
    member_range,
    order_month,
    order_range,
)
from starwright.plans.model import (
    DATE_ROLES,
    DIMENSIONS,
    FACT_KEY,
    FACT_KEYS_TABLE,
    FACT_STAGING,
    FACT_TABLE,
    NATURAL_KEY,
    ORDER_KEY,
    ORDERS_TABLE,
    DimensionSpec,
)
from starwright.schemas import OPEN_START, schema
from starwright.session import (
    beyond_broadcast,
    materialize,
    passing_scratch,
    release,
    together,
)
from starwright.sources.extracts import SOURCES, Tables
from starwright.sources.store import TableStore

CALENDAR = "dw.dim_date"
# The default range of the calendar.
CALENDAR_START, CALENDAR_END = "2005-01-01", "2030-12-31"
#: Pieces of closed versions of one range and year before they are put together.
MOST_PIECES = 8
#: A batch goes to a delta if the months it touches are larger than this, and than so many times
#: the batch; deltas are folded if they are many, or more than a share of their table.
LEAST_DELTA_BYTES, REWRITE = 32 << 20, 4
MOST_DELTAS, FOLD_SHARE = 16, 0.05
#: What a task writes of a part, roughly.
SLICE_BYTES = 16 << 20
_STAMP = T.StructType([T.StructField("row_stamp", T.LongType())])


@dataclass
class Batch:
    """What an extract has staged."""

    rows: int
    watermark: datetime | None
    started: datetime


@dataclass
class LoadReport:
    """Rows staged and rows applied, by source name."""

    staged: dict[str, int] = field(default_factory=dict)
    applied: dict[str, int] = field(default_factory=dict)


def merge_history(store: TableStore, spec: DimensionSpec) -> None:
    """Put the pieces of closed versions of a range and year together, where they are many."""
    pieces: dict[str, list[str]] = {}
    for part in store.live_parts(spec.table):
        if part.startswith(CLOSED):
            pieces.setdefault(part.rsplit(".", 1)[0], []).append(part)
    many = [part for group in pieces.values() if len(group) > MOST_PIECES for part in group]
    if many:
        piece = closed_piece(spec.business_key, store.version(spec.table) + 1)
        store.replace_parts(spec.table, store.read(spec.table, many), piece, many)


def fold_deltas(store: TableStore, always: bool = False) -> None:
    """Bring deltas into their parts, once they are many or large."""
    places = {
        FACT_TABLE: order_month(), FACT_KEYS_TABLE: key_range(), ORDERS_TABLE: order_range(),
    }
    for table, part in places.items():
        deltas = store.deltas(table)
        if not deltas:
            continue
        share = store.bytes_of(table, deltas) / max(1, store.bytes_of(table))
        if always or len(deltas) > MOST_DELTAS or share > FOLD_SHARE:
            store.publish(store.fold(table, part))


def _refuse_missing(staged: DataFrame, table: str, key: str) -> None:
    raise ValueError(f"{rows_without(staged, key)} rows of {table} have no {key}")


def seed_dimensions(store: TableStore, dimensions: Sequence[DimensionSpec]) -> None:
    """Give every dimension its unknown member; existing rows win."""
    fresh = {spec.name: spec for spec in dimensions if not store.live_parts(spec.table)}

    def seed(name: str) -> None:
        spec = fresh[name]
        seeded = seed_unknown(
            store.read(spec.table), spec.table, spec.key, spec.business_key, spec.unknown
        )
        if spec.scd_type == 2:
            store.replace_parts(spec.table, seeded, member_range(spec.business_key), [], 0)
        else:
            store.replace(spec.table, seeded)

    together(seed, list(fresh))


def extract(
    store: TableStore, control: Control, tables: Tables, name: str, until: datetime,
    full_load: bool = False, lookback: timedelta | None = None,
) -> Batch:
    """Replace the staging table of one source by its rows past the watermark, up to ``until``.

    An empty batch leaves an empty staging table.  The new mark is read back from the
    written table, one column of it, so that retried tasks cannot distort it.  It does not
    pass ``until``: what changed later has not been read for certain.
    """
    source = SOURCES[name]
    with control.step(f"extract_{name}") as outcome:
        since = control.watermark(name, full_load, lookback)
        staged = source.staged(tables, since, until)
        if source.staging == FACT_STAGING:
            staged = stamp_rows(staged)
        # Nobody but the load that has staged them reads these rows.
        store.replace(source.staging, staged, keep_old=False)
        settled = source.settled(store.read(source.staging))
        if settled is not None:
            store.replace(source.staging, stamp_rows(settled), keep_old=False)
        summary = next_watermark(store.read(source.staging)).first()
        outcome["rows"] = summary.rows
        untimed = summary.rows and rows_without(store.read(source.staging), "modified_at")
        if untimed:
            outcome["message"] = f"{untimed} rows without a modification time"
        mark = summary.watermark and min(summary.watermark, until)
        return Batch(summary.rows, mark, outcome["started"])


def load_dimension(
    store: TableStore, spec: DimensionSpec, load_date: str, first_from: str | None = None
) -> int:
    """Merge the staged rows of one dimension; gives the number of rows applied.

    A type 2 merge reads and rewrites current versions only, and of these the ranges of
    members that the batch falls into; versions it closes go to a new piece of their range and
    year, and older history is not touched.  Rows without a business key are refused.
    """
    staged = store.read(spec.staging)
    keyed = (spec.business_key, spec.key, spec.attributes)
    if spec.scd_type == 1:
        size = staged.agg(
            F.count(F.lit(1)).alias("rows"), F.count(spec.business_key).alias("named")
        ).first()
        if size.named < size.rows:
            _refuse_missing(staged, spec.staging, spec.business_key)
        store.replace(spec.table, scd1_upsert(store.read(spec.table), staged, *keyed))
        return size.rows
    part = member_range(spec.business_key)
    touched = [r.part for r in staged.select(part.alias("part")).distinct().collect()]
    if None in touched:
        _refuse_missing(staged, spec.staging, spec.business_key)
    merge_history(store, spec)
    dim = store.read(spec.table, touched)
    start = store.last_key(spec.table)
    changes = scd2_changes(dim, staged, *keyed, load_date, start=start)
    opened = F.when(F.col("action").isin(NEW, CHANGED), F.col("new_key"))
    summary = changes.agg(F.count(F.lit(1)).alias("rows"), F.max(opened).alias("last_key")).first()
    if summary.rows:
        merged = scd2_apply(dim, changes, *keyed, load_date, first_from)
        closed = closed_piece(spec.business_key, store.version(spec.table) + 1)
        part = F.when(F.col("is_current"), part).otherwise(closed)
        store.replace_parts(spec.table, merged, part, touched, summary.last_key or start)
    return summary.rows


def load_calendar(
    store: TableStore, first_day: str = CALENDAR_START, last_day: str = CALENDAR_END,
    **labels: Sequence[str],
) -> int:
    """Insert the missing days of a range; gives the number of days in it.

    ``labels`` may name ``day_names`` and ``month_names``.  A range of more than
    ``MOST_DAYS`` days is refused: it comes from a date that cannot be right.
    """
    days = (date.fromisoformat(last_day) - date.fromisoformat(first_day)).days + 1
    if days > MOST_DAYS:
        raise ValueError(f"a calendar from {first_day} to {last_day} is too long")
    needed = calendar_between(store.spark, first_day, last_day, **labels)
    calendar = store.read(CALENDAR)
    missing = missing_days(calendar, needed)
    if not missing.isEmpty():
        store.replace(CALENDAR, calendar.unionByName(missing))
    return days


def key_index(store: TableStore, ranges: list[str]) -> DataFrame:
    """Keys of the fact rows in the given ranges; built once for a fact that has no index."""
    if store.live_parts(FACT_TABLE) and not store.live_parts(FACT_KEYS_TABLE):
        stored = store.read(FACT_TABLE).select(schema(FACT_KEYS_TABLE).names)
        store.replace_parts(FACT_KEYS_TABLE, stored, key_range(), [])
    return store.read(FACT_KEYS_TABLE, ranges)


def known_keys(store: TableStore, index: DataFrame, staged: DataFrame) -> DataFrame:
    """Keys of the fact rows that a batch takes the place of, as a written table."""
    if store.live_parts(FACT_KEYS_TABLE):
        index = may_meet(index, staged, NATURAL_KEY)
    return materialize(existing_keys(index, staged), "known-keys", compression="zstd")


def build_orders(store: TableStore) -> None:
    """Totals by order for a fact that has none."""
    if store.live_parts(FACT_TABLE) and not store.live_parts(ORDERS_TABLE):
        totals = add_up(line_shares(store.read(FACT_TABLE)), order_range())
        store.publish(
            store.write_parts(ORDERS_TABLE, totals, F.col("part"), [], placed=True)
        )


def write_orders(
    store: TableStore, lines: DataFrame, current: DataFrame | None, known: DataFrame,
    as_delta: bool, replaced: ExactKeys | None = None,
) -> list[tuple]:
    """Write the totals of the orders that a batch concerns; gives what ``publish`` takes.

    ``lines`` are those of the batch, the lines they take the place of (``known``) are read from
    the ``current`` rows of the touched months; None, if they have none.  ``replaced`` may tell which
    rows of those they are.  The difference is all that the totals need, so no other line of an order
    is looked for.
    """
    changes = line_shares(lines)
    if current is not None:
        if replaced is None:
            old = current.join(known.select(NATURAL_KEY), NATURAL_KEY, "left_semi")
        else:
            old = replaced.matching(current)
        changes = changes.unionByName(line_shares(old, -1))
    part = order_range()
    if not store.live_parts(ORDERS_TABLE):
        return store.write_parts(
            ORDERS_TABLE, add_up_placed(changes, part), F.col("part"), [], placed=True
        )
    changes = materialize(changes, "order-changes", compression="zstd")
    ranges = [r.part for r in changes.select(part.alias("part")).distinct().collect()]
    orders = store.read(ORDERS_TABLE, ranges)
    concerned = key_filter(changes, ORDER_KEY)
    if as_delta:
        after = changed_orders(orders, changes, concerned)
        return store.write_delta(ORDERS_TABLE, after, part, part, placed=True)
    totals = orders_after(orders, changes, part, concerned)
    return store.write_parts(ORDERS_TABLE, totals, F.col("part"), ranges, placed=True)


def slices_of(store: TableStore, table: str, parts: Sequence[str]) -> int:
    """Into how many slices each of some parts is cut, so that a task gets few bytes of them."""
    size = store.bytes_of(table, parts) + store.bytes_of(FACT_STAGING)
    return 1 + size // (SLICE_BYTES * max(1, len(parts)))


def members_of(dim: DataFrame, staged: DataFrame, spec: DimensionSpec) -> DataFrame:
    """Rows of a dimension that a batch of lines may need.

    Only where a dimension has many members does it pay to look which ones a batch uses.
    """
    return members_used(dim, staged, spec.business_key) if spec.many_members else dim


def load_fact(
    store: TableStore,
    dimensions: Sequence[DimensionSpec],
    rows: int,
    loaded_at: datetime,
    as_of: bool = False,
    merge_on_read: bool | None = None,
    **labels: Sequence[str],
) -> int:
    """Upsert the ``rows`` staged order lines.

    A line may move to another month, so the month of its old row counts as touched too.  Old
    rows are found in a narrow index of keys, of which only the ranges that the batch falls
    into are read; it becomes current in one commit with the fact and its totals by order.  As with a sequence in an
    upsert, rows that turn out to exist use up a number as well.

    A batch that is large against the months it touches rewrites them.  A small, scattered one
    is written as a delta of the fact and one of the index, and wins at read; so is any batch
    while there are deltas.  ``merge_on_read`` sets the way, whatever the sizes, but for that.
    """
    staged = store.read(FACT_STAGING)
    days = [F.col(day) for day in DATE_ROLES]
    batch = staged.agg(
        F.count_if(F.col("order_date").isNull()).alias("undated"),
        F.count_if(F.col(NATURAL_KEY).isNull()).alias("unnamed"),
        F.count_if(F.col(ORDER_KEY).isNull()).alias("without_order"),
        F.collect_set(key_range()).alias("ranges"),
        F.min(F.least(*days)).alias("first_day"), F.max(F.greatest(*days)).alias("last_day"),
    ).first()
    if batch.undated:
        raise ValueError(f"{batch.undated} order lines have no order date")
    if batch.unnamed:
        _refuse_missing(staged, FACT_STAGING, NATURAL_KEY)
    if batch.without_order:
        _refuse_missing(staged, FACT_STAGING, ORDER_KEY)
    build_orders(store)
    ranges = sorted(batch.ranges)
    # Lines take current versions, so a load without ``as_of`` leaves closed history alone.
    dims = {}
    for spec in dimensions:
        parts = as_of_parts(store, spec, staged) if as_of else current_parts(store, spec)
        dims[spec.name] = members_of(store.read(spec.table, parts), staged, spec)
    numbered = dense_numbers(
        store.read(FACT_STAGING, extra=_STAMP), "row_number", 0
    )
    index = key_index(store, ranges)
    steps = {
        "calendar": lambda: load_calendar(
            store, str(batch.first_day), str(batch.last_day), **labels
        ),
        "sides": lambda: lookup_sides(dims, as_of),
        "known": lambda: known_keys(store, index, staged),
    }
    done = together(lambda name: steps[name](), list(steps))
    sides, known = done["sides"], done["known"]
    touched = known.select("order_date_key").union(
        staged.select(date_key(F.col("order_date")).alias("order_date_key"))
    )
    months = [r.month for r in touched.select(order_month().alias("month")).distinct().collect()]
    start = store.last_key(FACT_TABLE)
    stamp = F.lit(loaded_at).cast("timestamp_ntz")
    keys = numbered.select(
        NATURAL_KEY, "row_number", date_key(F.col("order_date")).alias("order_date_key")
    )
    if merge_on_read is None:
        large = max(LEAST_DELTA_BYTES, REWRITE * store.bytes_of(FACT_STAGING))
        merge_on_read = store.bytes_of(FACT_TABLE, months) > large
    as_delta = merge_on_read or bool(store.deltas(FACT_TABLE))
    current = store.read(FACT_TABLE, months)
    # Deltas may hold rows of any month.
    present = store.deltas(FACT_TABLE) or set(months) & set(store.live_parts(FACT_TABLE))
    # Of members that cannot be broadcast, only what they add to a line meets the wide lines.
    apart = {name: side for name, side in sides.items() if beyond_broadcast(side)}
    near = {name: dim for name, dim in dims.items() if name not in apart}
    incoming = resolve_fact(numbered, near, as_of, sides)
    late = late_keys(staged, apart) if apart else None
    placed = bool(present or apart)
    # Old rows that stay are written from where they are read; others are not needed for their keys.
    replaced = None
    if present and (not as_delta or beyond_broadcast(known)):
        replaced = exact_keys(current, known, NATURAL_KEY)
    if as_delta:
        old_day = F.col("_old_date_key")
        written = written_rows(incoming, known, start=start, late=late).withColumn(
            "loaded_at", stamp
        )
        # Of the index only what a batch adds or moves.
        moved = written_rows(keys, known, start=start).where(
            ~F.col("order_date_key").eqNullSafe(old_day)
        )
        old_range = F.when(old_day.isNotNull(), key_range())
        writes = {
            FACT_TABLE: lambda: store.write_delta(
                FACT_TABLE, written, order_month(), month_of_key(old_day).cast("string"),
                start + rows, placed=late is not None,
            ),
            FACT_KEYS_TABLE: lambda: store.write_delta(
                FACT_KEYS_TABLE, moved, key_range(), old_range
            ),
        }
    else:
        fresh_key = (F.lit(start) + F.col("row_number")).cast("long")
        indexed = placed_upsert(
            index, keys.withColumn(FACT_KEY, fresh_key), key_range(),
            slices_of(store, FACT_KEYS_TABLE, ranges), replaced=replaced and replaced.passing,
        )
        if placed:
            merged = placed_upsert(
                current, incoming.withColumns({FACT_KEY: fresh_key, "loaded_at": stamp}),
                order_month(), slices_of(store, FACT_TABLE, months),
                moved_marks(keys, known, order_month(), every=True) if present else None,
                late, replaced, line_measures(),
            )
        else:
            merged = fact_upsert(current, incoming, stamp, start=start, known=known)
        writes = {
            FACT_TABLE: lambda: store.write_parts(
                FACT_TABLE, merged, F.col("part") if placed else order_month(), months,
                start + rows, placed=placed,
            ),
            FACT_KEYS_TABLE: lambda: store.write_parts(
                FACT_KEYS_TABLE, indexed, F.col("part"), ranges, placed=True
            ),
        }
    published = together(lambda table: writes[table](), list(writes))
    release(store.spark)
    if present and not as_delta:
        # Of what has been written, the batch's lines would have to be looked for.
        grouped = {spec.name: dims[spec.name] for spec in dimensions if spec.key in GROUP}
        lines = resolve_fact(staged, grouped, as_of)
    else:
        lines = store.read_written(published[FACT_TABLE])
    published[ORDERS_TABLE] = write_orders(
        store, lines, current if present else None, known, as_delta, replaced
    )
    store.publish(
        [row for rows_of in published.values() for row in rows_of],
        reads=[spec.table for spec in dimensions],
    )
    return rows


def run(
    spark: SparkSession,
    tables: Tables,
    store: TableStore,
    load_date: str,
    loaded_at: datetime | None = None,
    full_load: bool = False,
    lookback: timedelta | None = None,
    dimensions: Sequence[DimensionSpec] = DIMENSIONS,
    with_fact: bool = True,
    as_of: bool = False,
    until: datetime | None = None,
    check: bool = False,
    merge_on_read: bool | None = None,
    **labels: Sequence[str],
) -> LoadReport:
    """One load of the warehouse.

    ``check`` ends it with the constraints of the model, in all parts that became current since
    they were last found to hold, as a step that fails if one is broken.  ``merge_on_read``: see
    ``load_fact``.  ``labels`` are those of new calendar days.

    It reads rows modified up to ``until``, in the clock of the source; the default is the
    time at which the load begins.

    Data is published before its watermark moves: a run that dies in between reads the same
    rows again, and the merges absorb them.  A full load ignores the marks, but does not
    empty the warehouse.

    Scratch tables of a step are removed when it ends, and so are its shuffles: ``tables`` that are
    written when a step first asks for them have to be ``lasting``.
    """
    control, report = Control(store), LoadReport()
    started = now()
    try:
        store.tidy()
        fold_deltas(store)
        seed_dimensions(store, dimensions)
        by_name = {spec.name: spec for spec in dimensions}
        # The longest extract starts first.
        sources = [*(["order_line"] if with_fact else []), *by_name]

        def stage(name: str) -> Batch:
            with passing_scratch(spark):
                return extract(
                    store, control, tables, name, until or started, full_load, lookback
                )

        batches = together(stage, sources)
        release(spark)
        report.staged = {name: batch.rows for name, batch in batches.items()}

        def load(name: str) -> int:
            batch = batches[name]
            step = "load_fact_sales" if name == "order_line" else f"load_dim_{name}"
            with control.step(step) as outcome, passing_scratch(spark):
                if name == "order_line":
                    applied = load_fact(
                        store, dimensions, batch.rows, loaded_at or started, as_of,
                        merge_on_read, **labels,
                    )
                else:
                    # As of the sale, a member was there from the start.
                    first_from = OPEN_START if as_of else None
                    applied = load_dimension(store, by_name[name], load_date, first_from)
                outcome["rows"] = applied
                control.advance(name, batch.watermark, batch.started, batch.rows)
            return applied

        filled = [name for name in sources if batches[name].rows]
        report.applied = together(load, [n for n in filled if n in by_name])
        if "order_line" in filled:
            report.applied["order_line"] = load("order_line")
            release(spark)
        if check:
            with control.step("check_constraints") as outcome:
                outcome["rows"] = assert_constraints(store, unchecked=True)
                store.note_checked()
    except Exception as error:
        control.log("run", started, "ERROR", 0, str(error))
        raise
    return report
