"""Fact rows from staged order lines, and their idempotent upsert."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starwright.functions.scalars import MONEY, date_key, discount_amount
from starwright.operators.joins import ExactKeys, KeyFilter, exact_keys
from starwright.operators.lookup import join_side, lookup_as_of, lookup_side
from starwright.plans.model import (
    BY_NAME,
    DATE_ROLES,
    FACT_KEY,
    FACT_TABLE,
    NATURAL_KEY,
    DimensionSpec,
)
from starwright.schemas import schema
from starwright.session import beyond_broadcast, together


#: Natural keys that lie together in a part, as lines of an order do.
NEIGHBOURS = 4096
#: What lines of an order have in common.  Side by side it costs little in a compressed shuffle.
_OF_ORDER = (
    "order_date_key", "due_date_key", "territory_key", "promotion_key", "loaded_at", "order_number"
)
#: What a row is in an upsert: an old one, a mark of one, a new one, columns of a new one.
_OLD, _MARK, _NEW, _LATE = range(4)


def lookup_sides(dims: Mapping[str, DataFrame], as_of: bool = False) -> dict[str, DataFrame]:
    """One row per business key of each dimension in ``dims`` that is not looked up as of a day."""

    def side(name: str) -> DataFrame:
        spec = BY_NAME[name]
        if spec.scd_type == 1:
            # One row per business key already.
            return dims[name].select(
                spec.business_key, spec.key,
                *[F.col(a).alias(n) for a, n in spec.fact_attributes.items()],
            )
        return lookup_side(dims[name], spec.business_key, spec.key, spec.fact_attributes)

    return together(side, [n for n in dims if not (as_of and BY_NAME[n].scd_type == 2)])


def _without_gaps(fact: DataFrame, spec: DimensionSpec) -> DataFrame:
    """Attributes of a member that is missing are zero."""
    for attribute in spec.fact_attributes.values():
        fact = fact.withColumn(attribute, F.coalesce(F.col(attribute), F.lit(0)).cast(MONEY))
    return fact


def line_measures() -> dict[str, Column]:
    """Measures that follow from other columns of a line."""
    return {
        "discount_amount": discount_amount(
            F.col("unit_price"), F.col("quantity"), F.col("unit_price_discount")
        )
    }


def resolve_fact(
    staged: DataFrame,
    dims: Mapping[str, DataFrame],
    as_of: bool = False,
    sides: Mapping[str, DataFrame] | None = None,
    row: str | None = None,
) -> DataFrame:
    """Add date keys, surrogate keys, cost and discount amount to staged lines.

    ``dims`` maps dimension names to frames; only those are looked up.  By default a line
    takes the version current at load time; ``as_of`` takes the version in force on the
    order date for the versioned dimensions.  ``sides`` may pass their ``lookup_sides``.  ``row`` may
    name a column that tells the rows of ``staged``, a written table, apart; then lines are shuffled
    once, by it, for all members that are too many to be broadcast.
    """
    fact = staged.withColumns(
        {
            **{key: date_key(F.col(day)) for day, key in DATE_ROLES.items()},
            **line_measures(),
            "source_modified_at": F.col("modified_at"),
        }
    )
    sides = lookup_sides(dims, as_of) if sides is None else sides
    apart = {name: side for name, side in sides.items() if row and beyond_broadcast(side)}
    if apart:
        fact = fact.join(_found_apart(staged, apart, row), row)
    for name, dim in dims.items():
        if name in apart:
            continue
        spec = BY_NAME[name]
        if name in sides:
            fact = join_side(fact, sides[name], spec.business_key, spec.key)
        else:
            fact = lookup_as_of(
                fact, dim, spec.business_key, "order_date", spec.key, spec.fact_attributes
            )
        fact = _without_gaps(fact, spec)
    return fact


def late_keys(staged: DataFrame, sides: Mapping[str, DataFrame]) -> DataFrame:
    """What ``resolve_fact`` adds from some lookup sides, by natural key and order date.

    For sides that are too large to be broadcast: only these few columns are shuffled by each
    business key, and the wide lines are not.
    """
    day = date_key(F.col("order_date")).alias("order_date_key")
    return _found_apart(staged, sides, NATURAL_KEY, day)


def _found_apart(
    staged: DataFrame, sides: Mapping[str, DataFrame], *kept: str | Column
) -> DataFrame:
    """What lookup sides add to staged lines, beside a few columns of theirs."""
    kept = staged.select(*kept, *[BY_NAME[name].business_key for name in sides])
    found, added = kept, []
    for name, side in sides.items():
        spec = BY_NAME[name]
        found = _without_gaps(join_side(found, side, spec.business_key, spec.key), spec)
        added += [spec.key, *spec.fact_attributes.values()]
    return found.select(*kept.columns[: -len(sides)], *added)


def existing_keys(fact: DataFrame, incoming: DataFrame) -> DataFrame:
    """Natural key, surrogate key and order date of the rows a batch will overwrite.

    ``fact`` may be the fact itself, or the index of its keys.
    """
    return fact.select(NATURAL_KEY, FACT_KEY, "order_date_key").join(
        incoming.select(NATURAL_KEY), NATURAL_KEY, "left_semi"
    )


def written_rows(
    incoming: DataFrame, known: DataFrame, number: str = "row_number", start: int = 0,
    late: DataFrame | None = None, lines: DataFrame | None = None,
) -> DataFrame:
    """``incoming`` with its surrogate keys, and ``_old_date_key`` of the rows it takes the place of.

    A row that exists keeps its key; a new one takes ``start + number``.  ``late`` has columns that
    ``incoming`` lacks, in one row for each natural key, and joins in the shuffle that ``known`` does.
    ``lines`` may pass the written rows that ``incoming`` was made of, by ``number``; then only their
    keys are shuffled to find old ones, where these are too many to be broadcast.
    """
    old = known.select(
        F.col(NATURAL_KEY).alias("_id"), F.col(FACT_KEY).alias("_key"),
        F.col("order_date_key").alias("_old_date_key"),
    )
    is_old = F.col(NATURAL_KEY) == F.col("_id")
    if lines is not None and beyond_broadcast(known):
        found = lines.select(number, NATURAL_KEY).join(old, is_old, "left")
        rows = incoming.join(found.select(number, "_key", "_old_date_key"), number)
    else:
        rows = incoming.join(old, is_old, "left")
    rows = rows.withColumn(
        FACT_KEY, F.coalesce("_key", F.lit(start) + F.col(number)).cast("long")
    )
    return rows if late is None else rows.join(late.drop("order_date_key"), NATURAL_KEY)


def fact_upsert(
    fact: DataFrame,
    incoming: DataFrame,
    loaded_at: Column,
    number: str = "row_number",
    start: int = 0,
    known: DataFrame | None = None,
    lines: DataFrame | None = None,
) -> DataFrame:
    """``fact`` after inserting or overwriting the rows of ``incoming`` by natural key.

    A row that exists keeps its surrogate key; a new one takes ``start + number``.
    ``known`` may pass the keys of the rows to be overwritten, when ``fact`` holds only the
    partitions that the batch touches, or when they have been written already; if they are too many
    to be broadcast, rows of ``fact`` are then kept where they are read.  ``lines``: see
    ``written_rows``.
    """
    columns = schema(FACT_TABLE).fieldNames()
    large = known is not None and beyond_broadcast(known)
    known = existing_keys(fact, incoming) if known is None else known
    written = written_rows(incoming, known, number, start, lines=lines).withColumn(
        "loaded_at", loaded_at
    )
    if large:
        untouched = exact_keys(fact, known, NATURAL_KEY).others(fact)
    else:
        untouched = fact.join(known.select(NATURAL_KEY), NATURAL_KEY, "left_anti")
    return untouched.select(columns).unionByName(written.select(columns))


def moved_marks(
    keys: DataFrame, known: DataFrame, part: Column, every: bool = False
) -> DataFrame:
    """Where to look for batch rows whose old row lies in another part than they do.

    ``keys``: natural key and order date of the batch.  Gives the natural key and the old
    surrogate key twice, with the old ``part`` and with the new one.  With ``every``, rows that
    stay in their part have a mark there as well, so that no old row is needed for its key.
    """
    old = known.select(NATURAL_KEY, FACT_KEY, part.alias("_old_part"))
    new = keys.select(NATURAL_KEY, part.alias("_new_part"))
    both = old.join(new, NATURAL_KEY)
    places = F.array("_old_part", "_new_part")
    if every:
        places = F.array_distinct(places)
    else:
        both = both.where("_old_part != _new_part")
    return both.select(NATURAL_KEY, FACT_KEY, F.explode(places).alias("part"))


def placed_upsert(
    old: DataFrame,
    new: DataFrame,
    part: Column,
    slices: int,
    marks: DataFrame | None = None,
    late: DataFrame | None = None,
    replaced: KeyFilter | ExactKeys | None = None,
    derived: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``old`` after ``new`` rows took the place of those with their natural key, by part.

    The rule is that of ``fact_upsert``: ``new`` has a fresh surrogate key in each row, and loses
    it to the key of the row it takes the place of.  ``marks`` (natural key, surrogate key, part)
    tell of rows that change their part.  ``late`` has columns that ``new`` lacks, in one row for
    each of its rows, with the natural key and what ``part`` needs.  Old and new rows go through
    one shuffle, by part and by ``slices`` of it, in which neighbouring keys stay together; they
    find each other where they are written, so no row is shuffled again for a join or for the
    write.  The result has a column ``part``, and its rows lie by it.

    ``replaced`` tells of the natural keys of all old rows that go.  Other old rows lie in their
    part already, so they are written from where they are read.  If it tells exactly, ``marks`` have
    every row that goes, and such rows are not shuffled either.  ``derived`` columns follow from
    others of a new row; they are computed where it is written, not shuffled with it.
    """
    columns, derived = old.columns, dict(derived or {})
    new = new.drop(*derived)
    if isinstance(replaced, ExactKeys):
        _, old, kept = replaced.split(old)
    elif replaced is not None:
        old, kept = replaced.split(old, NATURAL_KEY)
    lacking = [c for c in columns if c not in new.columns and c not in derived]
    filled = [] if late is None else lacking
    present = [c for c in columns if c not in filled]
    carried = [c for c in present if c not in derived]
    shared = [c for c in _OF_ORDER if c in present]
    own = [c for c in present if c not in (NATURAL_KEY, *shared)]
    side_by_side = [NATURAL_KEY, *filled, *own, *shared]
    rows = [
        (old.select(*side_by_side).withColumn("part", part), _OLD),
        (new.select(carried).withColumn("part", part), _NEW),
    ]
    if marks is not None:
        rows.append((marks, _MARK))
    if filled:
        rows.append((late.withColumn("part", part).select(NATURAL_KEY, *filled, "part"), _LATE))
    tagged = [df.withColumn("_kind", F.lit(kind)) for df, kind in rows]
    gathered = tagged[0]
    for df in tagged[1:]:
        gathered = gathered.unionByName(df, allowMissingColumns=True)
    run = F.pmod(F.floor(F.col(NATURAL_KEY) / F.lit(NEIGHBOURS)), F.lit(slices))
    same = Window.partitionBy("part", "_slice", NATURAL_KEY)
    kept_key = F.max(F.when(F.col("_kind") < _NEW, F.col(FACT_KEY))).over(same)
    is_new = F.col("_kind") == _NEW
    found = (
        gathered.repartition("part", run)
        .withColumn("_slice", run)
        .withColumns({
            "_kept_key": kept_key, "_newest": F.max("_kind").over(same),
            **{
                f"_late_{c}": F.max(F.when(F.col("_kind") == _LATE, F.col(c))).over(same)
                for c in filled
            },
        })
        .where((F.col("_kind") == _NEW) | (F.col("_newest") == _OLD))
    )
    key = F.when(is_new, F.coalesce("_kept_key", FACT_KEY)).otherwise(F.col(FACT_KEY))
    late_values = {
        c: F.when(is_new, F.col(f"_late_{c}")).otherwise(F.col(c)) for c in filled
    }
    derived_values = {
        c: F.when(is_new, value).otherwise(F.col(c)) for c, value in derived.items()
    }
    upserted = found.withColumns({FACT_KEY: key, **late_values, **derived_values}).select(
        *columns, "part"
    )
    if replaced is None:
        return upserted
    return upserted.unionByName(kept.withColumn("part", part).select(*columns, "part"))


def sales_measures(fact: DataFrame, keys: Sequence[str], **measures: Column) -> DataFrame:
    """Pre-aggregate a fact by surrogate keys, so that joins see one row per key."""
    return fact.groupBy(*keys).agg(*[m.alias(name) for name, m in measures.items()])
