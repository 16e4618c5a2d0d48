"""Registered queries.  Each takes a session and a folder of Parquet tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starwright.functions.calendar import fiscal_quarter, fiscal_year
from starwright.functions.scalars import (
    date_key,
    date_or_null,
    later_of,
    nan_to_null,
    row_hash,
)
from starwright.operators import quality
from starwright.operators.calendar import calendar_for, insert_missing_days
from starwright.operators.dedup import keep_latest
from starwright.operators.fact import existing_keys, fact_upsert, resolve_fact
from starwright.operators.joins import may_meet
from starwright.operators.keys import (
    dense_numbers,
    last_key,
    number_in_order,
    seed_unknown,
    stamp_rows,
)
from starwright.operators.lookup import lookup_as_of, lookup_current
from starwright.operators.orders import order_groups, order_totals
from starwright.operators.scd import scd2_classify, scd2_merge, scd2_replay
from starwright.operators.shaping import (
    changed_since,
    conform_to_schema,
    date_range,
    next_watermark,
    rename_guarded,
)
from starwright.plans import constraints, kpis, layout, pipeline
from starwright.plans.control import Control
from starwright.plans.model import (
    BY_NAME,
    DATE_ROLES,
    DIMENSIONS,
    FACT_KEY,
    FACT_TABLE,
    NATURAL_KEY,
    ORDERS_TABLE,
)
from starwright.plans.pipeline import CALENDAR, run
from starwright.plans.star import load_dimension, load_fact, load_star, merge_dimension
from starwright.plans.star import seeded_dimension
from starwright.schemas import OPEN_START, empty_frame, schema
from starwright.session import (
    materialize,
    passing_scratch,
    release,
    scratch_path,
    together,
)
from starwright.sources.extracts import (
    SOURCES,
    Window,
    customers,
    first_address,
    mark_column,
    order_lines,
)
from starwright.sources.fixture import FIRST, PLAIN, SECOND, SourceTables, given_table
from starwright.sources.readers import select_as
from starwright.sources.store import WATERMARK, TableStore

Query = Callable[[SparkSession, str], DataFrame]

DAY_ONE, DAY_TWO, DAY_THREE = "2024-01-01", "2024-02-01", "2024-03-01"
# Load days inside the span of the order dates, for point-in-time lookups.
EARLY, LATE = "1997-01-01", "1999-01-01"

QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = lambda spark, directory: portable(function(spark, directory))
        return function

    return register


def portable(df: DataFrame) -> DataFrame:
    """Types that compare alike in every engine: money as double, days and moments as text."""

    def shown(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.IntegerType):
            column = column.cast("long")
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.TimestampNTZType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        return column.alias(field.name)

    return df.select([shown(f) for f in df.schema])


def _merged_twice(
    spark: SparkSession, directory: str, name: str, first_day: str, second_day: str,
    first_from: str | None = None,
) -> DataFrame:
    """A dimension after a load of the first and one of the second source state."""
    spec = BY_NAME[name]
    before = load_dimension(
        spark, SourceTables(spark, directory, FIRST), name, first_day, first_from
    )
    staged = SOURCES[name].staged(SourceTables(spark, directory, SECOND))
    return merge_dimension(before, staged, spec, second_day, first_from)


def _lines(spark: SparkSession, directory: str, snapshot: str = PLAIN) -> DataFrame:
    return SOURCES["order_line"].staged(SourceTables(spark, directory, snapshot))


# --- sources and shaping --------------------------------------------------------------


def _register_sources() -> None:
    for name, source in SOURCES.items():

        def staged(spark, directory, source=source):
            return source.staged(SourceTables(spark, directory))

        query(f"source_{name}")(staged)


_register_sources()


@query("schema_rename_guarded")
def _(spark, directory):
    old = customers(SourceTables(spark, directory)).select(
        "customer_id", F.col("customer_name").alias("person_name")
    )
    renamed = rename_guarded(old, "person_name", "customer_name")
    return rename_guarded(renamed, "person_name", "customer_name")


@query("seed_unknown_member")
def _(spark, directory):
    tables = SourceTables(spark, directory)
    shown = []
    for spec in DIMENSIONS:
        label = next(iter(spec.unknown))
        dim = seeded_dimension(spark, spec)
        known = SOURCES[spec.name].staged(tables).select(
            F.col(spec.business_key).alias(spec.key), spec.business_key, label
        )
        dim = dim.select(spec.key, spec.business_key, label).unionByName(known)
        full = conform_to_schema(dim, spec.table)
        again = seed_unknown(full, spec.table, spec.key, spec.business_key, spec.unknown)
        shown.append(
            again.groupBy(
                F.lit(spec.name).alias("dimension"),
                (F.col(spec.key) == -1).alias("is_unknown"),
            ).agg(
                F.count(F.lit(1)).alias("members"),
                F.min(F.when(F.col(spec.key) == -1, F.col(label))).alias("unknown_label"),
            )
        )
    result = shown[0]
    for part in shown[1:]:
        result = result.unionByName(part)
    return result


@query("conform_to_schema")
def _(spark, directory):
    raw = select_as(
        given_table(spark, directory, "orders"),
        order_line_id="o_orderkey",
        order_number="o_orderkey",
        order_date="o_orderdate",
        customer_id="o_custkey",
        line_total="o_totalprice",
        unit_price="CAST(o_totalprice AS STRING)",
        modified_at="o_orderdate",
        not_declared="o_orderstatus",
    )
    return conform_to_schema(raw, "stg.order_line").drop("tax_amount", "freight")


@query("column_defaults")
def _(spark, directory):
    raw = select_as(
        given_table(spark, directory, "customer"),
        customer_key="c_custkey",
        customer_id="c_custkey",
        customer_name="c_name",
        valid_from="CASE WHEN c_custkey % 2 = 0 THEN DATE '2020-01-01' END",
    )
    return conform_to_schema(raw, "dw.dim_customer").select(
        "customer_id", "customer_name", "city", "valid_from", "valid_to", "is_current"
    )


@query("incremental_filter")
def _(spark, directory):
    product = SourceTables(spark, directory, SECOND)["product"]
    return changed_since(product, ["modified_at"], mark_column("2023-06-30 00:00:00")).select(
        "product_id", "modified_at"
    )


@query("incremental_filter_multi")
def _(spark, directory):
    tables = SourceTables(spark, directory)
    return order_lines(tables, Window("2000-06-01 00:00:00")).select(
        "order_line_id", "product_id", "employee_id", "modified_at"
    )


@query("later_timestamp")
def _(spark, directory):
    tables = SourceTables(spark, directory)
    line = tables["order_detail"].select(
        "order_id", "order_line_id", F.col("ship_date").alias("line_moment")
    )
    header = tables["order_header"].select("order_id", F.col("modified_at").alias("order_moment"))
    joined = line.join(header, "order_id")
    return joined.select(
        "order_line_id",
        later_of(F.col("line_moment"), F.col("order_moment")).alias("later"),
        later_of(F.col("order_moment"), F.col("line_moment")).alias("later_swapped"),
    )


@query("allocate_tax_freight")
def _(spark, directory):
    return _lines(spark, directory).select(
        "order_line_id", "line_total", "tax_amount", "freight"
    )


@query("date_smart_key")
def _(spark, directory):
    return given_table(spark, directory, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        date_key(F.col("l_shipdate")).alias("ship_key"),
        date_key(F.when(F.col("l_returnflag") != "N", F.col("l_shipdate"))).alias(
            "returned_key"
        ),
    )


@query("row_hash")
def _(spark, directory):
    staged = SOURCES["customer"].staged(SourceTables(spark, directory))
    tracked = [F.col(a) for a in BY_NAME["customer"].attributes]
    return staged.select(
        "customer_id",
        row_hash(tracked).alias("row_hash"),
        row_hash(tracked, strict=True).alias("strict_hash"),
    )


@query("fact_discount_amount")
def _(spark, directory):
    return resolve_fact(_lines(spark, directory), {}).select(
        "order_line_id", "unit_price", "quantity", "unit_price_discount", "discount_amount"
    )


@query("fiscal_calendar")
def _(spark, directory):
    day = F.to_date("o_orderdate")
    return (
        given_table(spark, directory, "orders")
        .select(day.alias("order_day"))
        .distinct()
        .select(
            "order_day",
            fiscal_year(F.col("order_day")).alias("fiscal_year"),
            fiscal_quarter(F.col("order_day")).alias("fiscal_quarter"),
        )
    )


@query("tolerant_dates")
def _(spark, directory):
    texts = select_as(
        given_table(spark, directory, "orders"),
        order_id="o_orderkey",
        day_text="CASE WHEN o_orderkey % 10 = 0 THEN o_orderpriority"
        " WHEN o_orderkey % 10 = 1 THEN NULL"
        " ELSE date_format(o_orderdate, 'yyyy-MM-dd') END",
    )
    return texts.select("order_id", date_or_null(F.col("day_text")).alias("order_day")).dropna()


@query("nan_to_null")
def _(spark, directory):
    raw = select_as(
        given_table(spark, directory, "events"),
        event_id="event_id",
        reading="CASE WHEN event_type = 'error' THEN double('NaN') ELSE value END",
    )
    return raw.select("event_id", nan_to_null(F.col("reading")).alias("reading"))


# --- lookups --------------------------------------------------------------------------


@query("lookup_scd2_current")
def _(spark, directory):
    dim = _merged_twice(spark, directory, "customer", DAY_ONE, DAY_TWO)
    return lookup_current(
        _lines(spark, directory), dim, "customer_id", "customer_key"
    ).select("order_line_id", "customer_id", "customer_key")


@query("lookup_scd1")
def _(spark, directory):
    tables = SourceTables(spark, directory, FIRST)
    dim = load_dimension(spark, tables, "territory", DAY_ONE)
    return lookup_current(
        _lines(spark, directory), dim, "territory_id", "territory_key"
    ).select("order_line_id", "territory_id", "territory_key")


@query("lookup_cost")
def _(spark, directory):
    tables = SourceTables(spark, directory, FIRST)
    dim = load_dimension(spark, tables, "product", DAY_ONE)
    return resolve_fact(_lines(spark, directory), {"product": dim}).select(
        "order_line_id", "product_id", "product_key", "standard_cost"
    )


@query("lookup_scd2_asof")
def _(spark, directory):
    dim = _merged_twice(spark, directory, "product", EARLY, LATE, OPEN_START)
    return resolve_fact(_lines(spark, directory), {"product": dim}, as_of=True).select(
        "order_line_id", "order_date", "product_key", "standard_cost"
    )


@query("lookup_asof_events")
def _(spark, directory):
    events = given_table(spark, directory, "events")
    versions = _replayed(events)
    numbered = number_in_order(versions, ["user_id", "valid_from"], "version_key", 0)
    asked = events.select("event_id", "user_id", F.to_date("ts").alias("event_day"))
    return lookup_as_of(
        asked, numbered, "user_id", "event_day", "version_key", {"event_type": "type_in_force"}
    ).select("event_id", "version_key", "type_in_force")


# --- aggregates, de-duplication, keys -------------------------------------------------


@query("next_watermark")
def _(spark, directory):
    return next_watermark(_lines(spark, directory))


@query("date_range")
def _(spark, directory):
    return date_range(_lines(spark, directory), list(DATE_ROLES))


@query("first_address_per_customer")
def _(spark, directory):
    tables = SourceTables(spark, directory)
    lowest = first_address(tables["entity_address"]).withColumnRenamed("entity_id", "person_id")
    return tables["customer"].join(lowest, "person_id", "left").select(
        "customer_id", "address_id"
    )


@query("dedup_keep_last")
def _(spark, directory):
    detail = SourceTables(spark, directory)["order_detail"]
    ties = ("product_id", "employee_id", "line_total", "quantity")
    return keep_latest(detail, [NATURAL_KEY], tie_break=ties).select(
        "order_line_id", "modified_at", "product_id", "employee_id", "quantity", "line_total"
    )


@query("surrogate_keys")
def _(spark, directory):
    known = given_table(spark, directory, "customer").select(
        F.col("c_custkey").alias("customer_id")
    )
    return number_in_order(known, ["customer_id"], "customer_key", 100)


# --- merges ---------------------------------------------------------------------------


@query("scd1_upsert")
def _(spark, directory):
    return _merged_twice(spark, directory, "territory", DAY_ONE, DAY_TWO)


def _register_scd1() -> None:
    for name in ("promotion", "ship_method", "territory"):

        def loaded(spark, directory, name=name):
            return load_dimension(spark, SourceTables(spark, directory), name, DAY_ONE)

        query(f"dim_{name}")(loaded)


_register_scd1()


def _register_scd2() -> None:
    for name in ("customer", "product", "salesperson"):

        def merged(spark, directory, name=name):
            return _merged_twice(spark, directory, name, DAY_ONE, DAY_TWO)

        query(f"dim_{name}")(merged)


_register_scd2()


def _classified(spark: SparkSession, directory: str, load_date: str) -> DataFrame:
    spec = BY_NAME["customer"]
    before = load_dimension(spark, SourceTables(spark, directory, FIRST), spec.name, DAY_ONE)
    staged = SOURCES[spec.name].staged(SourceTables(spark, directory, SECOND))
    return scd2_classify(
        before, staged, spec.business_key, spec.key, spec.attributes, load_date
    )


@query("scd2_classify")
def _(spark, directory):
    return _classified(spark, directory, DAY_TWO).select("customer_id", "customer_key", "action")


@query("scd2_classify_one_current")
def _(spark, directory):
    """A damaged dimension, in which every key has two current versions."""
    spec = BY_NAME["customer"]
    before = load_dimension(spark, SourceTables(spark, directory, FIRST), spec.name, DAY_ONE)
    again = before.withColumn(spec.key, F.col(spec.key) + 1_000_000_000)
    staged = SOURCES[spec.name].staged(SourceTables(spark, directory, SECOND))
    return scd2_classify(
        before.unionByName(again), staged, spec.business_key, spec.key, spec.attributes, DAY_TWO
    ).select("customer_id", "customer_key", "action")


@query("scd2_merge")
def _(spark, directory):
    """Three loads: a first one, a change, and the change taken back."""
    spec = BY_NAME["customer"]
    third = "2024-03-01"
    merged = materialize(
        _merged_twice(spark, directory, spec.name, DAY_ONE, DAY_TWO), "twice"
    )
    staged = SOURCES[spec.name].staged(SourceTables(spark, directory, PLAIN))
    return scd2_merge(merged, staged, spec.business_key, spec.key, spec.attributes, third)


def _versions_of(spark: SparkSession, directory: str, action: str) -> DataFrame:
    """The versions, after a second load, of the customers that needed ``action``."""
    spec = BY_NAME["customer"]
    merged = _merged_twice(spark, directory, spec.name, DAY_ONE, DAY_TWO)
    chosen = _classified(spark, directory, DAY_TWO).where(F.col("action") == action)
    return merged.join(chosen.select(spec.business_key), spec.business_key, "left_semi")


@query("scd2_new")
def _(spark, directory):
    return _versions_of(spark, directory, "NEW")


@query("scd2_unchanged")
def _(spark, directory):
    return _versions_of(spark, directory, "UNCHANGED")


@query("scd2_new_version")
def _(spark, directory):
    return _versions_of(spark, directory, "CHANGED")


@query("scd2_same_day")
def _(spark, directory):
    return _merged_twice(spark, directory, "customer", DAY_ONE, DAY_ONE)


def _replayed(events: DataFrame) -> DataFrame:
    return scd2_replay(events, "user_id", "ts", ["event_type"], ["event_id"])


@query("scd2_replay_events")
def _(spark, directory):
    return _replayed(given_table(spark, directory, "events"))


def _upserted(
    fact: DataFrame, staged: DataFrame, dims: dict[str, DataFrame], day: str
) -> DataFrame:
    """The fact after a batch, with all lookups, written."""
    spark = fact.sparkSession
    with passing_scratch(spark):
        written = materialize(stamp_rows(staged), "staged-lines", compression="zstd")
        release(spark)
        lines = dense_numbers(written, "row_number", 0)
        incoming = resolve_fact(lines, dims, row="row_number")
        old = may_meet(fact, written, NATURAL_KEY)
        known = materialize(existing_keys(old, written), "known-keys", compression="zstd")
        start = last_key(fact, FACT_KEY)
        merged = fact_upsert(
            fact, incoming, mark_column(day), start=start, known=known, lines=lines
        )
        fact = materialize(merged, "fact", lasting=True, compression="zstd")
    release(spark)
    return fact


def _key_properties(fact: DataFrame) -> DataFrame:
    """What holds of fact keys whatever their order: each is positive and occurs once."""
    # Only keys that occur again are joined, so that the fact itself is not shuffled for it.
    again = quality.duplicate_keys(fact.select(FACT_KEY), [FACT_KEY])
    copies = materialize(again, "key-copies").select(
        F.col(FACT_KEY).alias("_key"), F.col("rows").alias("_copies")
    )
    return (
        fact.where(F.col(FACT_KEY).isNotNull())
        .join(copies, F.col(FACT_KEY) == F.col("_key"), "left")
        .withColumn("key_copies", F.coalesce("_copies", F.lit(1).cast("long")))
        .drop("_key", "_copies")
        .withColumn("key_is_positive", F.col(FACT_KEY) > 0)
    )


@query("fact_upsert")
def _(spark, directory):
    """Two loads, each with the versions current at its time."""
    before, after = (SourceTables(spark, directory, s) for s in (FIRST, SECOND))

    def first_load(name: str) -> DataFrame:
        return load_dimension(spark, before, name, DAY_ONE)

    def second_load(name: str) -> DataFrame:
        merged = merge_dimension(one[name], SOURCES[name].staged(after), BY_NAME[name], DAY_TWO)
        return materialize(merged, f"dim-{name}")

    one = together(first_load, list(BY_NAME))
    two = together(second_load, list(BY_NAME))
    nothing = empty_frame(spark, schema(FACT_TABLE))
    first = _upserted(nothing, _lines(spark, directory, FIRST), one, DAY_ONE)
    changed = SOURCES["order_line"].staged(after, DAY_ONE)
    second = _upserted(first, changed, two, DAY_TWO)
    kept = first.select(NATURAL_KEY, F.col(FACT_KEY).alias("old_key"))
    highest = F.lit(last_key(first, FACT_KEY))
    return _key_properties(second).join(kept, NATURAL_KEY, "left").select(
        NATURAL_KEY,
        "order_date_key",
        *[spec.key for spec in DIMENSIONS],
        "standard_cost",
        "quantity",
        "line_total",
        "loaded_at",
        "key_is_positive",
        "key_copies",
        F.col(FACT_KEY).eqNullSafe(F.col("old_key")).alias("kept_key"),
        (F.col(FACT_KEY) > highest).alias("above_old_keys"),
    )


# --- calendar and fact ----------------------------------------------------------------


@query("dim_date")
def _(spark, directory):
    return calendar_for(_lines(spark, directory), list(DATE_ROLES))


@query("calendar_insert_missing")
def _(spark, directory):
    lines = _lines(spark, directory)
    # Days that are already there carry plain numbers as labels and must keep them.
    numbers = [str(n) for n in range(1, 13)]
    present = calendar_for(lines, ["order_date"]).withColumns(
        {
            "day_name": F.element_at(F.array(*map(F.lit, numbers)), F.col("day_of_week")),
            "month_name": F.element_at(F.array(*map(F.lit, numbers)), F.col("month_number")),
        }
    )
    return insert_missing_days(present, calendar_for(lines, list(DATE_ROLES)))


@query("fact_sales")
def _(spark, directory):
    tables = SourceTables(spark, directory)
    dims = together(lambda n: load_dimension(spark, tables, n, DAY_ONE), list(BY_NAME))
    nothing = empty_frame(spark, schema(FACT_TABLE))
    fact = _upserted(nothing, _lines(spark, directory), dims, DAY_ONE)
    return _key_properties(fact).drop(FACT_KEY)


# --- indicators -----------------------------------------------------------------------


def _order_days(tables: SourceTables) -> DataFrame:
    return calendar_for(tables["order_header"], ["order_date"])


def _order_and_ship_days(tables: SourceTables) -> DataFrame:
    days = tables["order_header"].select(F.col("order_date").alias("day")).union(
        tables["order_detail"].select("ship_date")
    )
    return calendar_for(days, ["day"])


def _register_calendar_kpis() -> None:
    indicators = {
        "kpi01_revenue_by_month": kpis.revenue_by_month,
        "kpi03_items_by_quarter": kpis.items_by_quarter,
        "kpi05_discount_rate": kpis.discount_rate,
        "kpi09_mom_growth": kpis.month_over_month_growth,
    }
    for name, indicator in indicators.items():

        def computed(spark, directory, indicator=indicator):
            tables = SourceTables(spark, directory)
            return indicator(load_fact(tables, {}), _order_days(tables))

        query(name)(computed)


_register_calendar_kpis()


def _register_dimension_kpis() -> None:
    indicators = {
        "kpi04_margin_by_category": (kpis.margin_by_category, "product"),
        "kpi07_top_products": (kpis.top_products, "product"),
    }
    for name, (indicator, dimension) in indicators.items():

        def computed(spark, directory, indicator=indicator, dimension=dimension):
            tables = SourceTables(spark, directory)
            fact, dims = load_star(spark, tables, [dimension], DAY_ONE)
            return indicator(fact, dims[dimension])

        query(name)(computed)


_register_dimension_kpis()


def _register_order_kpis() -> None:
    """Indicators with numbers of orders, from written totals by order."""
    indicators = {
        "kpi02_average_ticket": (kpis.average_ticket, None),
        "kpi06_sales_by_territory": (kpis.sales_by_territory, "territory"),
        "kpi08_salesperson": (kpis.salesperson_performance, "salesperson"),
    }
    for name, (indicator, dimension) in indicators.items():

        def computed(spark, directory, indicator=indicator, dimension=dimension):
            tables = SourceTables(spark, directory)
            fact, dims = load_star(spark, tables, ["territory", "salesperson"], DAY_ONE)
            orders = materialize(order_totals(fact), "orders")
            return indicator(orders, dims[dimension] if dimension else _order_days(tables))

        query(name)(computed)


_register_order_kpis()


@query("kpi10_lead_time")
def _(spark, directory):
    tables = SourceTables(spark, directory)
    fact, dims = load_star(spark, tables, ["territory"], DAY_ONE)
    return kpis.lead_time_by_territory(fact, _order_and_ship_days(tables), dims["territory"])


# --- data quality ---------------------------------------------------------------------


@query("dq_unique")
def _(spark, directory):
    detail = SourceTables(spark, directory)["order_detail"]
    return quality.duplicate_keys(detail, [NATURAL_KEY])


@query("dq_referential")
def _(spark, directory):
    tables, before = SourceTables(spark, directory), SourceTables(spark, directory, FIRST)
    fact = resolve_fact(tables["order_detail"].join(tables["order_header"].drop("modified_at"),
                                                    "order_id"), {})
    days = calendar_for(tables["order_header"], ["order_date"])
    parents = {
        day_key: (days, "date_key") for day_key in DATE_ROLES.values()
    } | {
        spec.business_key: (SOURCES[spec.name].staged(before), spec.business_key)
        for spec in DIMENSIONS
    }
    return quality.orphan_references(fact, parents)


@query("dq_not_null")
def _(spark, directory):
    unresolved = _lines(spark, directory).withColumns(
        {spec.key: F.col(spec.business_key) for spec in DIMENSIONS}
    )
    fact = resolve_fact(unresolved, {})
    return quality.null_violations(fact, FACT_TABLE)


@query("dq_scd2_intervals")
def _(spark, directory):
    claimed = select_as(
        given_table(spark, directory, "events"),
        user_id="user_id",
        valid_from="CAST(ts AS DATE)",
        valid_to="CASE event_type WHEN 'error' THEN DATE '9999-12-31'"
        " WHEN 'signup' THEN CAST(ts AS DATE) ELSE date_add(CAST(ts AS DATE), 1) END",
        is_current="event_type IN ('error', 'signup')",
    ).distinct()
    return quality.interval_violations(claimed, "user_id").groupBy("rule").agg(
        F.count(F.lit(1)).alias("versions"), F.count_distinct("user_id").alias("users")
    )


@query("dq_fits_type")
def _(spark, directory):
    raw = select_as(
        given_table(spark, directory, "documents"),
        special_offer_id="doc_id",
        description="text",
        promotion_type="source",
        promotion_category="lang",
        discount_pct="CAST(n_chars AS DECIMAL(20,4)) / 100",
    )
    return quality.type_violations(raw, "dw.dim_promotion")


def _broken(violations: Callable[[TableStore], DataFrame]) -> Query:
    """A constraint report over a stored warehouse after two loads."""
    def report(spark, directory):
        return violations(_loaded(spark, directory, _TWO_BATCHES))

    return report


query("dq_unique_star")(_broken(constraints.unique_violations))
query("dq_validity_star")(_broken(constraints.interval_violations))
query("dq_referential_star")(_broken(constraints.reference_violations))
query("dq_not_null_star")(_broken(constraints.required_violations))


@query("dq_star_after_damage")
def _(spark, directory):
    """All constraints, in a warehouse that lost a dimension's members and copied a part."""
    store = _loaded(spark, directory, [(PLAIN, DAY_ONE, False)])
    territory = store.read("dw.dim_territory")
    store.replace("dw.dim_territory", territory.where("territory_key % 5 <> 0"))
    store.replace("dw.dim_promotion", store.read("dw.dim_promotion").unionByName(
        store.read("dw.dim_promotion").where("promotion_key = 2")))
    store.replace("dw.dim_ship_method", store.read("dw.dim_ship_method").withColumn(
        "ship_method_id", F.expr("CASE WHEN ship_method_key > 0 THEN ship_method_id END")))
    return constraints.all_violations(store).where("violations > 0")


@query("dq_business_key_damage")
def _(spark, directory):
    """Twins that a check after a load must find: in two dimensions and among the marks.

    A tenth of the customers get a second current version, half of the promotions a copy
    under another number, and the customers' mark is written twice.
    """
    store = _loaded(spark, directory, [(PLAIN, DAY_ONE, False)])
    store.note_checked()
    customer, promotion = BY_NAME["customer"], BY_NAME["promotion"]
    members = store.read(customer.table)
    twins = members.where("customer_id >= 0 AND customer_id % 10 = 0").withColumn(
        "customer_key", F.col("customer_key") + F.lit(store.last_key(customer.table))
    )
    part = layout.member_range("customer_id")
    store.replace_parts(customer.table, members.unionByName(twins), part, [])
    offers = store.read(promotion.table)
    copies = offers.where("special_offer_id > 0 AND special_offer_id % 2 = 0").withColumn(
        "promotion_key", F.col("promotion_key") + F.lit(last_key(offers, "promotion_key"))
    )
    store.replace(promotion.table, offers.unionByName(copies))
    mark = Control(store).watermarks().where("source_name = 'customer'").first()
    store.append(WATERMARK, [tuple(mark)])
    return constraints.all_violations(store, unchecked=True).where("violations > 0")


# --- the load as a whole --------------------------------------------------------------

def _loaded(
    spark: SparkSession,
    directory: str,
    loads: list[tuple[str, str, bool]],
) -> TableStore:
    """A stored warehouse after some loads of (source state, load date, full load)."""
    store = TableStore(spark, scratch_path(spark, "warehouse"))
    for snapshot, day, full_load in loads:
        run(
            spark, SourceTables(spark, directory, snapshot), store, day,
            datetime.fromisoformat(day), full_load=full_load,
        )
    return store


_TWO_BATCHES = [(FIRST, DAY_ONE, False), (SECOND, DAY_TWO, False)]


def _control(spark: SparkSession, directory: str) -> Control:
    return Control(_loaded(spark, directory, _TWO_BATCHES))


@query("stg_replace")
def _(spark, directory):
    store = _loaded(spark, directory, _TWO_BATCHES)
    parts = [
        store.read(source.staging).select(
            F.lit(name).alias("source_name"),
            F.col(source.business_key).alias("business_key"),
            "modified_at",
        )
        for name, source in SOURCES.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query("control_log_latest")
def _(spark, directory):
    return _control(spark, directory).latest_steps().select(
        "process", "step", "status", "rows_affected", "message"
    )


@query("step_log")
def _(spark, directory):
    return (
        _control(spark, directory)
        .latest_steps()
        .where(F.col("finished_at") >= F.col("started_at"))
        .groupBy("step", "status")
        .agg(F.count(F.lit(1)).alias("entries"), F.sum("rows_affected").alias("rows_affected"))
    )


@query("watermark_read")
def _(spark, directory):
    control = _control(spark, directory)
    control.watermark("returns")
    return control.watermarks().select("source_name", "last_extracted_at")


@query("watermark_upsert")
def _(spark, directory):
    return _control(spark, directory).watermarks().select(
        "source_name", "last_extracted_at", "status", "rows_processed"
    )


@query("watermark_null_mark")
def _(spark, directory):
    """Marks after a load, one whose changed lines have no time, and one with times again."""
    store = TableStore(spark, scratch_path(spark, "warehouse"))
    marks = []

    def load(tables: Mapping[str, DataFrame], day: str) -> None:
        run(spark, tables, store, day, datetime.fromisoformat(day))
        mark = Control(store).marks()["order_line"]
        marks.append(spark.range(1).select(F.lit(day).alias("load_date"),
                                           mark_column(mark).alias("mark")))

    load(SourceTables(spark, directory, FIRST), DAY_ONE)
    changed = SourceTables(spark, directory, SECOND)
    untimed = changed["order_header"].withColumn(
        "modified_at", F.lit(None).cast("timestamp_ntz")
    )
    load(dict(changed) | {"order_header": untimed}, DAY_TWO)
    load(changed, DAY_THREE)
    return marks[0].union(marks[1]).union(marks[2])


@contextmanager
def _failing(
    owner: object, name: str, when: Callable[..., bool] = lambda *_, **__: True
) -> Iterator[None]:
    """A step that dies, as if the driver were lost there, in the calls that ``when`` tells."""
    kept = getattr(owner, name)

    def fail(*given, **named):
        if when(*given, **named):
            raise RuntimeError("lost the driver")
        return kept(*given, **named)

    setattr(owner, name, fail)
    try:
        yield
    except RuntimeError:
        pass
    finally:
        setattr(owner, name, kept)


@query("pipeline_crash_before_mark")
def _(spark, directory):
    """A load that dies after publishing and before its marks move, then the same load again."""
    store = TableStore(spark, scratch_path(spark, "warehouse"))
    tables, moment = SourceTables(spark, directory), datetime.fromisoformat(DAY_ONE)
    with _failing(Control, "advance"):
        run(spark, tables, store, DAY_ONE, moment)
    run(spark, tables, TableStore(spark, store.root), DAY_ONE, moment)
    return _fact_content(TableStore(spark, store.root))


@query("step_log_error")
def _(spark, directory):
    """What the step log keeps of the step that fails in a whole load, and of the load."""
    store = TableStore(spark, scratch_path(spark, "warehouse"))
    tables = SourceTables(spark, directory)
    with _failing(pipeline, "load_dimension", lambda _, spec, *__: spec.name == "territory"):
        run(spark, tables, store, DAY_ONE)
    steps = Control(store).latest_steps()
    return steps.where(
        F.col("step").isin("extract_territory", "load_dim_territory", "run")
    ).select("step", "status", "rows_affected", "message")


@query("validate_row_counts")
def _(spark, directory):
    store = _loaded(spark, directory, [(PLAIN, DAY_ONE, False)])
    names = (FACT_TABLE, *(spec.table for spec in DIMENSIONS), CALENDAR)
    return quality.row_counts({name: store.read(name) for name in names})


def _fact_content(store: TableStore) -> DataFrame:
    return _key_properties(store.read(FACT_TABLE)).drop(FACT_KEY)


@query("pipeline_two_batches")
def _(spark, directory):
    return _fact_content(_loaded(spark, directory, _TWO_BATCHES))


@query("pipeline_merge_on_read")
def _(spark, directory):
    """A second batch kept as a delta: what is read before and after it has been folded."""
    store = _loaded(spark, directory, _TWO_BATCHES[:1])
    run(
        spark, SourceTables(spark, directory, SECOND), store, DAY_TWO,
        datetime.fromisoformat(DAY_TWO), merge_on_read=True,
    )
    kept_apart = _fact_content(store).withColumn("state", F.lit("delta"))
    pipeline.fold_deltas(store, always=True)
    return kept_apart.unionByName(_fact_content(store).withColumn("state", F.lit("folded")))


def _order_content(store: TableStore) -> DataFrame:
    return order_groups(store.read(ORDERS_TABLE)).withColumns(
        {
            "order_date_key": F.col("order_date_key").cast("long"),
            "revenue": F.col("revenue").cast("double"),
        }
    )


@query("order_totals_stored")
def _(spark, directory):
    """Totals by order after a first load, after a second kept as a delta, and after folding it."""
    store = _loaded(spark, directory, _TWO_BATCHES[:1])
    states = {"first": materialize(_order_content(store), "orders-first")}
    run(
        spark, SourceTables(spark, directory, SECOND), store, DAY_TWO,
        datetime.fromisoformat(DAY_TWO), merge_on_read=True,
    )
    states["delta"] = materialize(_order_content(store), "orders-delta")
    pipeline.fold_deltas(store, always=True)
    states["folded"] = _order_content(store)
    return reduce(
        DataFrame.unionByName,
        [rows.withColumn("state", F.lit(state)) for state, rows in states.items()],
    )


@query("schema_rename_stored")
def _(spark, directory):
    """A stored dimension of which a first generation has another name for a column.

    It is renamed in the store, loaded again, and read with parts of both generations.
    """
    spec = BY_NAME["customer"]
    alone = {"dimensions": (spec,), "with_fact": False}
    store = TableStore(spark, scratch_path(spark, "warehouse"))
    run(spark, SourceTables(spark, directory, FIRST), store, DAY_ONE, **alone)
    older = store.read(spec.table).withColumnRenamed("customer_name", "person_name")
    store.replace_parts(spec.table, older, layout.member_range("customer_id"), [])
    reopened = TableStore(spark, store.root)
    reopened.rename_column(spec.table, "person_name", "customer_name")
    run(spark, SourceTables(spark, directory, SECOND), reopened, DAY_TWO, **alone)
    return TableStore(spark, store.root).read(spec.table).select(
        "customer_id", "customer_name", "is_current",
        F.date_format("valid_from", "yyyy-MM-dd").alias("valid_from"),
    )


@query("pipeline_full_reload")
def _(spark, directory):
    twice = [(PLAIN, DAY_ONE, True), (PLAIN, DAY_TWO, True)]
    return _fact_content(_loaded(spark, directory, twice))
