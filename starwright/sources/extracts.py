"""The seven source models: from normalised order-processing tables to staging rows.

Each model takes the source tables by role and a window of modification times, and returns a
frame.  A filter on the root table is applied before the joins, so it reaches the scan.

The window is open at the mark of the last load and closed at a time chosen before anything is
read.  A row that changes while a load reads it has a later time than that, so it is left to
the next load, whichever of its states this one saw.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starwright.functions.scalars import allocate_share, full_name, later_of
from starwright.operators import quality
from starwright.operators.dedup import keep_latest, lowest_per_key
from starwright.operators.joins import left_join_sparse, may_meet
from starwright.operators.shaping import conform_to_schema, is_changed_since
from starwright.plans.model import DIMENSIONS, FACT_STAGING, LINE_TIE_BREAK, NATURAL_KEY
from starwright.schemas import OPEN_START
from starwright.session import materialize as written_once
from starwright.session import together

Tables = Mapping[str, DataFrame]
Moment = datetime | str

#: Changed rows are as many as a batch, so they are packed well.
materialize = partial(written_once, compression="zstd")

# Labels of a customer without a name, and the customer types.
UNNAMED_CUSTOMER = "Cliente desconhecido"
STORE_CUSTOMER, PERSON_CUSTOMER = "Store", "Individual"


def mark_column(moment: Moment) -> Column:
    """A watermark as a literal, so that it can be pushed down to the source."""
    return F.lit(str(moment)).cast("timestamp_ntz")


@dataclass(frozen=True)
class Window:
    """Modification times after ``since``, up to ``until`` if it is given."""

    since: Moment = OPEN_START
    until: Moment | None = None

    @property
    def from_start(self) -> bool:
        """Whether there is no mark yet, so that nearly every row is in the window."""
        return datetime.fromisoformat(str(self.since)) <= datetime.fromisoformat(OPEN_START)

    def has(self, *marks: Column) -> Column:
        end = None if self.until is None else mark_column(self.until)
        return is_changed_since(marks, mark_column(self.since), end)

    def changed(self, df: DataFrame) -> DataFrame:
        return df.where(self.has(F.col("modified_at")))


def first_address(entity_address: DataFrame) -> DataFrame:
    """Lowest address of each entity.

    Taken before the joins, so several addresses never multiply customers.
    """
    return lowest_per_key(entity_address, "entity_id", "address_id")


def customers(tables: Tables, window: Window = Window()) -> DataFrame:
    """Customer with name, type and first address; stores without a person have none."""
    person = tables["person"].select(
        F.col("entity_id").alias("person_id"),
        full_name(F.col("first_name"), F.col("last_name")).alias("person_name"),
    )
    store = tables["store"].select(F.col("entity_id").alias("store_id"), "store_name")
    address_of = first_address(tables["entity_address"]).withColumnRenamed(
        "entity_id", "person_id"
    )
    place = (
        tables["address"]
        .join(tables["state"], "state_id", "left")
        .join(tables["country"], "country_code", "left")
        .select("address_id", "city", "state_province", "country_region", "postal_code")
    )
    is_store = F.col("store_id").isNotNull()
    return (
        window.changed(tables["customer"])
        .join(person, "person_id", "left")
        .join(store, "store_id", "left")
        .transform(left_join_sparse, address_of, "person_id", "customer_id")
        .join(place, "address_id", "left")
        .select(
            "customer_id",
            F.coalesce("person_name", "store_name", F.lit(UNNAMED_CUSTOMER)).alias(
                "customer_name"
            ),
            "store_name",
            F.when(is_store, STORE_CUSTOMER).otherwise(PERSON_CUSTOMER).alias("customer_type"),
            "city",
            "state_province",
            "country_region",
            "postal_code",
            "modified_at",
        )
    )


def products(tables: Tables, window: Window = Window()) -> DataFrame:
    """Product with its subcategory and category flattened in."""
    category = tables["product_category"]
    subcategory = tables["product_subcategory"].join(category, "category_id", "left")
    return (
        window.changed(tables["product"])
        .join(
            subcategory.select("subcategory_id", "subcategory_name", "category_name"),
            "subcategory_id",
            "left",
        )
        .drop("subcategory_id")
    )


def salespeople(tables: Tables, window: Window = Window()) -> DataFrame:
    """Salesperson, changed when either the sales or the employee row changed."""
    seller, employee = tables["sales_person"].alias("s"), tables["employee"].alias("e")
    marks = [F.col("s.modified_at"), F.col("e.modified_at")]
    return (
        seller.join(employee, F.col("s.entity_id") == F.col("e.entity_id"))
        .where(window.has(*marks))
        .join(tables["person"].alias("p"), F.col("s.entity_id") == F.col("p.entity_id"))
        .select(
            F.col("s.entity_id").alias("employee_id"),
            full_name(F.col("p.first_name"), F.col("p.last_name")).alias("full_name"),
            "job_title",
            later_of(*marks).alias("modified_at"),
        )
    )


def territories(tables: Tables, window: Window = Window()) -> DataFrame:
    return window.changed(tables["territory"])


def promotions(tables: Tables, window: Window = Window()) -> DataFrame:
    return window.changed(tables["special_offer"])


def ship_methods(tables: Tables, window: Window = Window()) -> DataFrame:
    return window.changed(tables["ship_method"])


def _changed_lines(detail: DataFrame, header: DataFrame, window: Window) -> DataFrame:
    """Lines joined to their headers, where either row changed inside the window.

    The condition spans both tables, so it cannot be pushed below one join.  Instead the lines
    that changed meet all headers, and all other lines meet the headers that changed.  Both
    filters reach the scans; the changed rows are written, so their true size lets a small
    batch be broadcast, and neither large table is shuffled for it; for a larger one, only rows of
    its orders are.  A window from the start holds nearly all rows, so nothing is written for it.
    A line is in one branch only, whenever it is read: beyond the window it waits for the next load.
    """
    line, head = F.col("line_modified_at"), F.col("header_modified_at")
    # A line without a time, or from before the window, can only come with its header.
    settled = F.coalesce(line <= mark_column(window.since), F.lit(True))
    if window.from_start:
        # A condition on both tables stays above the join, so both joins share a shuffle of headers.
        return detail.where(window.has(line)).join(header, "order_id").unionByName(
            detail.where(settled).join(header, "order_id").where(
                window.has(line) | window.has(head)
            )
        )
    changed = {"lines": detail.where(window.has(line)), "headers": header.where(window.has(head))}
    new = together(lambda name: materialize(changed[name], f"changed-{name}"), list(changed))
    return new["lines"].join(
        may_meet(header, new["lines"], "order_id"), "order_id"
    ).unionByName(
        may_meet(detail.where(settled), new["headers"], "order_id").join(new["headers"], "order_id")
    )


def order_lines(tables: Tables, window: Window = Window()) -> DataFrame:
    """Order line with its header; tax and freight are shared out by line total.

    A descriptive column may live on the line or on the header.  ``order_id`` is kept for the
    de-duplication, which finds the lines of an order together already.
    """
    detail = tables["order_detail"].withColumnRenamed("modified_at", "line_modified_at")
    header = tables["order_header"].withColumnRenamed("modified_at", "header_modified_at")

    def share(amount: str) -> Column:
        return allocate_share(F.col(amount), F.col("line_total"), F.col("subtotal"))

    return _changed_lines(detail, header, window).select(
        "order_id",
        "order_line_id",
        "order_number",
        "line_number",
        *[F.col(c).cast("date").alias(c) for c in ("order_date", "ship_date", "due_date")],
        "customer_id",
        "product_id",
        "employee_id",
        "territory_id",
        "special_offer_id",
        "ship_method_id",
        "quantity",
        "unit_price",
        "unit_price_discount",
        "line_total",
        share("header_tax").alias("tax_amount"),
        share("header_freight").alias("freight"),
        later_of(F.col("line_modified_at"), F.col("header_modified_at")).alias("modified_at"),
    )


@dataclass(frozen=True)
class SourceSpec:
    """One extract: its staging table, business key and model."""

    staging: str
    business_key: str
    model: Callable[[Tables, Window], DataFrame]
    tie_break: tuple[str, ...] = ()
    lies_by: tuple[str, ...] = ()

    def staged(
        self, tables: Tables, since: Moment = OPEN_START, until: Moment | None = None
    ) -> DataFrame:
        """Typed rows changed after the watermark, the latest of each business key.

        The tie-break columns decide between copies with the same time.  They are few, so
        that a query over lazy rows still reads only the columns it needs.

        Rows that the model has shuffled by ``lies_by`` are de-duplicated where they are.  That
        finds copies which agree in those columns; ``settled`` finds the others.
        """
        model = self.model(tables, Window(since, until))
        rows = conform_to_schema(model, self.staging, self.lies_by)
        keys = [*self.lies_by, self.business_key]
        return keep_latest(rows, keys, tie_break=self.tie_break).drop(*self.lies_by)

    def settled(self, written: DataFrame) -> DataFrame | None:
        """A written batch with one row per business key; None if it has no other copies.

        Only the keys are shuffled to find out.
        """
        if not self.lies_by or quality.duplicate_keys(written, [self.business_key]).isEmpty():
            return None
        return keep_latest(written, [self.business_key], tie_break=self.tie_break)


_MODELS = {
    "customer": customers,
    "product": products,
    "salesperson": salespeople,
    "territory": territories,
    "promotion": promotions,
    "ship_method": ship_methods,
}

SOURCES: dict[str, SourceSpec] = {
    d.name: SourceSpec(d.staging, d.business_key, _MODELS[d.name], d.attributes)
    for d in DIMENSIONS
}
SOURCES["order_line"] = SourceSpec(
    FACT_STAGING, NATURAL_KEY, order_lines, LINE_TIE_BREAK, ("order_id",)
)
