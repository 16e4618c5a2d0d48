"""Sales by order: the fact at the grain of an order, kept up to date by differences.

A row is an order, with one group for each combination of order date, territory and salesperson
that its lines have.  As these come from the order's header, nearly every order has one group;
it gets more when a member has a new version and only some lines are loaded again.  Numbers of
orders are then numbers of rows, and only orders of several groups need a closer look.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starwright.operators.joins import KeyFilter
from starwright.plans.model import ORDER_KEY, ORDERS_TABLE
from starwright.schemas import schema

#: What the lines of a group have in common.
GROUP = ("order_date_key", "territory_key", "salesperson_key")
_MEASURES = ("line_count", "revenue")
_REVENUE = "decimal(24,4)"
#: One line's amount; up to 18 digits take a fixed eight bytes of a shuffled row, wider ones more.
_AMOUNT = "decimal(18,4)"
#: A part of the totals is made by so many tasks at most.
SLICES = 64


def line_shares(lines: DataFrame, sign: int = 1) -> DataFrame:
    """What each line adds to its order; with a sign of -1, what it takes away."""
    return lines.select(
        ORDER_KEY, *GROUP, F.lit(sign).cast("long").alias("line_count"),
        (F.lit(sign) * F.col("line_total")).cast(_AMOUNT).alias("revenue"),
    )


def add_up(shares: DataFrame, part: Column | None = None) -> DataFrame:
    """One row per order, group by group; a group without lines is left out.

    Lines are summed before an order's groups meet, so an order of very many lines collapses
    before any shuffle.  With ``part`` the groups meet where their order is to be written: the
    result has a column of that name, and its rows lie by it.
    """
    groups = shares.groupBy(ORDER_KEY, *GROUP).agg(
        F.sum("line_count").alias("line_count"),
        F.sum("revenue").cast(_REVENUE).alias("revenue"),
    )
    present = F.when(F.col("line_count") != 0, F.struct(*GROUP, *_MEASURES))
    place = []
    if part is not None:
        place = ["part", "_slice"]
        share = F.pmod(F.xxhash64(ORDER_KEY), F.lit(SLICES))
        groups = groups.withColumns({"part": part, "_slice": share}).repartition(*place)
    rows = groups.groupBy(*place, ORDER_KEY).agg(
        F.sort_array(F.collect_list(present)).alias("groups")
    )
    return rows.select(*schema(ORDERS_TABLE).names, *place[:1])


def add_up_placed(shares: DataFrame, part: Column) -> DataFrame:
    """``add_up`` with a ``part`` in one shuffle, for shares that are mostly groups of their own.

    Lines of an order differ in salesperson, so sums before the shuffle save little, and groups
    would be shuffled again to meet.  Here shares go where their order is to be written and are
    summed there; the rows of one order are read by one task, as in the extract.
    """
    share = F.pmod(F.xxhash64(ORDER_KEY), F.lit(SLICES))
    groups = (
        shares.repartition(part, share)
        .withColumns({"part": part, "_slice": share})
        .groupBy("part", "_slice", ORDER_KEY, *GROUP)
        .agg(
            F.sum("line_count").alias("line_count"),
            F.sum("revenue").cast(_REVENUE).alias("revenue"),
        )
    )
    present = F.when(F.col("line_count") != 0, F.struct(*GROUP, *_MEASURES))
    rows = groups.groupBy("part", "_slice", ORDER_KEY).agg(
        F.sort_array(F.collect_list(present)).alias("groups")
    )
    return rows.select(*schema(ORDERS_TABLE).names, "part")


def order_totals(fact: DataFrame) -> DataFrame:
    """All lines of a fact by order.  An empty fact has none."""
    return add_up(line_shares(fact))


def order_groups(orders: DataFrame) -> DataFrame:
    """One row per order and group, and whether the order has ``other_groups``."""
    several = F.size("groups") > 1
    return orders.select(ORDER_KEY, several.alias("other_groups"), F.inline("groups"))


def changed_orders(
    orders: DataFrame, changes: DataFrame, concerned: KeyFilter | None = None
) -> DataFrame:
    """The orders that signed shares of lines concern, as they are after them.

    An order that has lost all its lines stays as a row without groups, so that it wins over
    its older state where that is kept elsewhere.  ``concerned`` may tell of the orders of all
    changes.  Orders meet their changes in one shuffle, in which an order's rows go to one task.
    """
    if concerned is not None:
        orders = concerned.may_match(orders, ORDER_KEY)
    stood = orders.select(ORDER_KEY, F.inline("groups")).select(ORDER_KEY, *GROUP, *_MEASURES)
    new = changes.select(ORDER_KEY, *GROUP, *_MEASURES).withColumn("_changed", F.lit(True))
    groups = (
        stood.withColumn("_changed", F.lit(False))
        .unionByName(new)
        .repartition(ORDER_KEY)
        .groupBy(ORDER_KEY, *GROUP)
        .agg(
            F.sum("line_count").alias("line_count"),
            F.sum("revenue").cast(_REVENUE).alias("revenue"),
            F.max("_changed").alias("_changed"),
        )
    )
    present = F.when(F.col("line_count") != 0, F.struct(*GROUP, *_MEASURES))
    rows = groups.groupBy(ORDER_KEY).agg(
        F.sort_array(F.collect_list(present)).alias("groups"), F.max("_changed").alias("_changed")
    )
    return rows.where("_changed").select(*schema(ORDERS_TABLE).names)


def orders_upsert(orders: DataFrame, changed: DataFrame) -> DataFrame:
    """``orders`` with the rows of ``changed`` in place of theirs; orders without lines go."""
    untouched = orders.join(changed.select(ORDER_KEY), ORDER_KEY, "left_anti")
    columns = schema(ORDERS_TABLE).names
    kept = changed.where(F.size("groups") > 0)
    return untouched.select(*columns).unionByName(kept.select(*columns))


def orders_after(
    orders: DataFrame, changes: DataFrame, part: Column, concerned: KeyFilter | None = None
) -> DataFrame:
    """``orders`` after signed shares of lines, by part; orders without lines go.

    Orders are added up anew, by which no row is looked for in another table.  ``concerned`` may
    tell of the orders of all changes; other orders are then written from where they are read.
    """
    kept = None
    if concerned is not None:
        orders, kept = concerned.split(orders, ORDER_KEY)
    stood = orders.select(ORDER_KEY, F.inline("groups")).select(ORDER_KEY, *GROUP, *_MEASURES)
    shares = stood.unionByName(changes.select(ORDER_KEY, *GROUP, *_MEASURES))
    after = add_up_placed(shares, part)
    if kept is not None:
        after = after.unionByName(kept.select(*schema(ORDERS_TABLE).names, part.alias("part")))
    return after.where(F.size("groups") > 0)


def count_orders(groups: DataFrame, labels: list[str], orders: Column) -> DataFrame:
    """``revenue`` and number of different orders (``order_count``) per combination of labels.

    ``groups`` has the number of an order where it has several groups, else NULL, under the name
    ``order_again``, and the sums of such rows; ``orders`` counts the orders of the latter.
    """
    by_order = groups.groupBy(*labels, "order_again").agg(
        F.sum("revenue").alias("revenue"), F.sum(orders).alias("orders")
    )
    counted = F.when(F.col("order_again").isNull(), F.col("orders")).otherwise(F.lit(1))
    return by_order.groupBy(*labels).agg(
        F.sum("revenue").cast(_REVENUE).alias("revenue"),
        F.sum(counted).cast("long").alias("order_count"),
    )


def sales_by_key(orders: DataFrame, key: str) -> DataFrame:
    """Orders collapsed to a row per ``key``, but for those of several groups.

    Columns: ``key, order_again, revenue, orders``, as ``count_orders`` takes them.
    """
    again = F.when(F.col("other_groups"), F.col(ORDER_KEY)).alias("order_again")
    return order_groups(orders).groupBy(key, again).agg(
        F.sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("orders")
    )
