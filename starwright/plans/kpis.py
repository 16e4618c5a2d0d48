"""The ten sales indicators over the star.

Sums are first aggregated by surrogate key, with map-side combine, and joined to the
dimension afterwards: the join sees one row per key instead of one per sale, and a hot key
collapses before any shuffle.  Numbers of orders come from totals by order
(``operators.orders``), which a stored warehouse keeps: they are numbers of rows, and only
orders with several groups of lines are told apart by label.
NULL placement in sorts follows the usual SQL warehouse: first when descending.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starwright.functions.scalars import percent, safe_ratio
from starwright.operators.fact import sales_measures
from starwright.operators.keys import UNKNOWN_KEY
from starwright.operators.orders import count_orders, sales_by_key


def _calendar(dim_date: DataFrame, *columns: str) -> DataFrame:
    """Calendar side of a join: one row per day of a bounded range, so broadcast is safe."""
    return F.broadcast(dim_date.select("date_key", *columns))


def _by_order_date(frame: DataFrame, dim_date: DataFrame, *columns: str) -> DataFrame:
    days = _calendar(dim_date, *columns)
    return frame.join(days, frame.order_date_key == days.date_key)


def _money(total: Column) -> Column:
    return F.round(total, 2)


def _average_ticket(total: Column, orders: Column) -> Column:
    return F.round(safe_ratio(total, orders), 2)


def revenue_by_month(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    daily = sales_measures(fact, ["order_date_key"], revenue=F.sum("line_total"))
    return (
        _by_order_date(daily, dim_date, "year", "month_number", "month_name")
        .groupBy("year", "month_number", "month_name")
        .agg(_money(F.sum("revenue")).alias("total_revenue"))
        .orderBy("year", "month_number")
    )


def average_ticket(orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    daily = _by_order_date(sales_by_key(orders, "order_date_key"), dim_date, "year")
    ticket = _average_ticket(F.col("revenue"), F.col("order_count"))
    return (
        count_orders(daily, ["year"], F.col("orders"))
        .select("year", ticket.alias("average_ticket"))
        .orderBy("year")
    )


def items_by_quarter(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    daily = sales_measures(fact, ["order_date_key"], items=F.sum("quantity"))
    return (
        _by_order_date(daily, dim_date, "year", "quarter")
        .groupBy("year", "quarter")
        .agg(F.sum("items").alias("items_sold"))
        .orderBy("year", "quarter")
    )


def margin_by_category(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    by_product = sales_measures(
        fact,
        ["product_key"],
        revenue=F.sum("line_total"),
        cost=F.sum(F.col("standard_cost") * F.col("quantity")),
    )
    totals = (
        by_product.join(dim_product.select("product_key", "category_name"), "product_key")
        .groupBy("category_name")
        .agg(F.sum("revenue").alias("revenue"), F.sum("cost").alias("cost"))
    )
    profit = F.col("revenue") - F.col("cost")
    return totals.select(
        "category_name",
        _money(F.col("revenue")).alias("revenue"),
        _money(F.col("cost")).alias("cost"),
        _money(profit).alias("gross_profit"),
        percent(profit, F.col("revenue")).alias("margin_pct"),
    ).orderBy(F.col("margin_pct").desc_nulls_first())


def discount_rate(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    daily = sales_measures(
        fact,
        ["order_date_key"],
        discount=F.sum("discount_amount"),
        gross=F.sum(F.col("unit_price") * F.col("quantity")),
    )
    return (
        _by_order_date(daily, dim_date, "year")
        .groupBy("year")
        .agg(percent(F.sum("discount"), F.sum("gross")).alias("average_discount_pct"))
        .orderBy("year")
    )


def sales_by_territory(orders: DataFrame, dim_territory: DataFrame) -> DataFrame:
    labels = ["territory_group", "territory_name"]
    named = sales_by_key(orders, "territory_key").join(
        dim_territory.select("territory_key", *labels), "territory_key"
    )
    return (
        count_orders(named, labels, F.col("orders"))
        .select(*labels, _money(F.col("revenue")).alias("total_revenue"), "order_count")
        .orderBy(F.col("total_revenue").desc_nulls_first())
    )


def top_products(fact: DataFrame, dim_product: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` products with the highest revenue; ties fall to name, then category."""
    by_product = sales_measures(
        fact, ["product_key"], items=F.sum("quantity"), revenue=F.sum("line_total")
    )
    return (
        by_product.join(
            dim_product.select("product_key", "product_name", "category_name"), "product_key"
        )
        .groupBy("product_name", "category_name")
        .agg(
            F.sum("items").alias("items_sold"),
            _money(F.sum("revenue")).alias("total_revenue"),
        )
        .orderBy(
            F.col("total_revenue").desc_nulls_first(),
            F.col("product_name").asc_nulls_last(),
            F.col("category_name").asc_nulls_last(),
        )
        .limit(k)
    )


def salesperson_performance(orders: DataFrame, dim_salesperson: DataFrame) -> DataFrame:
    labels = ["full_name", "job_title"]
    sold = sales_by_key(orders, "salesperson_key").where(F.col("salesperson_key") != UNKNOWN_KEY)
    named = sold.join(dim_salesperson.select("salesperson_key", *labels), "salesperson_key")
    return (
        count_orders(named, labels, F.col("orders"))
        .select(
            *labels,
            _money(F.col("revenue")).alias("total_revenue"),
            "order_count",
            _average_ticket(F.col("revenue"), F.col("order_count")).alias("average_ticket"),
        )
        .orderBy(F.col("total_revenue").desc_nulls_first())
    )


def month_over_month_growth(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Growth against the previous month that has sales.

    The window has no partition, but its input is one row per month.
    """
    daily = sales_measures(fact, ["order_date_key"], revenue=F.sum("line_total"))
    monthly = (
        _by_order_date(daily, dim_date, "year", "month_number")
        .groupBy("year", "month_number")
        .agg(F.sum("revenue").alias("revenue"))
    )
    previous = F.lag("revenue").over(Window.orderBy("year", "month_number"))
    return (
        monthly.withColumn("_previous", previous)
        .select(
            "year",
            "month_number",
            _money(F.col("revenue")).alias("month_revenue"),
            percent(F.col("revenue") - F.col("_previous"), F.col("_previous")).alias(
                "growth_pct"
            ),
        )
        .orderBy("year", "month_number")
    )


def lead_time_by_territory(
    fact: DataFrame, dim_date: DataFrame, dim_territory: DataFrame
) -> DataFrame:
    """Mean days from order to shipment per territory name, unshipped lines excluded."""
    trips = sales_measures(
        fact.where(F.col("ship_date_key").isNotNull()),
        ["territory_key", "order_date_key", "ship_date_key"],
        lines=F.count(F.lit(1)),
    )
    ordered = F.broadcast(
        dim_date.select(F.col("date_key").alias("order_date_key"), F.col("full_date").alias("_o"))
    )
    shipped = F.broadcast(
        dim_date.select(F.col("date_key").alias("ship_date_key"), F.col("full_date").alias("_s"))
    )
    return (
        trips.join(ordered, "order_date_key")
        .join(shipped, "ship_date_key")
        .withColumn("_days", F.datediff("_s", "_o") * F.col("lines"))
        .groupBy("territory_key")
        .agg(F.sum("_days").alias("_days"), F.sum("lines").alias("lines"))
        .join(dim_territory.select("territory_key", "territory_name"), "territory_key")
        .groupBy("territory_name")
        .agg(
            F.round(
                F.sum("_days").cast("decimal(20,0)") / F.sum("lines").cast("decimal(20,0)"), 2
            ).alias("average_lead_days")
        )
        .orderBy(F.col("average_lead_days").asc_nulls_last())
    )
