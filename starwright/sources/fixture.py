"""The order-processing source tables, derived from the given Parquet tables.

Every role keeps the keys and relationships of a normalised sales database, so the source
models run unchanged.  Rows without a person, a store, an address, a subcategory, a ship
date or a salesperson occur on purpose.  A snapshot picks a state of the source: ``plain``
is the data as given; ``first`` and ``second`` are two states of a changing source.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starwright.session import materialize
from starwright.sources.readers import parquet_table, select_as

PLAIN, FIRST, SECOND = "plain", "first", "second"

# Columns of the given tables that are in use.
TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE,"
    " c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT,"
    " p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
    " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,"
    " l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,"
    " l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,"
    " value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
}

# Modification times of the rows the second state adds or alters.
_LATER = "TIMESTAMP_NTZ '2024-06-01 00:00:00'"
_LATEST = "TIMESTAMP_NTZ '2024-06-02 00:00:00'"


def given_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return parquet_table(spark, directory, name, TABLES[name])


def _day_in_2023(key: str, days: int = 365) -> str:
    return f"CAST(date_add(DATE '2023-01-01', CAST({key} % {days} AS INT)) AS TIMESTAMP_NTZ)"


def _touched(key: str) -> str:
    return f"{key} % 7 = 0 OR {key} % 11 = 0"


class SourceTables(Mapping[str, DataFrame]):
    """Source tables by role, each built when it is first asked for."""

    ROLES = (
        "customer", "person", "store", "entity_address", "address", "state", "country",
        "product", "product_subcategory", "product_category", "sales_person", "employee",
        "territory", "special_offer", "ship_method", "order_header", "order_detail",
    )

    def __init__(self, spark: SparkSession, directory: str, snapshot: str = PLAIN):
        self.spark, self.directory, self.snapshot = spark, directory, snapshot
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, role: str) -> DataFrame:
        if role not in self.ROLES:
            raise KeyError(role)
        if role not in self._built:
            self._built[role] = getattr(self, f"_{role}")()
        return self._built[role]

    def __iter__(self) -> Iterator[str]:
        return iter(self.ROLES)

    def __len__(self) -> int:
        return len(self.ROLES)

    # --- helpers --------------------------------------------------------------------

    def _given(self, name: str) -> DataFrame:
        return given_table(self.spark, self.directory, name)

    def _second(self, condition: str, later: str, base: str) -> str:
        """``later`` for the rows the second state alters, else ``base``."""
        if self.snapshot != SECOND:
            return base
        return f"CASE WHEN {condition} THEN {later} ELSE {base} END"

    def _modified(self, key: str, base: str) -> str:
        return self._second(_touched(key), _LATER, base)

    def _known(self, df: DataFrame, key: str) -> DataFrame:
        """The first state lacks every eleventh key."""
        return df.where(F.col(key) % 11 != 0) if self.snapshot == FIRST else df

    def _orders_so_far(self, name: str, key: str) -> DataFrame:
        """The first state lacks every fifth order."""
        rows = self._given(name)
        return rows.where(F.col(key) % 5 != 0) if self.snapshot == FIRST else rows

    # --- customers and people -------------------------------------------------------

    def _customer(self) -> DataFrame:
        segment = self._second("c_custkey % 7 = 0", "'BUILDING'", "c_mktsegment")
        return select_as(
            self._known(self._given("customer"), "c_custkey"),
            customer_id="c_custkey",
            person_id=f"CASE WHEN {segment} NOT IN ('MACHINERY', 'FURNITURE')"
            " THEN c_custkey * 2 END",
            store_id=f"CASE WHEN {segment} IN ('MACHINERY', 'BUILDING') THEN c_custkey * 2 END",
            modified_at=self._modified("c_custkey", _day_in_2023("c_custkey")),
        )

    def _person(self) -> DataFrame:
        buyers = select_as(
            self._given("customer"),
            entity_id="c_custkey * 2",
            first_name="split_part(c_name, '#', 1)",
            last_name="CASE WHEN c_custkey % 10 <> 0 THEN split_part(c_name, '#', 2) END",
        )
        sellers = select_as(
            self._given("supplier"),
            entity_id="s_suppkey * 2 + 1",
            first_name="split_part(s_name, '#', 1)",
            last_name="split_part(s_name, '#', 2)",
        )
        return buyers.unionByName(sellers)

    def _store(self) -> DataFrame:
        return select_as(
            self._given("customer"),
            entity_id="c_custkey * 2",
            store_name="concat('Store ', c_name)",
        )

    def _address_rows(self) -> DataFrame:
        """Zero, one or two addresses per customer."""
        copies = F.array_repeat(F.lit(1), (F.col("c_custkey") % 3).cast("int"))
        return self._given("customer").select("c_custkey", "c_nationkey", F.posexplode(copies))

    def _entity_address(self) -> DataFrame:
        return select_as(
            self._address_rows(), entity_id="c_custkey * 2", address_id="c_custkey * 2 + pos"
        )

    def _address(self) -> DataFrame:
        return select_as(
            self._address_rows(),
            address_id="c_custkey * 2 + pos",
            city="concat('City ', (c_custkey * 2 + pos) % 97)",
            postal_code="lpad(CAST((c_custkey * 2 + pos) % 100000 AS STRING), 5, '0')",
            state_id="(c_nationkey + pos) % 25",
        )

    def _state(self) -> DataFrame:
        return select_as(
            self._given("nation"),
            state_id="n_nationkey",
            state_province="n_name",
            country_code="CAST(n_regionkey AS STRING)",
        )

    def _country(self) -> DataFrame:
        return select_as(
            self._given("region"),
            country_code="CAST(r_regionkey AS STRING)",
            country_region="r_name",
        )

    def _sales_person(self) -> DataFrame:
        return select_as(
            self._known(self._given("supplier"), "s_suppkey"),
            entity_id="s_suppkey * 2 + 1",
            modified_at=_day_in_2023("s_suppkey", 180),
        )

    def _employee(self) -> DataFrame:
        return select_as(
            self._given("supplier"),
            entity_id="s_suppkey * 2 + 1",
            job_title=self._second(
                "s_suppkey % 7 = 0",
                "'Sales Director'",
                "concat('Sales Representative ', s_nationkey % 3)",
            ),
            modified_at=self._modified("s_suppkey", _day_in_2023("s_suppkey * 7", 180)),
        )

    # --- products -------------------------------------------------------------------

    def _product(self) -> DataFrame:
        raised = self._second("p_partkey % 7 = 0", "1.10", "1.00")
        return select_as(
            self._known(self._given("part"), "p_partkey"),
            product_id="p_partkey",
            product_name="p_name",
            product_number="concat('P-', lpad(CAST(p_partkey AS STRING), 9, '0'))",
            color="split_part(p_name, ' ', 1)",
            size="CAST(p_size AS STRING)",
            subcategory_id="CASE WHEN p_size < 50 THEN concat(p_brand, '/', p_type) END",
            standard_cost=f"CAST(CAST(p_retailprice AS DECIMAL(12,2)) * {raised}"
            " AS DECIMAL(12,4))",
            list_price="CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 1.25 AS DECIMAL(12,4))",
            modified_at=self._modified("p_partkey", _day_in_2023("p_partkey")),
        )

    def _product_subcategory(self) -> DataFrame:
        """Written, as is the category: a stored table has a known size, so its join is a
        broadcast if it may be one."""
        rows = select_as(
            self._given("part").select("p_brand", "p_type").distinct(),
            subcategory_id="concat(p_brand, '/', p_type)",
            subcategory_name="p_brand",
            category_id="p_type",
        )
        return materialize(rows, "subcategory", lasting=True)

    def _product_category(self) -> DataFrame:
        rows = select_as(
            self._given("part").select("p_type").distinct(),
            category_id="p_type",
            category_name="p_type",
        )
        return materialize(rows, "category", lasting=True)

    # --- territories, offers, shipping ----------------------------------------------

    def _territory(self) -> DataFrame:
        nation, region = self._given("nation"), self._given("region")
        return select_as(
            self._known(nation, "n_nationkey").join(
                region, nation.n_regionkey == region.r_regionkey, "left"
            ),
            territory_id="CAST(n_nationkey AS BIGINT)",
            territory_name=self._second(
                "n_nationkey % 7 = 0", "concat(n_name, ' renamed')", "n_name"
            ),
            country_code="CAST(n_regionkey AS STRING)",
            territory_group="r_name",
            modified_at=self._modified("n_nationkey", _day_in_2023("n_nationkey")),
        )

    def _special_offer(self) -> DataFrame:
        spans = self._given("orders").groupBy("o_orderpriority").agg(
            F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order")
        )
        return select_as(
            spans,
            special_offer_id="CAST(substr(o_orderpriority, 1, 1) AS BIGINT)",
            description="substr(o_orderpriority, 3)",
            discount_pct="CAST(CAST(substr(o_orderpriority, 1, 1) AS INT)"
            " * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(5,4))",
            promotion_type="'Order priority'",
            promotion_category="CASE WHEN o_orderpriority < '3' THEN 'Fast' ELSE 'Slow' END",
            start_date="CAST(first_order AS DATE)",
            end_date="CAST(last_order AS DATE)",
            modified_at="last_order",
        )

    def _ship_method(self) -> DataFrame:
        last = self._given("lineitem").groupBy("l_linestatus").agg(
            F.max("l_shipdate").alias("last_shipped")
        )
        return select_as(
            last,
            ship_method_id="CASE l_linestatus WHEN 'O' THEN 1L ELSE 2L END",
            method_name="concat('Method ', l_linestatus)",
            ship_base="CASE l_linestatus WHEN 'O' THEN 3.99 ELSE 8.99 END",
            ship_rate="CASE l_linestatus WHEN 'O' THEN 0.99 ELSE 1.49 END",
            modified_at="last_shipped",
        )

    # --- orders ---------------------------------------------------------------------

    def _order_detail(self) -> DataFrame:
        return select_as(
            self._orders_so_far("lineitem", "l_orderkey"),
            order_id="l_orderkey",
            order_line_id="l_orderkey * 10 + l_linenumber",
            line_number="l_linenumber",
            product_id="l_partkey",
            employee_id="CASE WHEN l_suppkey % 10 <> 0 THEN l_suppkey * 2 + 1 END",
            ship_method_id="CASE l_linestatus WHEN 'O' THEN 1L ELSE 2L END",
            quantity=self._second(
                "l_orderkey % 5 = 1", "CAST(l_quantity AS INT) + 1", "CAST(l_quantity AS INT)"
            ),
            # Price per unit from whole cents, half up, so that no double is rounded.
            unit_price="""
                CAST((CAST(round(l_extendedprice * 100) AS BIGINT) * 200
                      + CAST(l_quantity AS BIGINT))
                     div (2 * CAST(l_quantity AS BIGINT)) AS DECIMAL(12,0))
                * CAST(0.0001 AS DECIMAL(4,4))
            """,
            unit_price_discount="CAST(l_discount AS DECIMAL(6,4))",
            line_total="""
                CAST(CAST(l_extendedprice AS DECIMAL(12,2))
                     * (1 - CAST(l_discount AS DECIMAL(3,2))) AS DECIMAL(14,4))
            """,
            ship_date="CASE WHEN l_returnflag <> 'N' THEN l_shipdate END",
            modified_at=self._second("l_orderkey % 5 = 1", _LATEST, "l_shipdate"),
        )

    def _order_header(self) -> DataFrame:
        return select_as(
            self._orders_so_far("orders", "o_orderkey"),
            order_id="o_orderkey",
            order_number="concat('SO', o_orderkey)",
            order_date="o_orderdate",
            due_date="date_add(CAST(o_orderdate AS DATE), 30)",
            customer_id="o_custkey",
            territory_id="o_custkey % 25",
            special_offer_id="CAST(substr(o_orderpriority, 1, 1) AS BIGINT)",
            subtotal="CAST(o_totalprice AS DECIMAL(14,4))",
            header_tax="CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.08 AS DECIMAL(3,2))"
            " AS DECIMAL(14,4))",
            header_freight="CAST(CAST(o_totalprice AS DECIMAL(12,2))"
            " * CAST(0.05 AS DECIMAL(3,2)) AS DECIMAL(14,4))",
            modified_at=self._second("o_orderkey % 5 = 0", _LATER, "o_orderdate"),
        )
