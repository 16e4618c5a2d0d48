"""Hand-built source tables with the edge cases the given data lacks."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

OLD, NEW = datetime(2024, 1, 10), datetime(2024, 1, 20)

SCHEMAS = {
    "customer": "customer_id BIGINT, person_id BIGINT, store_id BIGINT, modified_at TIMESTAMP_NTZ",
    "person": "entity_id BIGINT, first_name STRING, last_name STRING",
    "store": "entity_id BIGINT, store_name STRING",
    "entity_address": "entity_id BIGINT, address_id BIGINT",
    "address": "address_id BIGINT, city STRING, postal_code STRING, state_id INT",
    "state": "state_id INT, state_province STRING, country_code STRING",
    "country": "country_code STRING, country_region STRING",
    "product": "product_id BIGINT, product_name STRING, product_number STRING, color STRING,"
    " size STRING, subcategory_id STRING, standard_cost DECIMAL(12,4),"
    " list_price DECIMAL(12,4), modified_at TIMESTAMP_NTZ",
    "product_subcategory": "subcategory_id STRING, subcategory_name STRING, category_id STRING",
    "product_category": "category_id STRING, category_name STRING",
    "sales_person": "entity_id BIGINT, modified_at TIMESTAMP_NTZ",
    "employee": "entity_id BIGINT, job_title STRING, modified_at TIMESTAMP_NTZ",
    "territory": "territory_id BIGINT, territory_name STRING, country_code STRING,"
    " territory_group STRING, modified_at TIMESTAMP_NTZ",
    "special_offer": "special_offer_id BIGINT, description STRING, discount_pct DECIMAL(5,4),"
    " promotion_type STRING, promotion_category STRING, start_date DATE, end_date DATE,"
    " modified_at TIMESTAMP_NTZ",
    "ship_method": "ship_method_id BIGINT, method_name STRING, ship_base DECIMAL(10,2),"
    " ship_rate DECIMAL(10,2), modified_at TIMESTAMP_NTZ",
    "order_header": "order_id BIGINT, order_number STRING, order_date TIMESTAMP_NTZ,"
    " ship_date TIMESTAMP_NTZ, due_date TIMESTAMP_NTZ, customer_id BIGINT, employee_id BIGINT,"
    " territory_id BIGINT, ship_method_id BIGINT, subtotal DECIMAL(14,4),"
    " header_tax DECIMAL(14,4), header_freight DECIMAL(14,4), modified_at TIMESTAMP_NTZ",
    "order_detail": "order_id BIGINT, order_line_id BIGINT, line_number INT, product_id BIGINT,"
    " special_offer_id BIGINT, quantity INT, unit_price DECIMAL(12,4),"
    " unit_price_discount DECIMAL(6,4), line_total DECIMAL(14,4), modified_at TIMESTAMP_NTZ",
}

D = Decimal
DAY = datetime(2024, 1, 5, 13, 30)

ROWS = {
    "customer": [
        (1, 101, None, OLD),   # a person with two addresses
        (2, None, 201, OLD),   # a store without a person: no address
        (3, None, None, OLD),  # neither
        (4, 104, 201, OLD),    # last name missing: the store name
        (5, 105, None, None),  # never modified: never extracted
    ],
    "person": [(101, "Ana", "Silva"), (104, "Rui", None), (105, "Eva", "Luz"),
               (301, "Sam", "Low"), (302, "Kim", "Ito")],
    "store": [(201, "Bike World")],
    "entity_address": [(101, 12), (101, 11), (104, None)],
    "address": [(11, "Porto", "4000", 1), (12, "Lisboa", "1000", 1)],
    "state": [(1, "Norte", "PT")],
    "country": [("PT", "Portugal")],
    "product": [
        (1, "Bolt", "B-1", "red", "S", "s1", D("2.0000"), D("3.0000"), OLD),
        (2, "Nut", "N-1", None, None, None, D("1.0000"), D("2.0000"), OLD),
    ],
    "product_subcategory": [("s1", "Fasteners", "c1")],
    "product_category": [("c1", "Parts")],
    "sales_person": [(301, OLD), (302, OLD)],
    "employee": [(301, "Clerk", NEW), (302, "Lead", OLD)],
    "territory": [(1, "North", "PT", "Europe", OLD)],
    "special_offer": [(1, "None", D("0.0000"), "No", "No", date(2020, 1, 1), None, OLD)],
    "ship_method": [(1, "Truck", D("3.99"), D("0.99"), OLD)],
    "order_header": [
        (1, "SO1", DAY, None, datetime(2024, 1, 17), 1, 301, 1, 1,
         D("30.0000"), D("3.0000"), D("1.0000"), OLD),
        (2, "SO2", DAY, datetime(2024, 1, 8), None, 99, None, 1, 1,
         D("0.0000"), D("3.0000"), D("1.0000"), OLD),
        (3, "SO3", datetime(2024, 3, 1), datetime(2024, 3, 4), None, 2, 302, 1, 1,
         None, D("3.0000"), D("1.0000"), OLD),
    ],
    "order_detail": [
        (1, 11, 1, 1, 1, 2, D("5.0000"), D("0.0000"), D("10.0000"), OLD),
        (1, 12, 2, 2, 1, 4, D("5.0000"), D("0.0000"), D("20.0000"), OLD),
        (2, 21, 1, 77, 1, 1, D("5.0000"), D("0.1000"), D("4.5000"), OLD),
        (3, 31, 1, 1, 1, 1, D("5.0000"), D("0.0000"), D("5.0000"), OLD),
        (9, 91, 1, 1, 1, 1, D("5.0000"), D("0.0000"), D("5.0000"), OLD),  # no header
    ],
}


def tables(spark: SparkSession, **changes: list[tuple]) -> dict[str, DataFrame]:
    """Source tables; a keyword replaces the rows of one role."""
    rows = {**ROWS, **changes}
    return {role: frame(spark, SCHEMAS[role], *rows[role]) for role in SCHEMAS}


def frame(spark: SparkSession, columns: str, *rows: tuple) -> DataFrame:
    """A literal table; going through Arrow keeps it a local relation of known size."""
    schema = T.StructType.fromDDL(columns)
    records = [dict(zip(schema.names, row)) for row in rows]
    table = pa.Table.from_pylist(records, schema=to_arrow_schema(schema))
    return spark.createDataFrame(table, schema)


def content(df: DataFrame, *columns: str) -> list[tuple]:
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
