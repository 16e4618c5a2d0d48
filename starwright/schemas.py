"""Declared schemas of the staging, warehouse and control tables.

Declarations keep VARCHAR lengths, NOT NULL marks and defaults, because the quality
checks read them; frames in flight carry plain strings.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_VALIDITY = """
    valid_from DATE NOT NULL, valid_to DATE NOT NULL, is_current BOOLEAN NOT NULL,
    row_hash VARCHAR(64)
"""

# Column types, lengths and NOT NULL marks of the model.
DECLARATIONS: dict[str, str] = {
    "stg.customer": """
        customer_id BIGINT, customer_name VARCHAR(150), store_name VARCHAR(150),
        customer_type VARCHAR(20), city VARCHAR(100), state_province VARCHAR(100),
        country_region VARCHAR(100), postal_code VARCHAR(20), modified_at TIMESTAMP_NTZ
    """,
    "stg.product": """
        product_id BIGINT, product_name VARCHAR(150), product_number VARCHAR(30),
        color VARCHAR(30), size VARCHAR(10), subcategory_name VARCHAR(100),
        category_name VARCHAR(100), standard_cost DECIMAL(12,4), list_price DECIMAL(12,4),
        modified_at TIMESTAMP_NTZ
    """,
    "stg.salesperson": """
        employee_id BIGINT, full_name VARCHAR(150), job_title VARCHAR(100),
        modified_at TIMESTAMP_NTZ
    """,
    "stg.territory": """
        territory_id BIGINT, territory_name VARCHAR(100), country_code VARCHAR(10),
        territory_group VARCHAR(50), modified_at TIMESTAMP_NTZ
    """,
    "stg.promotion": """
        special_offer_id BIGINT, description VARCHAR(255), discount_pct DECIMAL(5,4),
        promotion_type VARCHAR(50), promotion_category VARCHAR(50), start_date DATE,
        end_date DATE, modified_at TIMESTAMP_NTZ
    """,
    "stg.ship_method": """
        ship_method_id BIGINT, method_name VARCHAR(100), ship_base DECIMAL(10,2),
        ship_rate DECIMAL(10,2), modified_at TIMESTAMP_NTZ
    """,
    "stg.order_line": """
        order_line_id BIGINT, order_number VARCHAR(20), line_number INT, order_date DATE,
        ship_date DATE, due_date DATE, customer_id BIGINT, product_id BIGINT,
        employee_id BIGINT, territory_id BIGINT, special_offer_id BIGINT,
        ship_method_id BIGINT, quantity INT, unit_price DECIMAL(12,4),
        unit_price_discount DECIMAL(6,4), line_total DECIMAL(14,4),
        tax_amount DECIMAL(14,4), freight DECIMAL(14,4), modified_at TIMESTAMP_NTZ
    """,
    "dw.dim_date": """
        date_key INT NOT NULL, full_date DATE NOT NULL, day_of_month INT NOT NULL,
        day_name VARCHAR(15) NOT NULL, day_of_week INT NOT NULL, month_number INT NOT NULL,
        month_name VARCHAR(15) NOT NULL, quarter INT NOT NULL, year INT NOT NULL,
        is_weekend BOOLEAN NOT NULL, fiscal_year INT NOT NULL, fiscal_quarter INT NOT NULL
    """,
    "dw.dim_customer": """
        customer_key BIGINT NOT NULL, customer_id BIGINT NOT NULL, customer_name VARCHAR(150),
        customer_type VARCHAR(20), city VARCHAR(100), state_province VARCHAR(100),
        country_region VARCHAR(100), postal_code VARCHAR(20),
    """ + _VALIDITY,
    "dw.dim_product": """
        product_key BIGINT NOT NULL, product_id BIGINT NOT NULL, product_name VARCHAR(150),
        product_number VARCHAR(30), color VARCHAR(30), size VARCHAR(10),
        subcategory_name VARCHAR(100), category_name VARCHAR(100),
        standard_cost DECIMAL(12,4), list_price DECIMAL(12,4),
    """ + _VALIDITY,
    "dw.dim_salesperson": """
        salesperson_key BIGINT NOT NULL, employee_id BIGINT NOT NULL, full_name VARCHAR(150),
        job_title VARCHAR(100),
    """ + _VALIDITY,
    "dw.dim_territory": """
        territory_key BIGINT NOT NULL, territory_id BIGINT NOT NULL,
        territory_name VARCHAR(100), country_code VARCHAR(10), territory_group VARCHAR(50)
    """,
    "dw.dim_promotion": """
        promotion_key BIGINT NOT NULL, special_offer_id BIGINT NOT NULL,
        description VARCHAR(255), discount_pct DECIMAL(5,4), promotion_type VARCHAR(50),
        promotion_category VARCHAR(50), start_date DATE, end_date DATE
    """,
    "dw.dim_ship_method": """
        ship_method_key BIGINT NOT NULL, ship_method_id BIGINT NOT NULL,
        method_name VARCHAR(100), ship_base DECIMAL(10,2), ship_rate DECIMAL(10,2)
    """,
    "dw.fact_sales": """
        sale_key BIGINT NOT NULL, order_date_key INT NOT NULL, ship_date_key INT,
        due_date_key INT, customer_key BIGINT NOT NULL, product_key BIGINT NOT NULL,
        salesperson_key BIGINT NOT NULL, territory_key BIGINT NOT NULL,
        promotion_key BIGINT NOT NULL, ship_method_key BIGINT NOT NULL,
        order_number VARCHAR(20) NOT NULL, line_number INT NOT NULL,
        order_line_id BIGINT NOT NULL, quantity INT NOT NULL,
        unit_price DECIMAL(12,4) NOT NULL, unit_price_discount DECIMAL(6,4) NOT NULL,
        discount_amount DECIMAL(14,4) NOT NULL, line_total DECIMAL(14,4) NOT NULL,
        standard_cost DECIMAL(14,4) NOT NULL, tax_amount DECIMAL(14,4) NOT NULL,
        freight DECIMAL(14,4) NOT NULL, source_modified_at TIMESTAMP_NTZ NOT NULL,
        loaded_at TIMESTAMP_NTZ NOT NULL
    """,
    "dw.fact_sales_keys": """
        order_line_id BIGINT NOT NULL, sale_key BIGINT NOT NULL, order_date_key INT NOT NULL
    """,
    "dw.order_totals": """
        order_number VARCHAR(20) NOT NULL,
        groups ARRAY<STRUCT<order_date_key: INT, territory_key: BIGINT, salesperson_key: BIGINT,
                            line_count: BIGINT, revenue: DECIMAL(24,4)>> NOT NULL
    """,
    "ctrl.watermark": """
        source_name VARCHAR(100) NOT NULL, last_extracted_at TIMESTAMP_NTZ NOT NULL,
        started_at TIMESTAMP_NTZ, finished_at TIMESTAMP_NTZ, status VARCHAR(20),
        rows_processed BIGINT
    """,
    "ctrl.step_log": """
        log_id BIGINT NOT NULL, process VARCHAR(100) NOT NULL, step VARCHAR(100) NOT NULL,
        started_at TIMESTAMP_NTZ NOT NULL, finished_at TIMESTAMP_NTZ, status VARCHAR(20),
        rows_affected BIGINT, message STRING
    """,
    "ctrl.publication": """
        table_name STRING NOT NULL, part STRING NOT NULL, version BIGINT NOT NULL,
        path STRING, last_key BIGINT, file_columns STRING
    """,
}

# Defaults a column takes when the writer leaves it out.
OPEN_START = "1900-01-01"
OPEN_END = "9999-12-31"
_VALIDITY_DEFAULTS = {
    "valid_from": f"DATE '{OPEN_START}'",
    "valid_to": f"DATE '{OPEN_END}'",
    "is_current": "TRUE",
}
DEFAULTS: dict[str, dict[str, str]] = {
    "dw.dim_customer": _VALIDITY_DEFAULTS,
    "dw.dim_product": _VALIDITY_DEFAULTS,
    "dw.dim_salesperson": _VALIDITY_DEFAULTS,
    "dw.fact_sales": {
        "unit_price_discount": "0",
        "discount_amount": "0",
        "tax_amount": "0",
        "freight": "0",
        "loaded_at": "localtimestamp()",
    },
    "ctrl.watermark": {"last_extracted_at": f"TIMESTAMP_NTZ '{OPEN_START}'"},
    "ctrl.step_log": {"started_at": "localtimestamp()"},
}


@lru_cache(maxsize=None)
def declared(table: str) -> T.StructType:
    """Schema as declared, with VARCHAR lengths and NOT NULL marks."""
    return T.StructType.fromDDL(" ".join(DECLARATIONS[table].split()))


@lru_cache(maxsize=None)
def schema(table: str) -> T.StructType:
    """Schema of the frame: plain strings, all columns nullable."""
    return T.StructType(
        [
            T.StructField(
                f.name,
                T.StringType() if isinstance(f.dataType, T.VarcharType) else f.dataType,
            )
            for f in declared(table)
        ]
    )


def default_of(table: str, column: str) -> str:
    """SQL expression of a column's default."""
    return DEFAULTS.get(table, {}).get(column, "NULL")


def empty_frame(spark: SparkSession, columns: T.StructType) -> DataFrame:
    """No rows; a literal plan, so the optimiser removes every join with it."""
    none = [f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in columns]
    return spark.range(1).where("false").selectExpr(*none)
