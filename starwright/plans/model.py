"""The star: which dimensions exist, how they are keyed, what they track."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class DimensionSpec:
    """One dimension job: its tables, keys, tracked attributes and history type."""

    name: str
    key: str
    business_key: str
    attributes: tuple[str, ...]
    scd_type: int
    unknown: dict[str, str] = field(default_factory=dict)
    fact_attributes: dict[str, str] = field(default_factory=dict)
    many_members: bool = False

    @property
    def table(self) -> str:
        return f"dw.dim_{self.name}"

    @property
    def staging(self) -> str:
        return f"stg.{self.name}"


# Tracked attributes and the labels of the unknown members.
DIMENSIONS: tuple[DimensionSpec, ...] = (
    DimensionSpec(
        "customer", "customer_key", "customer_id",
        ("customer_name", "customer_type", "city", "state_province", "country_region",
         "postal_code"),
        scd_type=2,
        unknown={"customer_name": "Desconhecido", "customer_type": "N/A"},
        many_members=True,
    ),
    DimensionSpec(
        "product", "product_key", "product_id",
        ("product_name", "product_number", "color", "size", "subcategory_name",
         "category_name", "standard_cost", "list_price"),
        scd_type=2,
        unknown={"product_name": "Desconhecido"},
        fact_attributes={"standard_cost": "standard_cost"},
        many_members=True,
    ),
    DimensionSpec(
        "salesperson", "salesperson_key", "employee_id",
        ("full_name", "job_title"),
        scd_type=2,
        unknown={"full_name": "Desconhecido"},
    ),
    DimensionSpec(
        "territory", "territory_key", "territory_id",
        ("territory_name", "country_code", "territory_group"),
        scd_type=1,
        unknown={"territory_name": "Desconhecido"},
    ),
    DimensionSpec(
        "promotion", "promotion_key", "special_offer_id",
        ("description", "discount_pct", "promotion_type", "promotion_category", "start_date",
         "end_date"),
        scd_type=1,
        unknown={"description": "Sem promoção"},
    ),
    DimensionSpec(
        "ship_method", "ship_method_key", "ship_method_id",
        ("method_name", "ship_base", "ship_rate"),
        scd_type=1,
        unknown={"method_name": "Desconhecido"},
    ),
)

BY_NAME: dict[str, DimensionSpec] = {spec.name: spec for spec in DIMENSIONS}

FACT_TABLE = "dw.fact_sales"
FACT_STAGING = "stg.order_line"
# Keys of the fact by ranges of the natural key, so that a batch reads few of them.
FACT_KEYS_TABLE = "dw.fact_sales_keys"
KEY_RANGE = 1 << 22
# The fact by order, in ranges of the number that an order's name ends with.
ORDERS_TABLE = "dw.order_totals"
ORDER_KEY = "order_number"
ORDER_RANGE = 1 << 22
# Current versions are kept by ranges of the business key, for the same reason.
MEMBER_RANGE = 1 << 20
FACT_KEY = "sale_key"
NATURAL_KEY = "order_line_id"

# The date columns of a staged line and the roles they play on the fact.
DATE_ROLES = {
    "order_date": "order_date_key",
    "ship_date": "ship_date_key",
    "due_date": "due_date_key",
}

# Decides between copies of a line that carry the same modification time.
LINE_TIE_BREAK = ("ship_date", "product_id", "employee_id", "line_total", "quantity")
