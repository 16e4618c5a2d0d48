"""SQL counterparts of the registered queries, over the same Parquet tables.

Every statement is assembled from named common table expressions: ``src_*`` are the source
tables by role, ``stg_*`` the staged rows, ``dim_*`` and ``fact`` the star.  A suffix names
the source state: none for the data as given, ``_a`` and ``_b`` for the two states.
"""

from __future__ import annotations

import re

from starwright.plans.model import BY_NAME, DIMENSIONS, DimensionSpec
from starwright.schemas import DECLARATIONS

DAY_ONE, DAY_TWO, DAY_THREE = "2024-01-01", "2024-02-01", "2024-03-01"
OPEN = "DATE '9999-12-31'"
# Fixed values, written out again so that an error in the package does not pass unseen.
DAY_NAMES = ("Segunda-feira", "Terça-feira", "Quarta-feira", "Quinta-feira", "Sexta-feira",
             "Sábado", "Domingo")
MONTH_NAMES = ("Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho", "Julho", "Agosto",
               "Setembro", "Outubro", "Novembro", "Dezembro")
STATES = {"": "plain", "_a": "first", "_b": "second"}


def _labels(names) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


def _day_in_2023(key: str, days: int = 365) -> str:
    return f"CAST(DATE '2023-01-01' + CAST(({key}) % {days} AS INTEGER) AS TIMESTAMP)"


def _key_of(day: str) -> str:
    return f"CAST(year({day}) * 10000 + month({day}) * 100 + day({day}) AS INTEGER)"


def _units(money: str) -> str:
    """Money as a whole number of ten-thousandths."""
    return f"CAST({money} * 10000 AS HUGEINT)"


def _share(amount: str) -> str:
    """Exact half-up share of a header amount, in whole ten-thousandths."""
    top = f"2 * {_units(amount)} * {_units('line_total')} + {_units('subtotal')}"
    return (
        f"CAST(({top}) // (2 * {_units('subtotal')}) AS DECIMAL(12,0))"
        " * CAST(0.0001 AS DECIMAL(4,4))"
    )


def _hash(attributes, alias: str = "") -> str:
    texts = ", ".join(f"coalesce(CAST({alias}{a} AS VARCHAR), '')" for a in attributes)
    return f"md5(concat_ws('|', {texts}))"


def _sources(s: str) -> dict[str, str]:
    """Source tables by role in one state."""
    state = STATES[s]

    def second(condition: str, later: str, base: str) -> str:
        return f"CASE WHEN {condition} THEN {later} ELSE {base} END" if state == "second" else base

    def modified(key: str, base: str) -> str:
        later = "TIMESTAMP '2024-06-01 00:00:00'"
        return second(f"{key} % 7 = 0 OR {key} % 11 = 0", later, base)

    def known(key: str) -> str:
        return f"WHERE {key} % 11 <> 0" if state == "first" else ""

    def so_far(key: str) -> str:
        return f"WHERE {key} % 5 <> 0" if state == "first" else ""

    segment = second("c_custkey % 7 = 0", "'BUILDING'", "c_mktsegment")
    raised = second("p_partkey % 7 = 0", "1.10", "1.00")
    return {
        "src_customer": f"""
            SELECT c_custkey AS customer_id,
                   CASE WHEN {segment} NOT IN ('MACHINERY', 'FURNITURE')
                        THEN c_custkey * 2 END AS person_id,
                   CASE WHEN {segment} IN ('MACHINERY', 'BUILDING')
                        THEN c_custkey * 2 END AS store_id,
                   {modified('c_custkey', _day_in_2023('c_custkey'))} AS modified_at
            FROM customer {known('c_custkey')}""",
        "src_person": """
            SELECT c_custkey * 2 AS entity_id, split_part(c_name, '#', 1) AS first_name,
                   CASE WHEN c_custkey % 10 <> 0 THEN split_part(c_name, '#', 2) END AS last_name
            FROM customer
            UNION ALL
            SELECT s_suppkey * 2 + 1, split_part(s_name, '#', 1), split_part(s_name, '#', 2)
            FROM supplier""",
        "src_store": """
            SELECT c_custkey * 2 AS entity_id, 'Store ' || c_name AS store_name FROM customer""",
        "src_address": """
            SELECT c_custkey * 2 AS entity_id, c_custkey * 2 + pos AS address_id,
                   'City ' || CAST((c_custkey * 2 + pos) % 97 AS VARCHAR) AS city,
                   lpad(CAST((c_custkey * 2 + pos) % 100000 AS VARCHAR), 5, '0') AS postal_code,
                   (c_nationkey + pos) % 25 AS state_id
            FROM customer, (VALUES (0), (1)) AS p(pos) WHERE pos < c_custkey % 3""",
        "src_product": f"""
            SELECT p_partkey AS product_id, p_name AS product_name,
                   'P-' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS product_number,
                   split_part(p_name, ' ', 1) AS color, CAST(p_size AS VARCHAR) AS size,
                   CASE WHEN p_size < 50 THEN p_brand END AS subcategory_name,
                   CASE WHEN p_size < 50 THEN p_type END AS category_name,
                   CAST(CAST(p_retailprice AS DECIMAL(12,2)) * CAST({raised} AS DECIMAL(3,2))
                        AS DECIMAL(12,4)) AS standard_cost,
                   CAST(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(1.25 AS DECIMAL(3,2))
                        AS DECIMAL(12,4)) AS list_price,
                   {modified('p_partkey', _day_in_2023('p_partkey'))} AS modified_at
            FROM part {known('p_partkey')}""",
        "src_sales_person": f"""
            SELECT s_suppkey * 2 + 1 AS entity_id,
                   {_day_in_2023('s_suppkey', 180)} AS modified_at
            FROM supplier {known('s_suppkey')}""",
        "src_employee": f"""
            SELECT s_suppkey * 2 + 1 AS entity_id,
                   {second("s_suppkey % 7 = 0", "'Sales Director'",
                           "'Sales Representative ' || CAST(s_nationkey % 3 AS VARCHAR)")}
                       AS job_title,
                   {modified('s_suppkey', _day_in_2023('s_suppkey * 7', 180))} AS modified_at
            FROM supplier""",
        "src_territory": f"""
            SELECT CAST(n_nationkey AS BIGINT) AS territory_id,
                   {second("n_nationkey % 7 = 0", "n_name || ' renamed'", "n_name")}
                       AS territory_name,
                   CAST(n_regionkey AS VARCHAR) AS country_code, r_name AS territory_group,
                   {modified('n_nationkey', _day_in_2023('n_nationkey'))} AS modified_at
            FROM nation LEFT JOIN region ON n_regionkey = r_regionkey {known('n_nationkey')}""",
        "src_promotion": """
            SELECT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS special_offer_id,
                   substr(o_orderpriority, 3) AS description,
                   CAST(CAST(substr(o_orderpriority, 1, 1) AS INTEGER)
                        * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(5,4)) AS discount_pct,
                   'Order priority' AS promotion_type,
                   CASE WHEN o_orderpriority < '3' THEN 'Fast' ELSE 'Slow' END
                       AS promotion_category,
                   CAST(min(o_orderdate) AS DATE) AS start_date,
                   CAST(max(o_orderdate) AS DATE) AS end_date,
                   max(o_orderdate) AS modified_at
            FROM orders GROUP BY o_orderpriority""",
        "src_ship_method": """
            SELECT CAST(CASE l_linestatus WHEN 'O' THEN 1 ELSE 2 END AS BIGINT)
                       AS ship_method_id,
                   'Method ' || l_linestatus AS method_name,
                   CAST(CASE l_linestatus WHEN 'O' THEN 3.99 ELSE 8.99 END AS DECIMAL(10,2))
                       AS ship_base,
                   CAST(CASE l_linestatus WHEN 'O' THEN 0.99 ELSE 1.49 END AS DECIMAL(10,2))
                       AS ship_rate,
                   max(l_shipdate) AS modified_at
            FROM lineitem GROUP BY l_linestatus""",
        "src_detail": f"""
            SELECT l_orderkey AS order_id, l_orderkey * 10 + l_linenumber AS order_line_id,
                   l_linenumber AS line_number, l_partkey AS product_id,
                   CASE WHEN l_suppkey % 10 <> 0 THEN l_suppkey * 2 + 1 END AS employee_id,
                   CAST(CASE l_linestatus WHEN 'O' THEN 1 ELSE 2 END AS BIGINT)
                       AS ship_method_id,
                   {second("l_orderkey % 5 = 1", "CAST(l_quantity AS INTEGER) + 1",
                           "CAST(l_quantity AS INTEGER)")} AS quantity,
                   CAST((CAST(round(l_extendedprice * 100) AS BIGINT) * 200
                         + CAST(l_quantity AS BIGINT)) // (2 * CAST(l_quantity AS BIGINT))
                        AS DECIMAL(12,0)) * CAST(0.0001 AS DECIMAL(4,4)) AS unit_price,
                   CAST(l_discount AS DECIMAL(6,4)) AS unit_price_discount,
                   CAST(CAST(l_extendedprice AS DECIMAL(12,2))
                        * (1 - CAST(l_discount AS DECIMAL(3,2))) AS DECIMAL(14,4)) AS line_total,
                   CASE WHEN l_returnflag <> 'N' THEN l_shipdate END AS ship_date,
                   {second("l_orderkey % 5 = 1", "TIMESTAMP '2024-06-02 00:00:00'",
                           "l_shipdate")} AS modified_at
            FROM lineitem {so_far('l_orderkey')}""",
        "src_header": f"""
            SELECT o_orderkey AS order_id, 'SO' || CAST(o_orderkey AS VARCHAR) AS order_number,
                   CAST(o_orderdate AS DATE) AS order_date,
                   CAST(o_orderdate AS DATE) + 30 AS due_date, o_custkey AS customer_id,
                   o_custkey % 25 AS territory_id,
                   CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS special_offer_id,
                   CAST(o_totalprice AS DECIMAL(14,4)) AS subtotal,
                   CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.08 AS DECIMAL(3,2))
                        AS DECIMAL(14,4)) AS header_tax,
                   CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.05 AS DECIMAL(3,2))
                        AS DECIMAL(14,4)) AS header_freight,
                   {second("o_orderkey % 5 = 0", "TIMESTAMP '2024-06-01 00:00:00'",
                           "o_orderdate")} AS modified_at
            FROM orders
            {so_far('o_orderkey')}""",
        "stg_customer": f"""
            WITH lowest AS (
                SELECT entity_id, min(address_id) AS address_id FROM src_address{s}
                GROUP BY entity_id),
            named AS (
                SELECT customer_id, person_id, store_id, src_customer{s}.modified_at,
                       first_name || ' ' || last_name AS person_name, store_name
                FROM src_customer{s}
                LEFT JOIN src_person{s} AS who ON who.entity_id = person_id
                LEFT JOIN src_store{s} AS shop ON shop.entity_id = store_id)
            SELECT customer_id,
                   CASE WHEN person_name IS NOT NULL THEN person_name
                        WHEN store_name IS NOT NULL THEN store_name
                        ELSE 'Cliente desconhecido' END AS customer_name,
                   store_name, if(store_id IS NULL, 'Individual', 'Store') AS customer_type,
                   place.city, n_name AS state_province, r_name AS country_region,
                   place.postal_code, named.modified_at
            FROM named
            LEFT JOIN lowest ON lowest.entity_id = person_id
            LEFT JOIN src_address{s} AS place ON place.address_id = lowest.address_id
            LEFT JOIN nation ON n_nationkey = place.state_id
            LEFT JOIN region ON r_regionkey = n_regionkey""",
        "stg_product": f"SELECT * FROM src_product{s}",
        "stg_salesperson": f"""
            SELECT sp.entity_id AS employee_id, p.first_name || ' ' || p.last_name AS full_name,
                   job_title,
                   CASE WHEN sp.modified_at >= e.modified_at THEN sp.modified_at
                        ELSE e.modified_at END AS modified_at
            FROM src_sales_person{s} sp
            JOIN src_employee{s} e ON e.entity_id = sp.entity_id
            JOIN src_person{s} p ON p.entity_id = sp.entity_id""",
        "stg_territory": f"SELECT * FROM src_territory{s}",
        "stg_promotion": f"SELECT * FROM src_promotion{s}",
        "stg_ship_method": f"SELECT * FROM src_ship_method{s}",
        "raw_line": f"""
            SELECT order_line_id, order_number, line_number, order_date,
                   CAST(ship_date AS DATE) AS ship_date, due_date, customer_id, product_id,
                   employee_id, territory_id, special_offer_id, ship_method_id, quantity,
                   unit_price, unit_price_discount, line_total,
                   {_share('header_tax')} AS tax_amount, {_share('header_freight')} AS freight,
                   CASE WHEN d.modified_at >= h.modified_at THEN d.modified_at
                        ELSE h.modified_at END AS modified_at,
                   d.modified_at AS line_mark, h.modified_at AS header_mark
            FROM src_detail{s} d JOIN src_header{s} h ON h.order_id = d.order_id""",
        "stg_order_line": _latest_line(f"raw_line{s}"),
    }


def _latest_line(rows: str) -> str:
    return f"""
            SELECT * FROM (SELECT *, row_number() OVER (
                PARTITION BY order_line_id
                ORDER BY modified_at DESC NULLS LAST, ship_date DESC NULLS LAST,
                         product_id DESC NULLS LAST, employee_id DESC NULLS LAST,
                         line_total DESC NULLS LAST, quantity DESC NULLS LAST) AS pick
                FROM {rows}) x WHERE pick = 1"""


def _unknown(spec: DimensionSpec, validity: bool) -> str:
    """The unknown member, columns in the order of the dimension."""
    values = [f"-1 AS {spec.key}", f"-1 AS {spec.business_key}"]
    values += [
        f"'{spec.unknown[a]}' AS {a}" if a in spec.unknown else f"NULL AS {a}"
        for a in spec.attributes
    ]
    if validity:
        values += ["DATE '1900-01-01' AS valid_from", f"{OPEN} AS valid_to",
                   "TRUE AS is_current", "NULL AS row_hash"]
    return "SELECT " + ", ".join(values)


def _loaded(spec: DimensionSpec, staged: str, day: str) -> str:
    """A dimension after one load; ``day`` is the start of first versions."""
    columns = ", ".join(spec.attributes)
    validity = ""
    if spec.scd_type == 2:
        validity = f""", DATE '{day}' AS valid_from, {OPEN} AS valid_to, TRUE AS is_current,
                   {_hash(spec.attributes)} AS row_hash"""
    return f"""
            {_unknown(spec, spec.scd_type == 2)}
            UNION ALL
            SELECT row_number() OVER (ORDER BY {spec.business_key}), {spec.business_key},
                   {columns}{validity}
            FROM {staged}"""


def _upserted(spec: DimensionSpec, before: str, staged: str) -> str:
    """A type 1 dimension after another load."""
    bk, key = spec.business_key, spec.key
    new = ", ".join(
        f"CASE WHEN s.{bk} IS NOT NULL THEN s.{a} ELSE d.{a} END AS {a}" for a in spec.attributes
    )
    fresh = ", ".join(f"s.{a}" for a in spec.attributes)
    return f"""
            SELECT d.{key}, d.{bk}, {new}
            FROM {before} d LEFT JOIN {staged} s ON s.{bk} = d.{bk}
            UNION ALL
            SELECT (SELECT max({key}) FROM {before}) + row_number() OVER (ORDER BY s.{bk}),
                   s.{bk}, {fresh}
            FROM {staged} s WHERE s.{bk} NOT IN (SELECT {bk} FROM {before})"""


def _classes(spec: DimensionSpec, before: str, staged: str, day: str) -> str:
    """Action per staged row of a type 2 dimension."""
    bk = spec.business_key
    return f"""
            SELECT s.*, {_hash(spec.attributes, 's.')} AS new_hash, d.{spec.key} AS old_key,
                   CASE WHEN d.{bk} IS NULL THEN 'NEW'
                        WHEN d.row_hash = {_hash(spec.attributes, 's.')} THEN 'UNCHANGED'
                        WHEN d.valid_from = DATE '{day}' THEN 'SAME_DAY'
                        ELSE 'CHANGED' END AS action
            FROM {staged} s LEFT JOIN (SELECT * FROM {before} WHERE is_current) d
              ON d.{bk} = s.{bk}"""


def _versioned(
    spec: DimensionSpec, before: str, classes: str, day: str, first_from: str | None = None
) -> str:
    """A type 2 dimension after another load."""
    begins = f"CASE WHEN action = 'NEW' THEN DATE '{first_from or day}' ELSE DATE '{day}' END"
    bk, key = spec.business_key, spec.key
    same = "c.action = 'SAME_DAY' AND d.is_current"
    gone = "c.action = 'CHANGED' AND d.is_current"
    kept = ", ".join(f"CASE WHEN {same} THEN c.{a} ELSE d.{a} END AS {a}" for a in spec.attributes)
    columns = ", ".join(spec.attributes)
    return f"""
            SELECT d.{key}, d.{bk}, {kept}, d.valid_from,
                   CASE WHEN {gone} THEN DATE '{day}' ELSE d.valid_to END AS valid_to,
                   CASE WHEN {gone} THEN FALSE ELSE d.is_current END AS is_current,
                   CASE WHEN {same} THEN c.new_hash ELSE d.row_hash END AS row_hash
            FROM {before} d LEFT JOIN {classes} c ON c.{bk} = d.{bk}
            UNION ALL
            SELECT (SELECT max({key}) FROM {before}) + row_number() OVER (ORDER BY {bk}), {bk},
                   {columns}, {begins}, {OPEN}, TRUE, new_hash
            FROM {classes} WHERE action IN ('NEW', 'CHANGED')"""


def _resolved(lines: str, dims: dict[str, str], as_of: bool = False) -> str:
    """Fact rows with keys of the given dimensions."""
    keys, joins = "", ""
    for name, table in dims.items():
        spec = BY_NAME[name]
        current, match = f"SELECT * FROM {table}", ""
        if spec.scd_type == 2 and as_of:
            match = (f" AND {name}.valid_from <= l.order_date"
                     f" AND l.order_date < {name}.valid_to")
        elif spec.scd_type == 2:
            current += " WHERE is_current"
        keys += f", coalesce({name}.{spec.key}, -1) AS {spec.key}"
        if name == "product":
            keys += ", CAST(coalesce(product.standard_cost, 0) AS DECIMAL(14,4)) AS standard_cost"
        joins += (f" LEFT JOIN ({current}) {name}"
                  f" ON {name}.{spec.business_key} = l.{spec.business_key}{match}")
    return f"""
            SELECT l.*, {_key_of('order_date')} AS order_date_key,
                   {_key_of('ship_date')} AS ship_date_key, {_key_of('due_date')} AS due_date_key,
                   CAST(unit_price * quantity * unit_price_discount AS DECIMAL(14,4))
                       AS discount_amount{keys}
            FROM {lines} l{joins}"""


def _calendar(bounds: str) -> str:
    return f"""
            SELECT {_key_of('d')} AS date_key, d AS full_date, day(d) AS day_of_month,
                   list_extract({_labels(DAY_NAMES)}, isodow(d)) AS day_name,
                   isodow(d) AS day_of_week, month(d) AS month_number,
                   list_extract({_labels(MONTH_NAMES)}, month(d)) AS month_name,
                   quarter(d) AS quarter, year(d) AS year, isodow(d) >= 6 AS is_weekend,
                   year(d) + CASE WHEN month(d) >= 7 THEN 1 ELSE 0 END AS fiscal_year,
                   CASE WHEN month(d) >= 7 THEN quarter(d) - 2 ELSE quarter(d) + 2 END
                       AS fiscal_quarter
            FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
                  FROM ({bounds}) b) x"""


_ALL_DATES = """SELECT least(min(order_date), min(ship_date), min(due_date)) AS lo,
                       greatest(max(order_date), max(ship_date), max(due_date)) AS hi
                FROM stg_order_line"""


def _library() -> dict[str, str]:
    ctes: dict[str, str] = {}
    for s in STATES:
        ctes.update({f"{name}{s}": sql for name, sql in _sources(s).items()})
    for spec in DIMENSIONS:
        name = spec.name
        ctes[f"dim_{name}"] = _loaded(spec, f"stg_{name}", DAY_ONE)
        ctes[f"one_{name}"] = _loaded(spec, f"stg_{name}_a", DAY_ONE)
        if spec.scd_type == 1:
            ctes[f"two_{name}"] = _upserted(spec, f"one_{name}", f"stg_{name}_b")
            continue
        ctes[f"cls_{name}"] = _classes(spec, f"one_{name}", f"stg_{name}_b", DAY_TWO)
        ctes[f"two_{name}"] = _versioned(spec, f"one_{name}", f"cls_{name}", DAY_TWO)
    customer, product = BY_NAME["customer"], BY_NAME["product"]
    ctes["cls_same"] = _classes(customer, "one_customer", "stg_customer_b", DAY_ONE)
    ctes["same_customer"] = _versioned(customer, "one_customer", "cls_same", DAY_ONE)
    ctes["cls_back"] = _classes(customer, "two_customer", "stg_customer", DAY_THREE)
    ctes["back_customer"] = _versioned(customer, "two_customer", "cls_back", DAY_THREE)
    ctes["early_product"] = _loaded(product, "stg_product_a", "1900-01-01")
    ctes["cls_late"] = _classes(product, "early_product", "stg_product_b", "1999-01-01")
    ctes["late_product"] = _versioned(
        product, "early_product", "cls_late", "1999-01-01", "1900-01-01"
    )
    every = {spec.name: f"dim_{spec.name}" for spec in DIMENSIONS}
    ctes["fact"] = _resolved("stg_order_line", every)
    ctes["dim_date"] = _calendar(_ALL_DATES)
    ctes["changed_line"] = _latest_line(
        "(SELECT * FROM raw_line_b"
        " WHERE line_mark > (SELECT max(modified_at) FROM stg_order_line_a)"
        " OR header_mark > (SELECT max(modified_at) FROM stg_order_line_a)) c"
    )
    ctes["fact_one"] = _resolved(
        "stg_order_line_a", {spec.name: f"one_{spec.name}" for spec in DIMENSIONS}
    )
    ctes["fact_two"] = _resolved(
        "changed_line", {spec.name: f"two_{spec.name}" for spec in DIMENSIONS}
    )
    daily = """SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE)
                                            ORDER BY ts DESC, event_id DESC) AS pick FROM events"""
    ctes["versions"] = f"""
            SELECT user_id, valid_from, event_type, h AS row_hash,
                   coalesce(lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from),
                            {OPEN}) AS valid_to
            FROM (SELECT user_id, CAST(ts AS DATE) AS valid_from, event_type,
                         md5(event_type) AS h,
                         lag(md5(event_type)) OVER (PARTITION BY user_id
                                                    ORDER BY CAST(ts AS DATE)) AS before
                  FROM ({daily}) p WHERE pick = 1) q
            WHERE before IS NULL OR before <> h"""
    return ctes


def _needed(sql: str, library: dict[str, str]) -> list[str]:
    """Common table expressions a statement uses, each after those it depends on."""
    order: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"\b[a-z_]+\b", text):
            if word in library and word not in order:
                visit(library[word])
                order.append(word)

    visit(sql)
    return order


# How a column is shown: b whole number, m money, d day, t moment, s as it is.
_CASTS = {
    "b": "CAST({c} AS BIGINT)",
    "m": "CAST({c} AS DOUBLE)",
    "d": "strftime({c}, '%Y-%m-%d')",
    "t": "strftime({c}, '%Y-%m-%d %H:%M:%S')",
    "s": "{c}",
}
_TYPES = {"BIGINT": "b", "INT": "b", "DECIMAL": "m", "DATE": "d", "TIMESTAMP_NTZ": "t"}


def _kinds(table: str) -> dict[str, str]:
    """Kind of each declared column."""
    columns = re.findall(r"(\w+) ([A-Z_]+)(?:\([\d,]+\))?(?: NOT NULL)?(?:,|$)",
                         " ".join(DECLARATIONS[table].split()))
    return {name: _TYPES.get(kind, "s") for name, kind in columns}


def _show(columns: dict[str, str], relation: str, tail: str = "") -> str:
    """``SELECT`` of columns given as name -> kind."""
    shown = ", ".join(f"{_CASTS[k].format(c=c)} AS {c}" for c, k in columns.items())
    return f"SELECT {shown} FROM {relation} {tail}"


def _table(table: str, relation: str, without: tuple[str, ...] = (), tail: str = "") -> str:
    kinds = {c: k for c, k in _kinds(table).items() if c not in without}
    return _show(kinds, relation, tail)


def _some(spec: str, relation: str, tail: str = "") -> str:
    """``SELECT`` of columns given as "name:kind name:kind"."""
    pairs = (item.split(":") for item in spec.split())
    return _show({c: k for c, k in pairs}, relation, tail)


# --- statements -----------------------------------------------------------------------


def _source_statements() -> dict[str, str]:
    names = [spec.name for spec in DIMENSIONS] + ["order_line"]
    return {f"source_{n}": _table(f"stg.{n}", f"stg_{n}") for n in names}


def _shaping_statements() -> dict[str, str]:
    seeds = " UNION ALL ".join(
        f"""SELECT '{spec.name}' AS dimension, {spec.key} = -1 AS is_unknown,
                   count(*) AS members,
                   min(CASE WHEN {spec.key} = -1 THEN {next(iter(spec.unknown))} END)
                       AS unknown_label
            FROM dim_{spec.name} GROUP BY {spec.key} = -1"""
        for spec in DIMENSIONS
    )
    tracked = BY_NAME["customer"].attributes
    strict = ", ".join(
        f"CASE WHEN {a} IS NULL THEN '-' ELSE CAST(length({a}) AS VARCHAR) || ':' || {a} END"
        for a in tracked
    )
    empty = "line_number ship_date due_date product_id employee_id territory_id"
    empty += " special_offer_id ship_method_id quantity unit_price_discount"
    kinds = _kinds("stg.order_line")
    sql_types = {"m": "DOUBLE", "d": "VARCHAR"}
    nothing = ", ".join(
        f"CAST(NULL AS {sql_types.get(kinds[c], 'BIGINT')}) AS {c}" for c in empty.split()
    )
    return {
        "schema_rename_guarded": _some("customer_id:b customer_name:s", "stg_customer"),
        "seed_unknown_member": seeds,
        "conform_to_schema": f"""
            SELECT o_orderkey AS order_line_id, CAST(o_orderkey AS VARCHAR) AS order_number,
                   strftime(o_orderdate, '%Y-%m-%d') AS order_date, o_custkey AS customer_id,
                   CAST(CAST(o_totalprice AS DECIMAL(14,4)) AS DOUBLE) AS line_total,
                   CAST(CAST(o_totalprice AS DECIMAL(12,4)) AS DOUBLE) AS unit_price,
                   strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS modified_at, {nothing}
            FROM orders""",
        "column_defaults": """
            SELECT c_custkey AS customer_id, c_name AS customer_name,
                   CAST(NULL AS VARCHAR) AS city,
                   CASE WHEN c_custkey % 2 = 0 THEN '2020-01-01' END AS valid_from,
                   '9999-12-31' AS valid_to, TRUE AS is_current
            FROM customer""",
        "incremental_filter": _some(
            "product_id:b modified_at:t", "src_product_b",
            "WHERE modified_at > TIMESTAMP '2023-06-30 00:00:00'"),
        "incremental_filter_multi": _some(
            "order_line_id:b product_id:b employee_id:b modified_at:t", "raw_line",
            "WHERE line_mark > TIMESTAMP '2000-06-01' OR header_mark > TIMESTAMP '2000-06-01'"),
        "later_timestamp": """
            SELECT order_line_id,
                   strftime(CASE WHEN d.ship_date >= h.modified_at THEN d.ship_date
                                 ELSE h.modified_at END, '%Y-%m-%d %H:%M:%S') AS later,
                   strftime(CASE WHEN h.modified_at >= d.ship_date THEN h.modified_at
                                 ELSE d.ship_date END, '%Y-%m-%d %H:%M:%S') AS later_swapped
            FROM src_detail d JOIN src_header h ON h.order_id = d.order_id""",
        "allocate_tax_freight": _some(
            "order_line_id:b line_total:m tax_amount:m freight:m", "stg_order_line"),
        "date_smart_key": f"""
            SELECT l_orderkey AS order_id, l_partkey AS product_id,
                   CAST({_key_of('l_shipdate')} AS BIGINT) AS ship_key,
                   CAST(CASE WHEN l_returnflag <> 'N' THEN {_key_of('l_shipdate')} END AS BIGINT)
                       AS returned_key
            FROM lineitem""",
        "row_hash": f"""
            SELECT customer_id, {_hash(tracked)} AS row_hash,
                   md5(concat_ws('|', {strict})) AS strict_hash
            FROM stg_customer""",
        "fact_discount_amount": _some(
            "order_line_id:b unit_price:m quantity:b unit_price_discount:m discount_amount:m",
            f"({_resolved('stg_order_line', {})}) f"),
        "fiscal_calendar": _some(
            "order_day:d fiscal_year:b fiscal_quarter:b",
            """(SELECT DISTINCT CAST(o_orderdate AS DATE) AS order_day,
                       year(o_orderdate) + CASE WHEN month(o_orderdate) >= 7 THEN 1 ELSE 0 END
                           AS fiscal_year,
                       CASE WHEN month(o_orderdate) >= 7 THEN quarter(o_orderdate) - 2
                            ELSE quarter(o_orderdate) + 2 END AS fiscal_quarter
                FROM orders) f"""),
        "tolerant_dates": """
            SELECT o_orderkey AS order_id, strftime(o_orderdate, '%Y-%m-%d') AS order_day
            FROM orders WHERE o_orderkey % 10 > 1""",
        "nan_to_null": """
            SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS reading
            FROM events""",
    }


def _lookup_statements() -> dict[str, str]:
    def resolved(dims: dict[str, str], as_of: bool = False) -> str:
        return f"({_resolved('stg_order_line', dims, as_of)}) f"

    return {
        "lookup_scd2_current": _some(
            "order_line_id:b customer_id:b customer_key:b", resolved({"customer": "two_customer"})),
        "lookup_scd1": _some(
            "order_line_id:b territory_id:b territory_key:b",
            resolved({"territory": "one_territory"})),
        "lookup_cost": _some(
            "order_line_id:b product_id:b product_key:b standard_cost:m",
            resolved({"product": "one_product"})),
        "lookup_scd2_asof": _some(
            "order_line_id:b order_date:d product_key:b standard_cost:m",
            resolved({"product": "late_product"}, as_of=True)),
        "lookup_asof_events": """
            SELECT event_id, coalesce(version_key, -1) AS version_key,
                   v.event_type AS type_in_force
            FROM events e LEFT JOIN (
                SELECT *, row_number() OVER (ORDER BY user_id, valid_from) AS version_key
                FROM versions) v
              ON v.user_id = e.user_id AND v.valid_from <= CAST(e.ts AS DATE)
             AND CAST(e.ts AS DATE) < v.valid_to""",
    }


def _key_statements() -> dict[str, str]:
    counts = " UNION ALL ".join(
        f"SELECT 'dw.dim_{n}' AS table_name, count(*) AS rows FROM dim_{n}"
        for n in BY_NAME
    )
    return {
        "next_watermark": """
            SELECT count(*) AS rows, strftime(max(modified_at), '%Y-%m-%d %H:%M:%S') AS watermark
            FROM stg_order_line""",
        "date_range": _some(
            "first_day:d last_day:d",
            f"(SELECT lo AS first_day, hi AS last_day FROM ({_ALL_DATES}) x) y"),
        "validate_row_counts": f"""
            SELECT 'dw.fact_sales' AS table_name, count(*) AS rows FROM stg_order_line
            UNION ALL SELECT 'dw.dim_date', count(*) FROM dim_date
            UNION ALL {counts}""",
        "first_address_per_customer": """
            SELECT customer_id, address_id
            FROM (SELECT customer_id, address_id,
                         row_number() OVER (PARTITION BY customer_id
                                            ORDER BY address_id NULLS LAST) AS pick
                  FROM src_customer LEFT JOIN src_address ON entity_id = person_id) x
            WHERE pick = 1""",
        "dedup_keep_last": _some(
            "order_line_id:b modified_at:t product_id:b employee_id:b quantity:b line_total:m",
            """(SELECT *, row_number() OVER (
                    PARTITION BY order_line_id
                    ORDER BY modified_at DESC, product_id DESC, employee_id DESC NULLS LAST,
                             line_total DESC, quantity DESC) AS pick FROM src_detail) x""",
            "WHERE pick = 1"),
        "surrogate_keys": """
            SELECT c_custkey AS customer_id, 100 + row_number() OVER (ORDER BY c_custkey)
                       AS customer_key
            FROM customer""",
    }


def _merge_statements() -> dict[str, str]:
    def customers_of(action: str) -> str:
        return _table(
            "dw.dim_customer", "two_customer", tail=f"""WHERE customer_id IN
            (SELECT customer_id FROM cls_customer WHERE action = '{action}')""")

    return {
        "scd1_upsert": _table("dw.dim_territory", "two_territory"),
        "scd2_classify": """
            SELECT customer_id, old_key AS customer_key, action FROM cls_customer""",
        "scd2_classify_one_current": """
            SELECT customer_id, old_key + 1000000000 AS customer_key, action
            FROM cls_customer""",
        "scd2_merge": _table("dw.dim_customer", "back_customer"),
        "scd2_new": customers_of("NEW"),
        "scd2_unchanged": customers_of("UNCHANGED"),
        "scd2_new_version": customers_of("CHANGED"),
        "scd2_same_day": _table("dw.dim_customer", "same_customer"),
        "scd2_replay_events": f"""
            SELECT user_id, strftime(valid_from, '%Y-%m-%d') AS valid_from, event_type, row_hash,
                   strftime(valid_to, '%Y-%m-%d') AS valid_to, valid_to = {OPEN} AS is_current
            FROM versions""",
        "fact_upsert": _some(
            "order_line_id:b order_date_key:b customer_key:b product_key:b salesperson_key:b"
            " territory_key:b promotion_key:b ship_method_key:b standard_cost:m quantity:b"
            " line_total:m loaded_at:s key_is_positive:s key_copies:b kept_key:s"
            " above_old_keys:s",
            f"""(SELECT *, '{DAY_TWO} 00:00:00' AS loaded_at, TRUE AS key_is_positive,
                        1 AS key_copies,
                        order_line_id IN (SELECT order_line_id FROM stg_order_line_a) AS kept_key,
                        order_line_id NOT IN (SELECT order_line_id FROM stg_order_line_a)
                            AS above_old_keys
                 FROM fact_two
                 UNION ALL
                 SELECT *, '{DAY_ONE} 00:00:00', TRUE, 1, TRUE, FALSE FROM fact_one
                 WHERE order_line_id NOT IN (SELECT order_line_id FROM changed_line)) f"""),
    }


def _keyed_fact(relation: str, day: str, tail: str = "") -> str:
    """Stored fact rows: the key is shown by what holds of it whatever the order of rows."""
    kinds = {c: k for c, k in _kinds("dw.fact_sales").items() if c not in ("sale_key", "loaded_at")}
    kinds |= {"loaded_at": "s", "key_is_positive": "s", "key_copies": "b"}
    return _show(kinds, f"""(SELECT *, modified_at AS source_modified_at,
                                    '{day} 00:00:00' AS loaded_at, TRUE AS key_is_positive,
                                    1 AS key_copies FROM {relation}) f""", tail)


def _star_statements() -> dict[str, str]:
    present = "SELECT min(order_date) AS lo, max(order_date) AS hi FROM stg_order_line"
    calendar = _kinds("dw.dim_date")
    relabelled = {c: k for c, k in calendar.items() if c not in ("day_name", "month_name")}
    shown = ", ".join(f"{_CASTS[k].format(c=c)} AS {c}" for c, k in relabelled.items())
    statements = {
        "dim_date": _table("dw.dim_date", "dim_date"),
        "calendar_insert_missing": f"""
            SELECT {shown},
                   CASE WHEN old THEN CAST(day_of_week AS VARCHAR) ELSE day_name END AS day_name,
                   CASE WHEN old THEN CAST(month_number AS VARCHAR) ELSE month_name END
                       AS month_name
            FROM (SELECT *, full_date BETWEEN (SELECT lo FROM ({present}) a)
                                         AND (SELECT hi FROM ({present}) b) AS old
                  FROM dim_date) x""",
        "fact_sales": _keyed_fact("fact", DAY_ONE),
    }
    for spec in DIMENSIONS:
        prefix = "two" if spec.scd_type == 2 else "dim"
        statements[f"dim_{spec.name}"] = _table(spec.table, f"{prefix}_{spec.name}")
    return statements


def _kpi_statements() -> dict[str, str]:
    by_day = "fact JOIN dim_date ON date_key = order_date_key"
    ratio = "round(100 * CAST({0} AS DOUBLE) / nullif(CAST({1} AS DOUBLE), 0), 2)"
    ticket = """round(CAST(sum(line_total) AS DOUBLE) / count(DISTINCT order_number), 2)
                    AS average_ticket"""
    margin = ratio.format(
        "sum(line_total - f.standard_cost * quantity)", "sum(line_total)")
    return {
        "kpi01_revenue_by_month": f"""
            SELECT CAST(year AS BIGINT) AS year, CAST(month_number AS BIGINT) AS month_number,
                   month_name, CAST(round(sum(line_total), 2) AS DOUBLE) AS total_revenue
            FROM {by_day} GROUP BY year, month_number, month_name""",
        "kpi02_average_ticket": f"""
            SELECT CAST(year AS BIGINT) AS year, {ticket} FROM {by_day} GROUP BY year""",
        "kpi03_items_by_quarter": f"""
            SELECT CAST(year AS BIGINT) AS year, CAST(quarter AS BIGINT) AS quarter,
                   CAST(sum(quantity) AS BIGINT) AS items_sold
            FROM {by_day} GROUP BY year, quarter""",
        "kpi04_margin_by_category": f"""
            SELECT category_name, CAST(round(sum(line_total), 2) AS DOUBLE) AS revenue,
                   CAST(round(sum(f.standard_cost * quantity), 2) AS DOUBLE) AS cost,
                   CAST(round(sum(line_total - f.standard_cost * quantity), 2) AS DOUBLE)
                       AS gross_profit,
                   {margin} AS margin_pct
            FROM fact f JOIN dim_product p ON p.product_key = f.product_key
            GROUP BY category_name""",
        "kpi05_discount_rate": f"""
            SELECT CAST(year AS BIGINT) AS year,
                   {ratio.format('sum(discount_amount)', 'sum(unit_price * quantity)')}
                       AS average_discount_pct
            FROM {by_day} GROUP BY year""",
        "kpi06_sales_by_territory": """
            SELECT territory_group, territory_name,
                   CAST(round(sum(line_total), 2) AS DOUBLE) AS total_revenue,
                   count(DISTINCT order_number) AS order_count
            FROM fact f JOIN dim_territory t ON t.territory_key = f.territory_key
            GROUP BY territory_group, territory_name""",
        "kpi07_top_products": """
            SELECT product_name, category_name, CAST(sum(quantity) AS BIGINT) AS items_sold,
                   CAST(round(sum(line_total), 2) AS DOUBLE) AS total_revenue
            FROM fact f JOIN dim_product p ON p.product_key = f.product_key
            GROUP BY product_name, category_name
            ORDER BY total_revenue DESC NULLS FIRST, product_name NULLS LAST,
                     category_name NULLS LAST
            LIMIT 10""",
        "kpi08_salesperson": f"""
            SELECT full_name, job_title,
                   CAST(round(sum(line_total), 2) AS DOUBLE) AS total_revenue,
                   count(DISTINCT order_number) AS order_count, {ticket}
            FROM fact f JOIN dim_salesperson p ON p.salesperson_key = f.salesperson_key
            WHERE f.salesperson_key <> -1 GROUP BY full_name, job_title""",
        "kpi09_mom_growth": f"""
            SELECT CAST(year AS BIGINT) AS year, CAST(month_number AS BIGINT) AS month_number,
                   CAST(round(revenue, 2) AS DOUBLE) AS month_revenue,
                   {ratio.format('(revenue - previous)', 'previous')} AS growth_pct
            FROM (SELECT *, lag(revenue) OVER (ORDER BY year, month_number) AS previous
                  FROM (SELECT year, month_number, sum(line_total) AS revenue
                        FROM {by_day} GROUP BY year, month_number) m) n""",
        "kpi10_lead_time": """
            SELECT territory_name,
                   round(CAST(sum(s.full_date - o.full_date) AS DOUBLE) / count(*), 2)
                       AS average_lead_days
            FROM fact f JOIN dim_date o ON o.date_key = f.order_date_key
            JOIN dim_date s ON s.date_key = f.ship_date_key
            JOIN dim_territory t ON t.territory_key = f.territory_key
            GROUP BY territory_name""",
    }


def _quality_statements() -> dict[str, str]:
    joined = """(SELECT d.order_line_id, d.product_id, d.employee_id, d.ship_method_id,
                        d.quantity, d.unit_price, d.unit_price_discount, d.ship_date,
                        h.order_date, h.due_date, h.customer_id, h.territory_id,
                        h.special_offer_id
                 FROM src_detail d JOIN src_header h ON h.order_id = d.order_id)"""
    lines = f"({_resolved(joined, {})})"
    days = """SELECT date_key FROM dim_date
              WHERE full_date BETWEEN (SELECT min(order_date) FROM src_header)
                                  AND (SELECT max(order_date) FROM src_header)"""
    parents = {k: days for k in ("order_date_key", "ship_date_key", "due_date_key")}
    parents |= {
        spec.business_key: f"SELECT {spec.business_key} FROM stg_{spec.name}_a"
        for spec in DIMENSIONS
    }
    orphans = " UNION ALL ".join(
        f"""SELECT '{c}' AS reference, CAST({c} AS BIGINT) AS key, count(*) AS rows
            FROM {lines} q WHERE {c} IS NOT NULL AND {c} NOT IN ({p}) GROUP BY {c}"""
        for c, p in parents.items()
    )
    required = {"ship_method_key": "ship_method_id", "promotion_key": "special_offer_id",
                "territory_key": "territory_id", "salesperson_key": "employee_id",
                "product_key": "product_id", "customer_key": "customer_id",
                "order_date_key": "order_date", "line_total": "line_total"}
    nulls = " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", count(*) AS rows FROM stg_order_line"
        f" WHERE {c} IS NULL HAVING count(*) > 0"
        for name, c in required.items()
    )
    return {
        "dq_unique": """
            SELECT order_line_id, count(*) AS rows FROM src_detail
            GROUP BY order_line_id HAVING count(*) > 1""",
        "dq_referential": orphans,
        "dq_not_null": nulls,
        "dq_scd2_intervals": f"""
            WITH claimed AS (
                SELECT DISTINCT user_id, CAST(ts AS DATE) AS valid_from,
                       CASE event_type WHEN 'error' THEN {OPEN}
                            WHEN 'signup' THEN CAST(ts AS DATE)
                            ELSE CAST(ts AS DATE) + 1 END AS valid_to,
                       event_type IN ('error', 'signup') AS is_current FROM events),
            checked AS (
                SELECT *, lead(valid_from) OVER (PARTITION BY user_id
                                                 ORDER BY valid_from, valid_to) AS following,
                       sum(CASE WHEN is_current THEN 1 ELSE 0 END)
                           OVER (PARTITION BY user_id) AS currents
                FROM claimed)
            SELECT rule, count(*) AS versions, count(DISTINCT user_id) AS users
            FROM (SELECT user_id, 'overlap' AS rule FROM checked WHERE following < valid_to
                  UNION ALL
                  SELECT user_id, 'ends before it begins' FROM checked
                  WHERE valid_from >= valid_to
                  UNION ALL
                  SELECT user_id, 'several current' FROM checked WHERE is_current AND currents > 1
                  UNION ALL
                  SELECT user_id, 'current but closed, or open but not current'
                  FROM checked WHERE is_current <> (valid_to = {OPEN})) r
            GROUP BY rule""",
        "dq_fits_type": """
            SELECT * FROM (
                SELECT 'description' AS "column", count(*) AS rows FROM documents
                WHERE length(text) > 255
                UNION ALL
                SELECT 'promotion_type', count(*) FROM documents WHERE length(source) > 50
                UNION ALL
                SELECT 'promotion_category', count(*) FROM documents WHERE length(lang) > 50
                UNION ALL
                SELECT 'discount_pct', count(*) FROM documents WHERE n_chars >= 1000) v
            WHERE rows > 0""",
    }


def _constraint_statements() -> dict[str, str]:
    """Reports over a clean star name every constraint with no violation."""
    keys = {"dw.dim_date": ["date_key"], "dw.dim_customer": ["customer_key"],
            "dw.dim_product": ["product_key"], "dw.dim_salesperson": ["salesperson_key"],
            "dw.dim_territory": ["territory_key"], "dw.dim_promotion": ["promotion_key"],
            "dw.dim_ship_method": ["ship_method_key"],
            "dw.fact_sales": ["sale_key", "order_line_id"]}
    for table, column in (
        ("dw.dim_customer", "customer_id, valid_from"), ("dw.dim_product", "product_id, valid_from"),
        ("dw.dim_salesperson", "employee_id, valid_from"), ("dw.dim_territory", "territory_id"),
        ("dw.dim_promotion", "special_offer_id"), ("dw.dim_ship_method", "ship_method_id"),
    ):
        keys[table].append(column)
    keys |= {"dw.fact_sales_keys": ["order_line_id"], "ctrl.watermark": ["source_name"]}
    rules = ["overlap", "ends before it begins", "several current",
             "current but closed, or open but not current"]
    references = ["order_date_key", "ship_date_key", "due_date_key", "customer_key",
                  "product_key", "salesperson_key", "territory_key", "promotion_key",
                  "ship_method_key"]
    validity = "valid_from valid_to is_current"
    required = {
        "dw.dim_date": "date_key full_date day_of_month day_name day_of_week month_number"
        " month_name quarter year is_weekend fiscal_year fiscal_quarter",
        "dw.dim_customer": f"customer_key customer_id {validity}",
        "dw.dim_product": f"product_key product_id {validity}",
        "dw.dim_salesperson": f"salesperson_key employee_id {validity}",
        "dw.dim_territory": "territory_key territory_id",
        "dw.dim_promotion": "promotion_key special_offer_id",
        "dw.dim_ship_method": "ship_method_key ship_method_id",
        "dw.fact_sales": "sale_key order_date_key customer_key product_key salesperson_key"
        " territory_key promotion_key ship_method_key order_number line_number order_line_id"
        " quantity unit_price unit_price_discount discount_amount line_total standard_cost"
        " tax_amount freight source_modified_at loaded_at",
    }

    def clean(rule: str, table: str, column: str) -> str:
        return (f"SELECT '{rule}' AS rule, '{table}' AS table_name, '{column}' AS \"column\","
                " 0 AS violations")

    used = "SELECT territory_key FROM dim_territory WHERE territory_key % 5 <> 0"
    return {
        "dq_unique_star": " UNION ALL ".join(
            clean("unique", t, c) for t, columns in keys.items() for c in columns),
        "dq_validity_star": " UNION ALL ".join(
            clean("validity", f"dw.dim_{n}", rule)
            for n in ("customer", "product", "salesperson") for rule in rules),
        "dq_business_key_damage": """
            SELECT 'unique' AS rule, 'dw.dim_customer' AS table_name,
                   'customer_id, valid_from' AS "column", 2 * count(*) AS violations
            FROM stg_customer WHERE customer_id % 10 = 0
            UNION ALL SELECT 'validity', 'dw.dim_customer', 'several current', 2 * count(*)
            FROM stg_customer WHERE customer_id % 10 = 0
            UNION ALL SELECT 'validity', 'dw.dim_customer', 'overlap', count(*)
            FROM stg_customer WHERE customer_id % 10 = 0
            UNION ALL SELECT 'unique', 'dw.dim_promotion', 'special_offer_id', 2 * count(*)
            FROM stg_promotion WHERE special_offer_id % 2 = 0
            UNION ALL SELECT 'unique', 'ctrl.watermark', 'source_name', 2""",
        "dq_referential_star": " UNION ALL ".join(
            clean("reference", "dw.fact_sales", c) for c in references),
        "dq_not_null_star": " UNION ALL ".join(
            clean("not null", t, c) for t, columns in required.items() for c in columns.split()),
        "dq_star_after_damage": f"""
            SELECT 'reference' AS rule, 'dw.fact_sales' AS table_name,
                   'territory_key' AS "column", count(*) AS violations
            FROM fact WHERE territory_key NOT IN ({used})
            UNION ALL SELECT 'unique', 'dw.dim_promotion', 'promotion_key', 2
            UNION ALL SELECT 'unique', 'dw.dim_promotion', 'special_offer_id', 2
            UNION ALL SELECT 'not null', 'dw.dim_ship_method', 'ship_method_id', count(*)
            FROM dim_ship_method WHERE ship_method_key <= 0""",
        "pipeline_crash_before_mark": _keyed_fact("fact", DAY_ONE),
        "step_log_error": """
            SELECT 'extract_territory' AS step, 'SUCCESS' AS status,
                   (SELECT count(*) FROM nation) AS rows_affected, '' AS message
            UNION ALL SELECT 'load_dim_territory', 'ERROR', 0, 'lost the driver'
            UNION ALL SELECT 'run', 'ERROR', 0, 'lost the driver'""",
    }


def _changed(name: str) -> str:
    """Rows that a second extract picks up."""
    if name == "order_line":
        return "changed_line"
    return (f"(SELECT * FROM stg_{name}_b WHERE modified_at >"
            f" (SELECT max(modified_at) FROM stg_{name}_a))")


def _pipeline_statements() -> dict[str, str]:
    keys = {"customer": "customer_id", "product": "product_id", "salesperson": "employee_id",
            "territory": "territory_id", "promotion": "special_offer_id",
            "ship_method": "ship_method_id", "order_line": "order_line_id"}
    versioned = ("customer", "product", "salesperson")
    staged = " UNION ALL ".join(
        f"SELECT '{n}' AS source_name, {k} AS business_key,"
        f" strftime(modified_at, '%Y-%m-%d %H:%M:%S') AS modified_at FROM {_changed(n)} c"
        for n, k in keys.items()
    )

    def steps(n: str) -> str:
        # The second load of an unchanged source extracts nothing and loads nothing.
        step = "load_fact_sales" if n == "order_line" else f"load_dim_{n}"
        applied = f"(SELECT count(*) FROM {_changed(n)} c)"
        if n in versioned:
            applied = f"(SELECT count(*) FROM cls_{n} WHERE action <> 'UNCHANGED')"
        return f"""
            SELECT 'extract_{n}' AS step, (SELECT count(*) FROM stg_{n}_a) AS rows_affected
            UNION ALL SELECT 'extract_{n}', (SELECT count(*) FROM {_changed(n)} c)
            UNION ALL SELECT '{step}', (SELECT count(*) FROM stg_{n}_a)
            UNION ALL SELECT '{step}', {applied}
                      WHERE (SELECT count(*) FROM {_changed(n)} c) > 0"""

    log = " UNION ALL ".join(steps(n) for n in keys)
    marks = " UNION ALL ".join(
        f"""SELECT '{n}' AS source_name,
                   greatest((SELECT max(modified_at) FROM stg_{n}_a),
                            (SELECT max(modified_at) FROM {_changed(n)} e)) AS mark,
                   CASE WHEN (SELECT count(*) FROM {_changed(n)} c) > 0
                        THEN (SELECT count(*) FROM {_changed(n)} d)
                        ELSE (SELECT count(*) FROM stg_{n}_a) END AS rows_processed"""
        for n in keys
    )
    shown_mark = "strftime(mark, '%Y-%m-%d %H:%M:%S') AS last_extracted_at"
    first_mark = "(SELECT max(modified_at) FROM stg_order_line_a)"
    twice = _keyed_fact("fact_two", DAY_TWO) + " UNION ALL " + _keyed_fact(
        "fact_one", DAY_ONE,
        "WHERE order_line_id NOT IN (SELECT order_line_id FROM changed_line)")
    measured = ("SELECT order_line_id, order_number, order_date_key, territory_key,"
                " salesperson_key, line_total FROM")
    one = f"{measured} fact_one"
    both = (f"{measured} fact_two UNION ALL {one}"
            " WHERE order_line_id NOT IN (SELECT order_line_id FROM changed_line)")
    return {
        "pipeline_merge_on_read": f"""
            SELECT f.*, s.state FROM ({twice}) f,
                   (SELECT 'delta' AS state UNION ALL SELECT 'folded') s""",
        "order_totals_stored": " UNION ALL ".join(
            f"""SELECT *, '{state}' AS state, count(*) OVER (PARTITION BY order_number) > 1
                       AS other_groups
                FROM (SELECT order_number, CAST(order_date_key AS BIGINT) AS order_date_key,
                             territory_key, salesperson_key, count(*) AS line_count,
                             CAST(sum(line_total) AS DOUBLE) AS revenue
                      FROM ({lines}) l
                      GROUP BY order_number, order_date_key, territory_key, salesperson_key) g"""
            for state, lines in (("first", one), ("delta", both), ("folded", both))),
        "schema_rename_stored": """
            SELECT customer_id, customer_name, is_current,
                   strftime(valid_from, '%Y-%m-%d') AS valid_from FROM two_customer""",
        "stg_replace": staged,
        "control_log_latest": f"""
            SELECT 'incremental_load' AS process, step, 'SUCCESS' AS status, rows_affected,
                   '' AS message FROM ({log}) x""",
        "step_log": f"""
            SELECT step, 'SUCCESS' AS status, count(*) AS entries,
                   CAST(sum(rows_affected) AS BIGINT) AS rows_affected
            FROM ({log}) x GROUP BY step""",
        "watermark_read": f"""
            SELECT source_name, {shown_mark} FROM ({marks}) x
            UNION ALL SELECT 'returns', '1900-01-01 00:00:00'""",
        "watermark_upsert": f"""
            SELECT source_name, {shown_mark}, 'SUCCESS' AS status, rows_processed
            FROM ({marks}) x""",
        "watermark_null_mark": f"""
            SELECT load_date, strftime(mark, '%Y-%m-%d %H:%M:%S') AS mark
            FROM (SELECT '{DAY_ONE}' AS load_date, {first_mark} AS mark
                  UNION ALL SELECT '{DAY_TWO}', {first_mark}
                  UNION ALL SELECT '{DAY_THREE}',
                                   (SELECT max(modified_at) FROM changed_line)) m""",
        "pipeline_two_batches": twice,
        "pipeline_full_reload": _keyed_fact("fact", DAY_TWO),
    }


def oracle_sql() -> dict[str, str]:
    """One statement per query that SQL can express."""
    library = _library()
    statements = {
        **_source_statements(),
        **_shaping_statements(),
        **_lookup_statements(),
        **_key_statements(),
        **_merge_statements(),
        **_star_statements(),
        **_kpi_statements(),
        **_quality_statements(),
        **_constraint_statements(),
        **_pipeline_statements(),
    }

    def complete(sql: str) -> str:
        ctes = [f"{name} AS ({library[name]})" for name in _needed(sql, library)]
        if not ctes:
            return sql
        if sql.lstrip().upper().startswith("WITH "):
            return "WITH " + ", ".join(ctes) + ", " + sql.lstrip()[len("WITH "):]
        return "WITH " + ", ".join(ctes) + " " + sql

    return {name: complete(sql) for name, sql in statements.items()}
