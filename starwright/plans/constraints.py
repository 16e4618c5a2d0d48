"""The constraints of the model over a stored warehouse.

Every table has its unique keys, its required columns, for the fact a parent for each surrogate
key, and for type 2 dimensions the rules of validity.  A clean warehouse breaks none; the report
names all of them, so that a check that did not run is not taken for a clean one.

Members and lines lie in ranges of their key, so a business key can only be twice inside one
range.  A load therefore checks the ranges that became current since constraints were last found
to hold, with the closed versions of the same ranges; other parts are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starwright.operators import quality
from starwright.plans.layout import range_of
from starwright.plans.model import (
    DATE_ROLES,
    DIMENSIONS,
    FACT_KEY,
    FACT_KEYS_TABLE,
    FACT_TABLE,
    NATURAL_KEY,
)
from starwright.schemas import declared
from starwright.sources.store import WATERMARK, TableStore

CALENDAR = "dw.dim_date"
VERSIONED = {spec.table: spec for spec in DIMENSIONS if spec.scd_type == 2}

#: Unique keys of the model: a surrogate key per table, and the business keys.
UNIQUE: tuple[tuple[str, tuple[str, ...]], ...] = (
    (CALENDAR, ("date_key",)),
    *((spec.table, (spec.key,)) for spec in DIMENSIONS),
    (FACT_TABLE, (FACT_KEY,)),
    *(
        (spec.table, (spec.business_key, *(("valid_from",) if spec.scd_type == 2 else ())))
        for spec in DIMENSIONS
    ),
    (FACT_TABLE, (NATURAL_KEY,)),
    (FACT_KEYS_TABLE, (NATURAL_KEY,)),
)
#: Reference columns of the fact, with the table and column that hold the parent.
REFERENCES: dict[str, tuple[str, str]] = {
    **{role: (CALENDAR, "date_key") for role in DATE_ROLES.values()},
    **{spec.key: (spec.table, spec.key) for spec in DIMENSIONS},
}


def _row(rule: str, table: str, column: str, broken: DataFrame) -> DataFrame:
    """``broken``: one row with a count named ``violations``."""
    return broken.select(
        F.lit(rule).alias("rule"), F.lit(table).alias("table_name"),
        F.lit(column).alias("column"), F.coalesce("violations", F.lit(0)).alias("violations"),
    )


def concerned(store: TableStore, table: str) -> list[str]:
    """Parts that a check after a load has to read: those not checked yet, with their ranges."""
    fresh = store.unchecked(table)
    if table in VERSIONED:
        ranges = {range_of(part) for part in fresh}
        return [part for part in store.live_parts(table) if range_of(part) in ranges]
    deltas = [part for part in fresh if part in store.deltas(table)]
    if not deltas:
        return fresh
    place = T.StructType([T.StructField("_part", T.StringType())])
    found = store.read_stored(table, deltas, place).select("_part").distinct().collect()
    return sorted({row[0] for row in found} | set(fresh) - set(deltas))


def _rows(store: TableStore, table: str, unchecked: bool) -> DataFrame:
    return store.read(table, concerned(store, table) if unchecked else None)


def unique_violations(store: TableStore, unchecked: bool = False) -> DataFrame:
    """Per unique key, the number of rows that share their value with another one.

    As in a database, a key with a NULL in it is equal to none.  Marks are a log; of each source
    one row may be the newest.
    """
    found = []
    for table, columns in UNIQUE:
        keys = _rows(store, table, unchecked).select(*columns).dropna()
        twice = quality.duplicate_keys(keys, list(columns))
        counted = twice.agg(F.sum("rows").alias("violations"))
        found.append(_row("unique", table, ", ".join(columns), counted))
    newest = F.rank().over(
        Window.partitionBy("source_name").orderBy(F.col("finished_at").desc_nulls_last())
    )
    marks = store.read_log(WATERMARK).withColumn("_newest", newest).where("_newest = 1")
    twice = quality.duplicate_keys(marks, ["source_name"])
    counted = twice.agg(F.sum("rows").alias("violations"))
    found.append(_row("unique", WATERMARK, "source_name", counted))
    return reduce(DataFrame.unionByName, found)


def interval_violations(store: TableStore, unchecked: bool = False) -> DataFrame:
    """Per type 2 dimension and rule of validity, the number of versions that break it."""
    found = []
    for table, spec in VERSIONED.items():
        broken = quality.interval_violations(_rows(store, table, unchecked), spec.business_key)
        counted = broken.groupBy("rule").agg(F.count(F.lit(1)).alias("violations"))
        rules = store.spark.createDataFrame([(r,) for r in quality.INTERVAL_RULES], "rule string")
        found.append(
            F.broadcast(rules).join(counted, "rule", "left").select(
                F.lit("validity").alias("rule"), F.lit(table).alias("table_name"),
                F.col("rule").alias("column"),
                F.coalesce("violations", F.lit(0)).alias("violations"),
            )
        )
    return reduce(DataFrame.unionByName, found)


def reference_violations(store: TableStore, unchecked: bool = False) -> DataFrame:
    """Per reference column of the fact, the number of rows without a parent."""
    parents = {c: (store.read(table), key) for c, (table, key) in REFERENCES.items()}
    fact = _rows(store, FACT_TABLE, unchecked)
    orphans = quality.orphan_references(fact, parents).groupBy("reference").agg(
        F.sum("rows").alias("violations")
    )
    return reduce(DataFrame.unionByName, [
        _row(
            "reference", FACT_TABLE, column,
            orphans.where(F.col("reference") == column).agg(
                F.sum("violations").alias("violations")
            ),
        )
        for column in REFERENCES
    ])


def required_violations(store: TableStore, unchecked: bool = False) -> DataFrame:
    """Per table and required column, the number of rows without a value."""
    found = []
    for table in (CALENDAR, *(spec.table for spec in DIMENSIONS), FACT_TABLE):
        required = [f.name for f in declared(table) if not f.nullable]
        counts = _rows(store, table, unchecked).agg(
            *[F.count_if(F.col(c).isNull()).alias(c) for c in required]
        )
        pairs = F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).alias("violations")) for c in required
        ])
        found.append(
            counts.select(F.explode(pairs).alias("p")).select(
                F.lit("not null").alias("rule"), F.lit(table).alias("table_name"), "p.*"
            )
        )
    return reduce(DataFrame.unionByName, found)


def all_violations(store: TableStore, unchecked: bool = False) -> DataFrame:
    """``rule, table_name, column, violations`` for every constraint."""
    return reduce(DataFrame.unionByName, [
        rule(store, unchecked)
        for rule in (
            unique_violations, interval_violations, reference_violations, required_violations
        )
    ])


def assert_constraints(store: TableStore, unchecked: bool = False) -> int:
    """The number of constraints checked; an error names those that are broken.

    ``unchecked`` limits it to the parts that have become current since the last check.
    """
    rows = all_violations(store, unchecked).collect()
    broken = [
        f"{r.rule} {r.table_name}.{r.column}: {r.violations}" for r in rows if r.violations
    ]
    if broken:
        raise ValueError("broken constraints: " + "; ".join(sorted(broken)))
    return len(rows)
