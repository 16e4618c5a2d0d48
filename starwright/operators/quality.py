"""Warehouse constraints as distributed checks that return the violations.

Spark does not enforce keys on write, so each constraint is a query; a clean table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starwright.schemas import OPEN_END, declared


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows"))
        .where(F.col("rows") > 1)
    )


def orphan_references(
    fact: DataFrame, references: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """Foreign keys without a parent: reference column, key value, number of fact rows.

    One pass over the fact counts all references together, pre-combined per key value, so
    the anti join sees distinct keys only.  NULL keys are allowed.
    """
    pairs = fact.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("reference"), F.col(c).cast("long").alias("key"))
                    for c in references
                ]
            )
        ).alias("pair")
    ).select("pair.*")
    used = (
        pairs.where(F.col("key").isNotNull())
        .groupBy("reference", "key")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    parents = reduce(
        DataFrame.unionByName,
        [
            parent.select(F.lit(c).alias("reference"), F.col(key).cast("long").alias("key"))
            for c, (parent, key) in references.items()
        ],
    )
    return used.join(parents, ["reference", "key"], "left_anti")


def _violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Per rule, the number of rows that break it; rules nobody breaks are left out."""
    counted = df.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    pairs = F.array(
        *[F.struct(F.lit(n).alias("column"), F.col(n).alias("rows")) for n in rules]
    )
    return (
        counted.select(F.explode(pairs).alias("pair")).select("pair.*").where(F.col("rows") > 0)
    )


def null_violations(df: DataFrame, table: str) -> DataFrame:
    """NOT NULL columns of the declaration that hold NULLs, in one pass."""
    required = [f.name for f in declared(table) if not f.nullable and f.name in df.columns]
    return _violations(df, {c: F.col(c).isNull() for c in required})


def type_violations(df: DataFrame, table: str) -> DataFrame:
    """Columns whose values do not fit the declared length or precision, in one pass."""
    rules: dict[str, Column] = {}
    for f in declared(table):
        if f.name not in df.columns:
            continue
        column = F.col(f.name)
        if isinstance(f.dataType, T.VarcharType):
            rules[f.name] = F.length(column) > f.dataType.length
        elif isinstance(f.dataType, T.DecimalType):
            rules[f.name] = column.isNotNull() & column.try_cast(f.dataType).isNull()
    return _violations(df, rules)


INTERVAL_RULES = (
    "overlap", "ends before it begins", "several current",
    "current but closed, or open but not current",
)


def interval_violations(dim: DataFrame, business_key: str) -> DataFrame:
    """Versions that break the type 2 rules, with the rule each one breaks.

    A key may have one current version, versions must not overlap, each ends after it
    begins, and a version is current exactly when its end is open.
    """
    by_start = Window.partitionBy(business_key).orderBy("valid_from", "valid_to")
    by_key = Window.partitionBy(business_key)
    checked = dim.select(
        business_key,
        "valid_from",
        (F.lead("valid_from").over(by_start) < F.col("valid_to")).alias("_overlap"),
        (F.col("valid_from") >= F.col("valid_to")).alias("_inverted"),
        (F.col("is_current") & (F.count_if("is_current").over(by_key) > 1)).alias("_many"),
        (
            F.col("is_current") != (F.col("valid_to") == F.lit(OPEN_END).cast("date"))
        ).alias("_open"),
    )
    flags = ("_overlap", "_inverted", "_many", "_open")
    broken = F.array_compact(
        F.array(*[F.when(F.col(flag), rule) for flag, rule in zip(flags, INTERVAL_RULES)])
    )
    return checked.select(business_key, "valid_from", F.explode(broken).alias("rule"))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Number of rows of each table."""
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows")
            for n, df in tables.items()
        ],
    )
