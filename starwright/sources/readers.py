"""Readers that give the source tables by role."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Roles that grow with the business; a single task would read them row by row.
LARGE_ROLES = ("order_header", "order_detail", "customer", "person")
PARTITIONING = {"partitionColumn", "lowerBound", "upperBound", "numPartitions"}


def parquet_table(
    spark: SparkSession, directory: str, name: str, columns: T.StructType | str | None = None
) -> DataFrame:
    """One Parquet table; a declared schema spares the job that would infer it."""
    reader = spark.read if columns is None else spark.read.schema(columns)
    return reader.parquet(f"{directory}/{name}.parquet")


@dataclass(frozen=True)
class Split:
    """Read a role by ``parts`` tasks of about equally many rows, by ranges of ``column``."""

    column: str
    parts: int


def bounds_query(query: str, role: str, split: Split) -> str:
    """Lowest value of each of ``parts`` equal shares of a column: at most as many rows.

    Shares, not steps: a key with gaps, or a time with rushes, still gives equal tasks.
    """
    ranked = (
        f"SELECT {split.column} AS bound, NTILE({split.parts}) OVER (ORDER BY {split.column})"
        f" AS part FROM ({query}) {role} WHERE {split.column} IS NOT NULL"
    )
    return f"SELECT MIN(bound) AS bound FROM ({ranked}) ranked GROUP BY part"


def _literal(value: object) -> str:
    text = str(value).replace("'", "''")
    return text if isinstance(value, (int, Decimal)) else f"'{text}'"


def split_predicates(column: str, bounds: Iterable[object]) -> list[str]:
    """Conditions of which every row meets exactly one; rows without a value meet the first."""
    inner = [_literal(value) for value in sorted(set(bounds))[1:]]
    if not inner:
        return ["1 = 1"]
    between = [
        f"{column} >= {low} AND {column} < {high}" for low, high in zip(inner, inner[1:])
    ]
    first, last = f"{column} < {inner[0]} OR {column} IS NULL", f"{column} >= {inner[-1]}"
    return [first, *between, last]


def jdbc_tables(
    spark: SparkSession,
    options: Mapping[str, str],
    queries: Mapping[str, str],
    partitioning: Mapping[str, Mapping[str, str]] | None = None,
    splits: Mapping[str, Split | Mapping[str, str | int]] | None = None,
) -> dict[str, DataFrame]:
    """Source tables of a relational database, one projection query per role.

    ``options`` holds url, driver and credentials.  A large table is read by many tasks, and
    filters reach the database by themselves.  ``splits`` names a column per role: its shares
    are asked for in a first, narrow query (as a mapping: ``column``, ``parts``).  Where bounds are known, ``partitioning`` gives
    ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` instead.  The roles
    in ``LARGE_ROLES`` must have one or the other.
    """
    by_bounds = partitioning or {}
    by_shares = {
        role: split if isinstance(split, Split) else Split(**split)
        for role, split in (splits or {}).items()
    }
    for role in LARGE_ROLES:
        missing = PARTITIONING - set(by_bounds.get(role, ()))
        if role in queries and role not in by_shares and missing:
            raise ValueError(f"{role} needs partitioning: {', '.join(sorted(missing))}")

    def reader(table: str):
        return spark.read.format("jdbc").options(**options, dbtable=table)

    def read(role: str) -> DataFrame:
        table, split = f"({queries[role]}) {role}", by_shares.get(role)
        if split is None:
            return reader(table).options(**by_bounds.get(role, {})).load()
        found = reader(f"({bounds_query(queries[role], role, split)}) bounds").load()
        given = {key: value for key, value in options.items() if key != "url"}
        return spark.read.jdbc(
            options["url"], table, properties=given,
            predicates=split_predicates(split.column, [row.bound for row in found.collect()]),
        )

    return {role: read(role) for role in queries}


def select_as(df: DataFrame, **columns: str) -> DataFrame:
    """Projection by SQL expressions: ``new_name="expression"``."""
    return df.selectExpr(*[f"{e} AS {n}" for n, e in columns.items()])
