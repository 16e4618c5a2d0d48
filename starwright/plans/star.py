"""The star as lazy frames over the source tables, for queries that need no stored one."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from starwright.operators.fact import resolve_fact
from starwright.operators.keys import seed_unknown
from starwright.operators.scd import scd1_upsert, scd2_merge
from starwright.plans.model import BY_NAME, DimensionSpec
from starwright.schemas import empty_frame, schema
from starwright.session import materialize, together
from starwright.sources.extracts import SOURCES, Tables


def seeded_dimension(spark, spec: DimensionSpec) -> DataFrame:
    """A dimension that holds only its unknown member."""
    empty = empty_frame(spark, schema(spec.table))
    return seed_unknown(empty, spec.table, spec.key, spec.business_key, spec.unknown)


def merge_dimension(
    dim: DataFrame, staged: DataFrame, spec: DimensionSpec, load_date: str,
    first_from: str | None = None,
) -> DataFrame:
    """The dimension after one batch, by its history type.

    The batch is staged first, since a merge reads it more than once.
    """
    staged = materialize(staged, f"staged-{spec.name}")
    if spec.scd_type == 2:
        return scd2_merge(
            dim, staged, spec.business_key, spec.key, spec.attributes, load_date,
            first_from=first_from,
        )
    return scd1_upsert(dim, staged, spec.business_key, spec.key, spec.attributes)


def load_dimension(
    spark, tables: Tables, name: str, load_date: str, first_from: str | None = None
) -> DataFrame:
    """A dimension loaded from scratch and written, so that its size is known."""
    spec = BY_NAME[name]
    staged = SOURCES[name].staged(tables)
    merged = merge_dimension(
        seeded_dimension(spark, spec), staged, spec, load_date, first_from
    )
    return materialize(merged, f"dim-{name}")


def load_fact(
    tables: Tables, dims: dict[str, DataFrame], as_of: bool = False
) -> DataFrame:
    """Fact rows of all order lines, with the keys of the given dimensions."""
    return resolve_fact(SOURCES["order_line"].staged(tables), dims, as_of)


def load_star(
    spark, tables: Tables, names: Iterable[str], load_date: str
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The fact and the named dimensions."""
    dims = together(lambda n: load_dimension(spark, tables, n, load_date), list(names))
    return load_fact(tables, dims), dims
