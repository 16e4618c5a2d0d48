"""One load of the warehouse from the command line.

    python -m starwright --store hdfs:///warehouse/sales --tables hdfs:///staging/sales
    python -m starwright --store hdfs:///warehouse/sales --jdbc source.json --full-load

``--tables`` is a folder with a Parquet table per source role.  ``--jdbc`` is a JSON file with
``options``, ``queries``, ``partitioning`` and ``splits`` as ``sources.readers.jdbc_tables`` takes them.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from starwright.plans.pipeline import CALENDAR_END, CALENDAR_START, load_calendar, run
from starwright.session import remove_scratch
from starwright.sources.fixture import SourceTables
from starwright.sources.readers import jdbc_tables, parquet_table
from starwright.sources.store import TableStore


def parser() -> argparse.ArgumentParser:
    options = argparse.ArgumentParser(prog="starwright", description="Load the sales warehouse.")
    options.add_argument("--store", required=True, help="root folder of the warehouse")
    source = options.add_mutually_exclusive_group(required=True)
    source.add_argument("--tables", help="folder of Parquet tables, one per role")
    source.add_argument("--jdbc", help="JSON file that describes a database")
    options.add_argument("--full-load", action="store_true", help="ignore the marks")
    options.add_argument("--load-date", default=date.today().isoformat())
    options.add_argument("--lookback-days", type=int, default=0,
                         help="read so many days before the marks again")
    options.add_argument("--as-of", action="store_true",
                         help="resolve the version in force on the order date")
    options.add_argument("--check", action="store_true", help="check at the end what became current since the last check")
    options.add_argument("--calendar", nargs=2, metavar=("FIRST", "LAST"),
                         default=(CALENDAR_START, CALENDAR_END), help="days to have at least")
    return options


def source_tables(spark: SparkSession, options: argparse.Namespace) -> dict[str, DataFrame]:
    if options.tables:
        return {
            role: parquet_table(spark, options.tables, role) for role in SourceTables.ROLES
        }
    with open(options.jdbc, encoding="utf-8") as file:
        return jdbc_tables(spark, **json.load(file))


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    options = parser().parse_args(arguments)
    spark = spark or SparkSession.builder.appName("starwright").getOrCreate()
    tables = source_tables(spark, options)
    store = TableStore(spark, options.store)
    try:
        load_calendar(store, *options.calendar)
        report = run(
            spark, tables, store, options.load_date, full_load=options.full_load,
            lookback=timedelta(days=options.lookback_days), as_of=options.as_of,
            check=options.check,
        )
    finally:
        remove_scratch(spark)
    for name, rows in report.staged.items():
        print(f"{name}: staged {rows}, applied {report.applied.get(name, 0)}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
