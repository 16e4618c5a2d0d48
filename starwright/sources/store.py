"""Warehouse tables as versioned Parquet folders.

A table consists of parts; each part is a folder of one version.  A publication writes new
folders and then commits the list of replaced parts under the next number of a log, so a reader
sees either the old or the new state and a path is never overwritten while a plan reads it.
Only the parts a batch touches are rewritten.

Some tables also have *deltas*: rows that win over older ones with their key when the table is
read.  A batch that is scattered over many parts then writes as much as it holds; ``fold`` brings
deltas into the parts they belong to.

A part remembers under which name a column is in its files, so a column of a stored table can be
renamed without a rewrite.

The other control tables are folders of generations.  Appending adds a small file; ``tidy``, at
the start of a load, turns many small files into the one file of a new generation and removes
folders that no longer belong to a table's current state.  A reader that opened the store before
the last load should open it again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce
from threading import Lock

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from starwright.operators.dedup import pick_first
from starwright.operators.joins import KeyFilter, key_filter
from starwright.plans.model import (
    FACT_KEYS_TABLE,
    FACT_TABLE,
    NATURAL_KEY,
    ORDER_KEY,
    ORDERS_TABLE,
)
from starwright.schemas import empty_frame, schema
from starwright.session import beyond_broadcast, delete, names_in, size_of
from starwright.sources.commits import CommitLog

WHOLE = "whole"
#: Tables are read more often than written.
CODEC = "zstd"
PUBLICATION, WATERMARK, STEPS = "ctrl.publication", "ctrl.watermark", "ctrl.step_log"
LOGS = (PUBLICATION, WATERMARK, STEPS)
#: Its version in the log is the commit up to which constraints have been checked.
CHECKED = "ctrl.check"
#: A log of more files is compacted at the start of a load.
MOST_LOG_FILES = 64
#: Tables that may have deltas, and the key by which their rows win.
MERGED = {FACT_TABLE: NATURAL_KEY, FACT_KEYS_TABLE: NATURAL_KEY, ORDERS_TABLE: ORDER_KEY}
DELTA = "delta-"
#: Columns of a delta beside those of its table: the part of a row, that of the row it takes the
#: place of (NULL if there is none), and the version of the delta.
_DELTA_COLUMNS = T.StructType([
    T.StructField("_part", T.StringType()),
    T.StructField("_old_part", T.StringType()),
    T.StructField("_version", T.LongType()),
])


@dataclass(frozen=True)
class Part:
    """Where a part lies, and the commit that made it current.

    ``columns`` has the names in its files that differ from today's.
    """

    version: int
    path: str
    columns: Mapping[str, str] = field(default_factory=dict)
    commit: int = 0


class TableStore:
    """Tables under one root folder.

    The publication log, one row per replaced part, is read when the store is opened and
    followed while it writes; ``refresh`` picks up what another load has published.  Threads
    of a load may publish different tables at the same time.  Two loads never write to one
    folder.  A commit takes the next number of the log.  Whoever finds it taken follows what the
    other has published, and goes on if that was about other tables; else it is refused, since
    what it wrote rests on a state that is past.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.run_id = uuid.uuid4().hex[:8]
        self._appending = {log: Lock() for log in LOGS}
        self._generation: dict[str, int] = {}
        self._filters: dict[str, tuple[list[str], KeyFilter]] = {}
        self._commits = CommitLog(spark, self._path(PUBLICATION))
        for log in (WATERMARK, STEPS):
            if not self._finished(log):
                self._frame([], log).write.mode("overwrite").parquet(self._path(log, "g0"))
        self.refresh()

    def _path(self, *names: str) -> str:
        return "/".join((self.root, *names))

    def _frame(self, rows: list[tuple], table: str) -> DataFrame:
        columns = schema(table)
        records = [dict(zip(columns.names, row)) for row in rows]
        table = pa.Table.from_pylist(records, schema=to_arrow_schema(columns))
        return self.spark.createDataFrame(table, columns)

    # --- append-only control tables -------------------------------------------------

    def _finished(self, log: str) -> list[int]:
        """Generations of a log whose first write was committed."""
        found = [int(name[1:]) for name in names_in(self.spark, self._path(log))]
        return sorted(
            g for g in found if "_SUCCESS" in names_in(self.spark, self._path(log, f"g{g}"))
        )

    def _log_path(self, log: str) -> str:
        return self._path(log, f"g{self._generation[log]}")

    def log_files(self, log: str) -> int:
        """Files that a reader of the log opens."""
        if log == PUBLICATION:
            return self._commits.files()
        names = names_in(self.spark, self._log_path(log))
        return sum(name.startswith("part-") for name in names)

    def append(self, log: str, rows: list[tuple]) -> None:
        """Add a few control rows; the commit of the write makes them visible at once."""
        with self._appending[log]:
            self._frame(rows, log).coalesce(1).write.mode("append").parquet(self._log_path(log))

    def read_log(self, log: str) -> DataFrame:
        if log == PUBLICATION:
            rows = [row for _, commit in self._commits.state()[1] for row in commit]
            return self._frame([tuple(row) for row in rows], log)
        return self.spark.read.schema(schema(log)).parquet(self._log_path(log))

    def tidy(self) -> None:
        """Compact the logs and remove folders that are no part of a current table.

        Of publications the last of each part is kept, of marks the highest of each source;
        the step log keeps all its rows.
        """
        if self._commits.files() > MOST_LOG_FILES:
            self._commits.snapshot(self._seen, self._state())
        for log in (WATERMARK, STEPS):
            if self.log_files(log) > MOST_LOG_FILES:
                self._compact(log)
        live = {part.path for parts in self._live.values() for part in parts.values()}
        for table in self._live:
            for name in names_in(self.spark, self._path(table)):
                # A later version may be another load's, which has not published it yet.
                if int(name[1:].split("-")[0]) > self.version(table):
                    continue
                folder = self._path(table, name)
                inside = [n for n in names_in(self.spark, folder) if n.startswith("part=")]
                stale = [f"{folder}/{n}" for n in inside if f"{folder}/{n}" not in live]
                if folder not in live and len(stale) == len(inside):
                    stale = [folder]
                for path in stale:
                    delete(self.spark, path)

    def _state(self) -> list[list]:
        """Rows that lead to the current state: its parts, and each table's version and key."""
        rows = [
            [table, name, part.version, part.path, None, json.dumps(dict(part.columns)),
             part.commit]
            for table, parts in self._live.items()
            for name, part in parts.items()
        ]
        rows += [
            [table, WHOLE if WHOLE not in self._live.get(table, {}) else "", version, None,
             self._last_keys.get(table), None]
            for table, version in self._versions.items()
        ]
        return sorted(rows, key=lambda row: row[2])

    def _compact(self, log: str) -> None:
        rows = self.read_log(log)
        if log == WATERMARK:
            order = [F.col("last_extracted_at").desc_nulls_last(), F.col("finished_at").desc()]
            rows = pick_first(rows, ["source_name"], order)
        generation = self._generation[log]
        rows.coalesce(1).write.mode("overwrite").parquet(self._path(log, f"g{generation + 1}"))
        for old in self._finished(log):
            if old < generation:
                delete(self.spark, self._path(log, f"g{old}"))
        self._generation[log] = generation + 1

    # --- tables ---------------------------------------------------------------------

    def refresh(self) -> None:
        self._generation = {log: self._finished(log)[-1] for log in (WATERMARK, STEPS)}
        self._live: dict[str, dict[str, Part]] = {}
        self._versions: dict[str, int] = {}
        self._last_keys: dict[str, int] = {}
        self._seen = 0
        last, commits = self._commits.state()
        for number, rows in commits:
            self._follow(number, rows)
        self._seen = last

    def _follow(self, number: int, rows: Iterable[list | tuple]) -> None:
        """Take up the rows of a commit; those of a snapshot tell their own numbers."""
        self._seen = number
        for table, name, version, path, last_key, *more in rows:
            self._versions[table] = max(version, self.version(table))
            if last_key is not None:
                self._last_keys[table] = last_key
            parts = self._live.setdefault(table, {})
            parts.pop(name, None)
            if path is not None:
                columns = json.loads(more[0]) if more and more[0] else {}
                parts[name] = Part(version, path, columns, more[1] if len(more) > 1 else number)

    def publish(self, rows: list[tuple], reads: Iterable[str] = ()) -> None:
        """Make written parts current, of one table or of several, in one commit.

        ``rows``: table, part, version, path (None for a part that is gone), last key, and
        optionally the names of columns in the files.  ``reads`` names further tables that the
        parts were made from.  If another load has published any of these tables since this
        store was opened, it is refused.
        """
        concerned = {row[0] for row in rows} | set(reads)
        with self._appending[PUBLICATION]:
            while not self._commits.create(self._seen + 1, rows):
                missed = self._commits.rows_of(self._seen + 1)
                if missed is None or concerned & {row[0] for row in missed}:
                    raise RuntimeError("another load has published to this store; run again")
                self._follow(self._seen + 1, missed)
            self._follow(self._seen + 1, rows)

    def unchecked(self, table: str) -> list[str]:
        """Parts that have become current since constraints were last found to hold."""
        checked = self.version(CHECKED)
        return [name for name, part in self._live.get(table, {}).items() if part.commit > checked]

    def note_checked(self) -> None:
        """Constraints hold for what is current now."""
        self.publish([(CHECKED, "", self._seen, None, None)])

    def version(self, table: str) -> int:
        """Number of the latest publication, 0 before the first."""
        return self._versions.get(table, 0)

    def last_key(self, table: str) -> int:
        """Highest surrogate key handed out so far, as noted by the publisher."""
        return self._last_keys.get(table, 0)

    def live_parts(self, table: str) -> dict[str, str]:
        """Folder of each part of a table."""
        return {name: part.path for name, part in self._live.get(table, {}).items()}

    def deltas(self, table: str) -> list[str]:
        """Parts that hold deltas."""
        if table not in MERGED:
            return []
        return [name for name in self._live.get(table, {}) if name.startswith(DELTA)]

    def bytes_of(self, table: str, parts: Iterable[str] | None = None) -> int:
        live = self.live_parts(table)
        names = live if parts is None else [p for p in parts if p in live]
        return size_of(self.spark, [live[name] for name in names])

    def read(
        self, table: str, parts: Iterable[str] | None = None, extra: T.StructType | None = None
    ) -> DataFrame:
        """The current rows of a table, or of some of its parts."""
        if not self.deltas(table):
            names = self._live.get(table, {}) if parts is None else parts
            return self.read_stored(table, names, extra)
        kept, others = self._merged(table, parts)
        return kept.unionByName(others)

    def _merged(
        self, table: str, parts: Iterable[str] | None = None
    ) -> tuple[DataFrame, DataFrame]:
        """Current rows of a table with deltas: those read where they lie, and all others.

        A row that a delta takes the place of is found by its key.  Where these keys are too many to
        be broadcast, a filter of them tells which rows have to be looked for, and no other row is
        shuffled.
        """
        key, deltas = MERGED[table], self.deltas(table)
        names = list(self._live.get(table, {}) if parts is None else parts)
        stored = self.read_stored(table, [n for n in names if n not in deltas])
        newest = self.newest(table)
        fresh = newest if parts is None else newest.where(F.col("_part").isin(names))
        fresh = fresh.select(*stored.columns)
        rows = self.read_stored(table, deltas, _DELTA_COLUMNS)
        # What a delta inserts is in no part.
        gone = rows.where(F.col("_old_part").isNotNull()).select(key)
        if not beyond_broadcast(rows):
            return stored.join(gone, key, "left_anti").select(*stored.columns), fresh
        looked_for, kept = self._filter_of(table, gone).split(stored, key)
        left = looked_for.join(gone, key, "left_anti").select(*stored.columns)
        return kept, left.unionByName(fresh)

    def _filter_of(self, table: str, gone: DataFrame) -> KeyFilter:
        """A filter of the keys that the deltas of a table take the place of; made once for them."""
        deltas = sorted(self._live[table][name].path for name in self.deltas(table))
        made = self._filters.get(table)
        if made is None or made[0] != deltas:
            made = deltas, key_filter(gone, MERGED[table], lasting=True)
            self._filters[table] = made
        return made[1]

    def newest(self, table: str) -> DataFrame:
        """The last row of each key in the deltas of a table; one delta has each key once."""
        deltas = self.deltas(table)
        rows = self.read_stored(table, deltas, _DELTA_COLUMNS)
        if len(deltas) == 1:
            return rows
        return pick_first(rows, [MERGED[table]], [F.col("_version").desc()])

    def read_stored(
        self, table: str, names: Iterable[str], extra: T.StructType | None = None
    ) -> DataFrame:
        """Rows of some parts as they lie, under today's column names."""
        columns = T.StructType(schema(table).fields + (extra.fields if extra else []))
        live = self._live.get(table, {})
        by_columns: dict[str, list[Part]] = {}
        for name in names:
            if name in live:
                by_columns.setdefault(json.dumps(dict(live[name].columns)), []).append(live[name])
        if not by_columns:
            return empty_frame(self.spark, columns)
        return reduce(
            DataFrame.unionByName,
            [self._scan(columns, parts) for parts in by_columns.values()],
        )

    def _scan(self, columns: T.StructType, parts: list[Part]) -> DataFrame:
        """A scan of parts whose files name their columns alike."""
        old = parts[0].columns
        in_files = T.StructType([
            T.StructField(old.get(f.name, f.name), f.dataType) for f in columns
        ])
        rows = self.spark.read.schema(in_files).parquet(*[part.path for part in parts])
        if not old:
            return rows
        return rows.select(*[F.col(old.get(n, n)).alias(n) for n in columns.names])

    def read_written(self, rows: Iterable[tuple]) -> DataFrame:
        """Rows of one table that have been written and not yet published."""
        rows = list(rows)
        paths = [row[3] for row in rows if row[3] is not None]
        columns = schema(rows[0][0])
        if not paths:
            return empty_frame(self.spark, columns)
        return self.spark.read.schema(columns).parquet(*paths)

    def rename_column(self, table: str, old: str, new: str) -> int:
        """Read column ``old`` of stored parts as ``new``; gives the number of parts concerned.

        Guarded, so it may run at every start: only parts that have the old name and lack the new
        one are concerned.  No file is rewritten.  Parts of one version share their columns.
        """
        found: dict[int, bool] = {}
        rows = []
        for name, part in self._live.get(table, {}).items():
            if new in part.columns:
                continue
            if part.version not in found:
                stored = self.spark.read.parquet(part.path).columns
                found[part.version] = old in stored and new not in stored
            if found[part.version]:
                columns = json.dumps({**part.columns, new: old})
                rows.append((table, name, part.version, part.path, None, columns))
        if rows:
            self.publish(rows)
        return len(rows)

    def replace(self, table: str, df: DataFrame, keep_old: bool = True) -> None:
        """Publish ``df`` as the whole content of a table without parts.

        The old content stays until a later load tidies up, for those who read it still; where
        there are none, it need not be kept.
        """
        version, path = self._next(table)
        old = list(self.live_parts(table).values())
        df.write.option("compression", CODEC).mode("overwrite").parquet(path)
        self.publish([(table, WHOLE, version, path, None)])
        for folder in [] if keep_old else old:
            delete(self.spark, folder)

    def _next(self, table: str) -> tuple[int, str]:
        version = self.version(table) + 1
        return version, self._path(table, f"v{version}-{self.run_id}")

    def replace_parts(
        self,
        table: str,
        df: DataFrame,
        part: Column,
        replaced: Iterable[str],
        last_key: int | None = None,
    ) -> None:
        """Publish new versions of the ``replaced`` parts; other parts stay as they are."""
        self.publish(self.write_parts(table, df, part, replaced, last_key))

    def write_parts(
        self,
        table: str,
        df: DataFrame,
        part: Column,
        replaced: Iterable[str],
        last_key: int | None = None,
        placed: bool = False,
        kept: DataFrame | None = None,
    ) -> list[tuple]:
        """Write new versions of the ``replaced`` parts; gives what ``publish`` takes.

        Rows are rebalanced by part, so adaptive execution splits large parts over tasks and
        joins small ones instead of writing a file per task and part.  Rows that are ``placed``
        lie by part already and are written where they are; so are those of ``kept``.
        """
        version, path = self._next(table)
        rows = df.withColumn("part", part)
        if not placed:
            rows = self.spark.sql("SELECT /*+ REBALANCE(part) */ * FROM {rows}", rows=rows)
        if kept is not None:
            rows = rows.unionByName(kept.withColumn("part", part))
        rows.write.option("compression", CODEC).mode("overwrite").partitionBy("part").parquet(path)
        present = {
            name.removeprefix("part=")
            for name in names_in(self.spark, path)
            if name.startswith("part=")
        }
        return [
            (table, p, version, f"{path}/part={p}" if p in present else None, last_key)
            for p in sorted(set(replaced) | present)
        ]

    def write_delta(
        self, table: str, df: DataFrame, part: Column, old_part: Column,
        last_key: int | None = None,
        placed: bool = False,
    ) -> list[tuple]:
        """Write rows that win over older ones of their key; gives what ``publish`` takes.

        ``part`` is where a row belongs, ``old_part`` where the row it takes the place of lies, NULL
        if there is none.  Rows that are ``placed`` have come from a shuffle and are written as dealt.
        """
        version, path = self._next(table)
        rows = df.select(
            *[F.col(name) for name in schema(table).names],
            part.alias("_part"), old_part.alias("_old_part"),
            F.lit(version).cast("long").alias("_version"),
        )
        if not placed:
            rows = self.spark.sql("SELECT /*+ REBALANCE */ * FROM {rows}", rows=rows)
        rows.write.option("compression", CODEC).mode("overwrite").parquet(path)
        return [(table, f"{DELTA}{version}", version, path, last_key)]

    def fold(self, table: str, part: Column) -> list[tuple]:
        """Write the parts that deltas concern with them, and drop the deltas.

        Gives what ``publish`` takes; only the names of parts come to the driver.  Rows that no delta
        concerns are written from where they are read.
        """
        newest = self.newest(table)
        touched = newest.select(F.col("_part").alias("part")).union(
            newest.select("_old_part")
        ).where(F.col("part").isNotNull())
        # A row that moved twice lies where its first delta found it.
        every = self.read_stored(table, self.deltas(table), _DELTA_COLUMNS)
        touched = touched.union(every.select("_old_part").where(F.col("_old_part").isNotNull()))
        names = sorted(row.part for row in touched.distinct().collect())
        gone = self.deltas(table)
        kept, others = self._merged(table, names)
        rows = self.write_parts(table, others, part, names, kept=kept)
        return rows + [(table, name, rows[0][2], None, None) for name in gone]
