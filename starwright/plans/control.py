"""Watermarks and the step log."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwright.operators.dedup import pick_first
from starwright.schemas import OPEN_START
from starwright.sources.store import TableStore

PROCESS = "incremental_load"
SUCCESS, ERROR = "SUCCESS", "ERROR"


def now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class Control:
    """Control tables of one store.  Rows are appended; readers take the latest.

    Marks are read once and followed while this object moves them.
    """

    def __init__(self, store: TableStore):
        self.store = store
        self._marks: dict[str, datetime] | None = None

    # --- watermarks -----------------------------------------------------------------

    def watermarks(self) -> DataFrame:
        """The latest row of each source."""
        newest = [F.col("finished_at").desc_nulls_last(), F.col("last_extracted_at").desc()]
        return pick_first(self.store.read_log("ctrl.watermark"), ["source_name"], newest)

    def watermark(
        self, source: str, full_load: bool = False, lookback: timedelta | None = None
    ) -> datetime:
        """Mark to extract after; a full load and an unknown source start at 1900-01-01.

        ``lookback`` re-reads a span before the mark, for rows committed late; loads are
        idempotent, so reading a row twice does no harm.
        """
        origin = datetime.fromisoformat(OPEN_START)
        if full_load:
            return origin
        known = self.marks()
        if source not in known:
            self.store.append("ctrl.watermark", [(source, origin, None, None, None, None)])
            known[source] = origin
        return max(origin, known[source] - (lookback or timedelta()))

    def marks(self) -> dict[str, datetime]:
        """The highest mark of each source; rows without a mark do not count."""
        if self._marks is None:
            highest = (
                self.store.read_log("ctrl.watermark")
                .groupBy("source_name").agg(F.max("last_extracted_at").alias("mark"))
                .where(F.col("mark").isNotNull())
            )
            self._marks = {row.source_name: row.mark for row in highest.collect()}
        return self._marks

    def advance(
        self, source: str, mark: datetime | None, started: datetime, rows: int
    ) -> datetime:
        """Move a mark forward, after the load it belongs to has been published.

        A mark never moves back, and a batch of rows without times leaves it where it is.
        """
        old = self.marks().get(source, datetime.fromisoformat(OPEN_START))
        reached = old if mark is None else max(old, mark)
        self.store.append("ctrl.watermark", [(source, reached, started, now(), SUCCESS, rows)])
        self.marks()[source] = reached
        return reached

    # --- step log -------------------------------------------------------------------

    def log(self, step: str, started: datetime, status: str, rows: int, message: str = "") -> None:
        entry = (time.time_ns(), PROCESS, step, started, now(), status, rows, message)
        self.store.append("ctrl.step_log", [entry])

    def latest_steps(self) -> DataFrame:
        return self.store.read_log("ctrl.step_log").orderBy(F.desc("log_id"))

    @contextmanager
    def step(self, name: str) -> Iterator[dict]:
        """Log a step with its true start and end; an error is logged and raised again."""
        outcome: dict = {"rows": 0, "started": now()}
        try:
            yield outcome
        except Exception as error:
            self.log(name, outcome["started"], ERROR, 0, str(error))
            raise
        self.log(
            name, outcome["started"], SUCCESS, outcome["rows"], outcome.get("message", "")
        )
