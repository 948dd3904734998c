"""Progress of streams as events: running totals and documents waiting, without a look at what was written.

Spark tells a listener of each finished batch. The listener adds up its rows, so totals hold over any number of batches, though
Spark itself keeps the reports of the last hundred only. What waits is what the sources are known to hold less what was processed.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

#: Seconds between two calls of a progress callback, at least.
INTERVAL = 5.0


@dataclass
class Totals:
    """What one query has done so far, over all its runs that the listener saw."""

    batches: int = 0
    processed: int = 0
    busy_ms: int = 0
    started: float = field(default_factory=time.monotonic)
    last_batch: int = -1
    running: bool = True
    error: str | None = None


class ProgressListener(StreamingQueryListener):
    """Totals by query; callbacks for progress and completion.

    ``on_progress(report)`` is called at most every ``interval`` seconds and once more at the end, ``on_complete(report)`` when a query
    ends. A report has ``batches, processed, waiting, total, elapsed_ms, busy_ms, is_running``; ``waiting`` and ``total`` are None until
    ``expect`` or ``add_documents`` has said how many documents there are.
    """

    def __init__(
        self, *, on_progress: Callable[[dict], None] | None = None, on_complete: Callable[[dict], None] | None = None, interval: float = INTERVAL
    ):
        self._lock = threading.RLock()
        self._totals: dict[str, Totals] = {}
        self._expected: dict[str, int] = {}
        self._told: dict[str, float] = {}
        self._on_progress, self._on_complete, self._interval = on_progress, on_complete, interval

    # how many there are

    def expect(self, query_id, total: int) -> None:
        """The number of documents that the query's source holds."""
        with self._lock:
            self._expected[str(query_id)] = total

    def add_documents(self, query_id, count: int) -> None:
        """So many more documents were put where the query reads."""
        with self._lock:
            self._expected[str(query_id)] = self._expected.get(str(query_id), 0) + count

    # events

    def onQueryStarted(self, event) -> None:
        with self._lock:
            known = self._totals.setdefault(str(event.id), Totals())
            known.running, known.error = True, None

    def onQueryProgress(self, event) -> None:
        report = event.progress
        name = str(report.id)
        with self._lock:
            known = self._totals.setdefault(name, Totals())
            if report.numInputRows or report.batchId > known.last_batch:
                known.processed += report.numInputRows
                known.batches += report.numInputRows > 0
                known.last_batch = max(known.last_batch, report.batchId)
                known.busy_ms += report.durationMs.get("triggerExecution", 0)
            now = time.monotonic()
            due = now - self._told.get(name, -self._interval) >= self._interval
            if due:
                self._told[name] = now
        if due and self._on_progress:
            self._on_progress(self.report(name))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        name = str(event.id)
        with self._lock:
            known = self._totals.setdefault(name, Totals())
            known.running, known.error = False, event.exception
        if self._on_progress:
            self._on_progress(self.report(name))
        if self._on_complete:
            self._on_complete(self.report(name))

    # reading

    def report(self, query_id) -> dict:
        name = str(query_id)
        with self._lock:
            known, total = self._totals.get(name, Totals(running=False)), self._expected.get(name)
            return {
                "batches": known.batches,
                "processed": known.processed,
                "waiting": None if total is None else max(0, total - known.processed),
                "total": total,
                "elapsed_ms": int((time.monotonic() - known.started) * 1000),
                "busy_ms": known.busy_ms,
                "is_running": known.running,
                "error": known.error,
            }

    def wait(self, query, timeout: float = 30.0) -> dict:
        """The report once the end of the query has arrived; events come after the query itself has ended."""
        ends = time.monotonic() + timeout
        while self.report(query.id)["is_running"] and time.monotonic() < ends:
            time.sleep(0.02)
        return self.report(query.id)


def listen(spark: SparkSession, **callbacks) -> ProgressListener:
    """A listener for all streams of the session from now on; ``spark.streams.removeListener`` ends it."""
    listener = ProgressListener(**callbacks)
    spark.streams.addListener(listener)
    return listener
