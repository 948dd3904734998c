"""Batches of a fixed size out of a stream, with what is left over sent on after some idle time.

Documents are dealt to lanes by a hash of their id. A lane keeps its waiting documents as list state and gives out a batch whenever it
holds enough; documents that wait for less than a batch are given out by a processing-time timer. The state is Spark's, so a
restart or a lost executor neither loses nor repeats a document, and lanes spread over the cluster. Each batch is encoded by
one call where it is formed.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

SIZE, IDLE_MS, LANES = 32, 1000, 16
_WAITING = "doc_id long, text string"
OUT = "lane int, batch_no long, size int, reason string, doc_id long, embedding array<float>"
FULL, IDLE = "full", "idle"


class Batcher(StatefulProcessor):
    """State of a lane: waiting documents, the number of its last batch and the time of its timer."""

    def __init__(self, encoder: Callable[[list[str]], np.ndarray], size: int, idle_ms: int):
        self.encoder, self.size, self.idle_ms = encoder, size, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", _WAITING)
        self.number = handle.getValueState("number", "n long")

    def _held(self) -> list[tuple]:
        return [tuple(r) for r in self.waiting.get()]

    def _batch(self, lane: int, rows: list[tuple], reason: str) -> pd.DataFrame:
        number = (self.number.get()[0] if self.number.exists() else 0) + 1
        self.number.update((number,))
        vectors = np.asarray(self.encoder([r[1] or "" for r in rows]), np.float32)
        return pd.DataFrame({
            "lane": lane, "batch_no": number, "size": len(rows), "reason": reason, "doc_id": [r[0] for r in rows], "embedding": list(vectors),
        })

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self._held()
        for part in rows:
            held += [(None if pd.isna(i) else int(i), t) for i, t in zip(part["doc_id"], part["text"], strict=True)]
            while len(held) >= self.size:
                yield self._batch(int(key[0]), held[: self.size], FULL)
                held = held[self.size :]
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if held:
            self.waiting.put(held)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        else:
            self.waiting.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self._held()
        self.waiting.clear()
        if held:
            yield self._batch(int(key[0]), held, IDLE)

    def close(self) -> None:
        pass


def encode_in_batches(
    documents: DataFrame, encoder: Callable[[list[str]], np.ndarray], *, size: int = SIZE, idle_ms: int = IDLE_MS, lanes: int = LANES,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``(lane, batch_no, size, reason, doc_id, embedding)``: a row for each document of a streaming frame.

    ``size`` is the number of documents of the row's batch, ``reason`` why it was given out. Ids are longs. The session needs the
    RocksDB state store (``rocksdb``).
    """
    rows = documents.select(
        F.pmod(F.xxhash64(doc_id), F.lit(lanes)).cast("int").alias("lane"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.groupBy("lane").transformWithStateInPandas(
        statefulProcessor=Batcher(encoder, size, idle_ms), outputStructType=OUT, outputMode="Append", timeMode="ProcessingTime")


@contextmanager
def rocksdb(spark) -> Iterator[None]:
    """Queries that start inside use the state store that list state and timers need."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def written(spark, path: str) -> int:
    """Rows that a file sink has committed; 0 before its first batch."""
    try:
        return spark.read.schema(OUT).parquet(path).count()
    except AnalysisException:  # no such folder yet
        return 0


def run_until(query, wanted: int, report: Callable[[], dict], timeout: float = 120.0) -> bool:
    """Let a stream run until ``report()["given_out"]`` reaches ``wanted``, then stop it; False at the time limit.

    Idle flushes come from timers, so the stream must go on for a while after its input has ended.
    """
    ends = time.monotonic() + timeout
    while query.isActive and time.monotonic() < ends:
        if report()["given_out"] >= wanted:
            break
        time.sleep(0.5)
    done = report()["given_out"] >= wanted
    query.stop()
    if query.exception():
        raise query.exception()
    return done
