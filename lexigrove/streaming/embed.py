"""Embedding of a growing folder of documents as a stream."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lexigrove.functions.constants import UNASSIGNED_CLUSTER
from lexigrove.operators.encoder import embed

WRITTEN = "struct<time: timestamp, path: string, place: bigint>"
#: What decides which write of a document is the last; a missing part comes first.
ORDER = ["seq", "ts", "written"]


def read_document_stream(
    spark: SparkSession, path: str, schema: StructType | str, *, format: str = "parquet", max_files: int | None = None
) -> DataFrame:
    """New files of a folder as a stream of documents; file sources need their schema given.

    ``written`` says where a row stands in the order of writing: time and path of its file, then its place in the file.
    """
    reader = spark.readStream.format(format).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    place = F.col("_metadata.row_index") if format == "parquet" else F.monotonically_increasing_id()
    written = F.struct(
        F.col("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_path").alias("path"), place.alias("place")
    )
    return reader.load(path).select("*", written.alias("written"))


def start_embedding(
    documents: DataFrame, encoder, out_path: str, state_path: str, *, doc_id: str = "doc_id", text: str = "text",
    partitions: int | None = None, sequence: str | None = None,
) -> StreamingQuery:
    """Embed what is there now and stop by itself; a later start goes on from ``state_path``.

    A row carries its order: the caller's ``sequence`` column if one is named, then the batch's time, then ``written``.

    The file sink commits each batch once, so a lost executor or a restart repeats no row.
    ``partitions`` spreads a batch of few large files before the encoding.
    """
    cluster = F.col("cluster_id") if "cluster_id" in documents.columns else F.lit(None)
    rows = documents.select(
        doc_id,
        F.coalesce(cluster.cast("int"), F.lit(UNASSIGNED_CLUSTER)).alias("cluster_id"),
        (F.col(sequence) if sequence else F.lit(None)).cast("long").alias("seq"),
        F.current_timestamp().alias("ts"),
        (F.col("written") if "written" in documents.columns else F.lit(None).cast(WRITTEN)).alias("written"),
        text,
    )
    if partitions:
        rows = rows.repartition(partitions)
    return (
        embed(rows, encoder, text=text)
        .writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", state_path)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def wait_for_completion(
    query: StreamingQuery, timeout: float | None = None, *, on_progress: Callable[[dict], None] | None = None,
    on_complete: Callable[[dict], None] | None = None, interval: float = 1.0,
) -> bool:
    """True once all waiting documents are embedded; False at the time limit.

    ``on_progress`` is called with the last batch's report whenever there is a new one, ``on_complete`` once at the end.
    """
    ends, seen = None if timeout is None else time.monotonic() + timeout, None
    while True:
        left = interval if ends is None else min(interval, ends - time.monotonic())
        done = bool(query.awaitTermination(max(left, 0.001)))
        report = query.lastProgress
        if on_progress and report and report["batchId"] != seen:
            seen = report["batchId"]
            on_progress(report)
        if done:
            if on_complete:
                on_complete(report or {})
            return True
        if ends is not None and time.monotonic() >= ends:
            return False


def progress(spark: SparkSession, query: StreamingQuery, out_path: str) -> dict:
    """Documents written so far, committed batches, and whether the stream still runs.

    Both numbers come from what was written, because Spark keeps the reports of the last hundred batches only.
    """
    report = query.lastProgress
    written = spark.read.parquet(out_path) if report else None
    facts = written.agg(F.count("*"), F.count_distinct("ts"), F.min("ts"), F.max("ts")).first() if written is not None else (0, 0, None, None)
    return {
        "processed": facts[0],
        "batches": facts[1],
        "elapsed_ms": int((facts[3] - facts[2]).total_seconds() * 1000) + report["durationMs"].get("triggerExecution", 0) if facts[2] else 0,
        "is_running": query.isActive,
    }


def latest(rows: DataFrame, key: str, order_by: list[str]) -> DataFrame:
    """Last write per key; rows combine before the shuffle, so a hot key stays cheap."""
    rest = [c for c in rows.columns if c != key]
    picked = rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order_by)).alias("_row"))
    return picked.select(key, *[F.col(f"_row.{c}").alias(c) for c in rest])


def embeddings(spark: SparkSession, out_path: str, *, doc_id: str = "doc_id") -> DataFrame:
    """Current embedding of every document the stream has written."""
    return latest(spark.read.parquet(out_path), doc_id, ORDER).drop("seq", "written")


def embedding_of(spark: SparkSession, out_path: str, wanted: int, *, doc_id: str = "doc_id") -> DataFrame:
    """Embedding of one document; the filter reaches the scan."""
    return latest(spark.read.parquet(out_path).filter(F.col(doc_id) == wanted), doc_id, ORDER).drop("seq", "written")
