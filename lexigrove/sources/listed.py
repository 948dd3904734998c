"""Folders of documents as a data source, for batches and streams: listed in tasks, read in partitions of even bytes.

``refresh`` lists a folder level by level, a task per few subfolders, and adds what is new or changed to a manifest as its next
version. A version holds the files in bins of about ``bin_bytes``; the driver only learns how many bins there are. The data
source ``document_files`` reads a manifest: as a batch all its versions, as a stream one version after the other, whose
number is the offset, so that a repeated batch reads the same files. Both give the columns that ``files.parse_files`` takes.

A version counts once its entry among the commits is complete; what a failed ``refresh`` leaves is ignored. One process at a
time may refresh a manifest. Places are what ``pyarrow.fs`` opens (local or shared folders, ``hdfs:``, ``s3:``, ``gs:``).

Defined results: a missing folder raises, one that vanishes while it is listed has no files. Hidden files and folders are
skipped. A file that is gone when it is read has null bytes, and becomes a failed row when parsed; an empty one has empty bytes.
"""

from __future__ import annotations

import fnmatch
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from lexigrove.operators.running import running_totals
from lexigrove.plans.runtime import broadcast_if_small, materialize
from lexigrove.sources import files

#: Bytes of a bin, and what opening a file adds to its size: a bin of small files holds about a thousand.
BIN_BYTES, OPEN_BYTES = 128 << 20, 128 << 10
#: Bins for each core at least, as long as there are so many files.
BINS_PER_CORE = 2
#: Bins whose file names share a folder of the manifest.
BINS_PER_SLICE = 256
#: Bytes of a row group of the manifest; a task reads those with its bin.
ROW_GROUP_BYTES = 1 << 20
#: Bytes that a task hands over at once.
BATCH_BYTES = 16 << 20

SCHEMA = "path string, length long, modified long, version int, content binary"


def _place(path: str) -> tuple[fs.FileSystem, str, str]:
    """File system, path inside it, and what stands before such a path in the names given out."""
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), os.path.abspath(path), "file:"
    system, inner = fs.FileSystem.from_uri(path)
    return system, inner, path.removesuffix(inner)


def _hidden(name: str) -> bool:
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def _list_folders(patterns: list[str], must_exist: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                system, inner, before = _place(folder)
                held = system.get_file_info(fs.FileSelector(inner, allow_not_found=not must_exist))
                held = [i for i in held if not _hidden(i.base_name)]
                held = [i for i in held if i.type == fs.FileType.Directory or any(fnmatch.fnmatchcase(i.base_name, p) for p in patterns)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([before + i.path for i in held], pa.string()), pa.array([max(i.size or 0, 0) for i in held], pa.int64()),
                    pa.array([i.mtime_ns or 0 for i in held], pa.int64()),
                    pa.array([i.type == fs.FileType.Directory for i in held], pa.bool_()),
                ], ["path", "length", "modified", "folder"])

    return run


def list_files(spark: SparkSession, directory: str, patterns: list[str] | None = None, *, recursive: bool = True) -> DataFrame:
    """``(path, length, modified)`` of the matching files below a folder; one job for each level of subfolders."""
    patterns = files.DEFAULT_PATTERNS if patterns is None else patterns
    level, levels, tasks = spark.createDataFrame([(directory,)], "path string"), [], spark.sparkContext.defaultParallelism
    while True:
        schema = "path string, length long, modified long, folder boolean"
        listed = materialize(level.mapInArrow(_list_folders(patterns, not levels), schema))
        levels.append(listed.filter("not folder").drop("folder"))
        below = listed.filter("folder").select("path")
        count = below.count() if recursive else 0
        if not count:
            return reduce(DataFrame.union, levels)
        # a stated number, as the few bytes of the names would be put into one task
        level = below.repartition(min(count, 8 * tasks), "path")


@dataclass
class _Version:
    version: int
    bins: int


def _commits(manifest: str) -> list[_Version]:
    """The complete versions of a manifest, in order."""
    system, inner, _ = _place(manifest)
    found = []
    for entry in system.get_file_info(fs.FileSelector(f"{inner}/commits", allow_not_found=True)):
        held = {i.base_name: i for i in system.get_file_info(fs.FileSelector(entry.path))}
        if "_SUCCESS" in held:
            parts = [i.path for name, i in held.items() if name.endswith(".parquet")]
            rows = [row for p in parts for row in pq.read_table(p, filesystem=system).to_pylist()]
            found += [_Version(row["version"], row["bins"]) for row in rows]
    return sorted(found, key=lambda v: v.version)


def _next_version(manifest: str) -> int:
    """One more than any version that was begun."""
    system, inner, _ = _place(manifest)
    begun = system.get_file_info(fs.FileSelector(f"{inner}/files", allow_not_found=True))
    return 1 + max((int(i.base_name.partition("=")[2]) for i in begun if i.base_name.startswith("version=")), default=0)


def _manifest_rows(spark: SparkSession, manifest: str, versions: list[int]) -> DataFrame:
    return spark.read.parquet(f"{manifest}/files").filter(F.col("version").isin(versions))


def refresh(
    spark: SparkSession, directory: str, manifest: str, patterns: list[str] | None = None, *, recursive: bool = True,
    bin_bytes: int = BIN_BYTES,
) -> int:
    """Add the files that no version holds with their size and time; returns the last version, which stays if nothing is new.

    Bins hold fewer than ``bin_bytes`` where there would be too few of them for all cores.
    """
    listed = list_files(spark, directory, patterns, recursive=recursive)
    known = _commits(manifest)
    if known:
        before = _manifest_rows(spark, manifest, [v.version for v in known]).select("path", "length", "modified")
        listed = materialize(listed.join(before, ["path", "length", "modified"], "left_anti"))
    if listed.isEmpty():
        return known[-1].version if known else 0
    cost = (F.col("length") + OPEN_BYTES).alias("cost")
    total = listed.agg(F.sum(F.col("length") + OPEN_BYTES)).first()[0]
    bin_bytes = max(1, min(bin_bytes, total // (BINS_PER_CORE * spark.sparkContext.defaultParallelism)))
    placed = running_totals(listed.select("*", cost), "cost", ["path"])
    binned = placed.select("path", "length", "modified", F.floor((F.col("cumulative") - F.col("cost")) / bin_bytes).cast("int").alias("bin"))
    binned = materialize(binned.withColumn("slice", F.floor(F.col("bin") / BINS_PER_SLICE).cast("int")))
    version = _next_version(manifest)
    slices, bins = binned.agg(F.max("slice"), F.max("bin")).first()
    sliced = binned.repartition(slices + 1, "slice").sortWithinPartitions("slice", "bin")
    sliced.write.option("parquet.block.size", ROW_GROUP_BYTES).partitionBy("slice").parquet(f"{manifest}/files/version={version}")
    spark.createDataFrame([(version, bins + 1)], "version int, bins int").coalesce(1).write.parquet(f"{manifest}/commits/{version}")
    return version


@dataclass
class _Bin(InputPartition):
    version: int
    number: int


class _Reader:
    """What the batch and the stream reader share: bins of versions, and the bytes of a bin's files."""

    def __init__(self, options):
        self.manifest = options["path"]

    def bins(self, after: int, until: float) -> list[_Bin]:
        return [_Bin(v.version, n) for v in _commits(self.manifest) if after < v.version <= until for n in range(v.bins)]

    def read(self, partition: _Bin | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # Spark's way of reading a source without partitions
            return
        system, inner, _ = _place(self.manifest)
        place = f"{inner}/files/version={partition.version}/slice={partition.number // BINS_PER_SLICE}"
        names = [i.path for i in system.get_file_info(fs.FileSelector(place)) if i.path.endswith(".parquet")]
        rows, size = [], 0
        for name in names:
            # the folder's names would be read as columns, so each file is opened by itself
            with system.open_input_file(name) as opened:
                listed = pq.read_table(opened, columns=["path", "length", "modified", "bin"], filters=[("bin", "==", partition.number)])
            for row in listed.to_pylist():
                source, file, _ = _place(row["path"])
                try:
                    with source.open_input_stream(file) as opened:
                        content = opened.read()
                except FileNotFoundError:
                    content = None
                rows.append((row["path"], row["length"], row["modified"], partition.version, content))
                size += len(content or b"")
                if size > BATCH_BYTES:
                    yield self.batch(rows)
                    rows, size = [], 0
        if rows:
            yield self.batch(rows)

    def batch(self, rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["path", "length", "modified", "version", "content"])


class _BatchReader(_Reader, DataSourceReader):
    def partitions(self):
        return self.bins(0, float("inf"))


class _StreamReader(_Reader, DataSourceStreamReader):
    def initialOffset(self):
        return {"version": 0}

    def latestOffset(self):
        return {"version": max((v.version for v in _commits(self.manifest)), default=0)}

    def partitions(self, start, end):
        return self.bins(start["version"], end["version"])


class DocumentFiles(DataSource):
    """``spark.read.format("document_files").load(manifest)``, and the same with ``readStream``."""

    @classmethod
    def name(cls) -> str:
        return "document_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return _BatchReader(self.options)

    def streamReader(self, schema):
        return _StreamReader(self.options)


def parse_manifest(spark: SparkSession, manifest: str, *, extractors: dict | None = None) -> DataFrame:
    """The files of all versions, parsed; of a file that changed only the last version."""
    spark.dataSource.register(DocumentFiles)
    read = spark.read.format("document_files").load(manifest)
    versions = [v.version for v in _commits(manifest)]
    if len(versions) > 1:
        listed = _manifest_rows(spark, manifest, versions)
        last = listed.groupBy("path").agg(F.max("version").alias("last"), F.min("version").alias("first")).filter("first < last")
        old = listed.join(last, "path").filter("version < last").select("path", "version")
        read = read.join(broadcast_if_small(old), ["path", "version"], "left_anti")
    return files.parse_files(read, extractors=extractors)


def stream_manifest(spark: SparkSession, manifest: str, *, extractors: dict | None = None) -> DataFrame:
    """The versions of a manifest as a stream of parsed files; a file that changed comes again with its new text."""
    spark.dataSource.register(DocumentFiles)
    return files.parse_files(spark.readStream.format("document_files").load(manifest), extractors=extractors)


def write_files(docs: DataFrame, directory: str, *, text: str = "text", doc_id: str = "doc_id", per_folder: int = 1000) -> DataFrame:
    """Each document as a UTF-8 text file of its own; returns ``(doc_id, path, length)``, stored when called.

    Ids must be unique, a null id raises; a null text is an empty file. Folders by the hash of the id hold about ``per_folder`` files.
    A file gets its name once it is whole, so a task that runs twice leaves the same files.
    """
    folders = max(1, -(-docs.count() // per_folder))
    _place(directory)[0].create_dir(_place(directory)[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, inner, before = _place(directory)
        made = set()
        for batch in batches:
            ids, places, sizes = [], [], []
            for name, folder, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if name is None:
                    raise ValueError("a document without an id has no file name")
                if folder not in made:
                    system.create_dir(f"{inner}/{folder}")
                    made.add(folder)
                content = (value or "").encode()
                place, draft = f"{inner}/{folder}/{quote(name, safe='')}.txt", f"{inner}/{folder}/.{uuid.uuid4().hex}"
                with system.open_output_stream(draft) as opened:
                    opened.write(content)
                system.move(draft, place)
                ids.append(name)
                places.append(before + place)
                sizes.append(len(content))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(places, pa.string()), pa.array(sizes, pa.int64())], ["doc_id", "path", "length"])

    kind = docs.schema[doc_id].dataType
    rows = docs.select(F.col(doc_id).cast("string").alias("id"), F.pmod(F.xxhash64(doc_id), F.lit(folders)).alias("folder"), F.col(text).alias("text"))
    written = rows.mapInArrow(run, "doc_id string, path string, length long")
    return materialize(written.select(F.col("doc_id").cast(kind).alias("doc_id"), "path", "length"))
