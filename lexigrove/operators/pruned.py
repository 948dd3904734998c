"""Exact nearest vectors that reads only what the triangle inequality can't rule out.

The index keeps each vector's distance to its cluster's centroid (``radius``) and lies in blocks: sorted ranges of cluster and
radius of bounded size, so a cluster that holds a third of all vectors just has more blocks. A vector x of a cluster with
centroid c is at least ``|d(q, c) - radius(x)|`` from a query q.

A search goes in rounds. The first probes each query's clusters with the smallest bounds, which gives its k-th best distance so
far. The last probes all other clusters whose bound is within that distance, and in them only the blocks, and in the blocks
only the vectors, whose radius lies in the window around ``d(q, c)``. What is left out can't be among the k nearest, so
results are those of the flat search. A block meets only the queries that need it, some thousands at a time.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lexigrove.functions import vectors as V
from lexigrove.operators.nearest import best_within, ranked, vector_bytes
from lexigrove.operators.retrieval import centroids
from lexigrove.plans.runtime import BROADCAST_BYTES, broadcast_if_small, materialize, scratch_scope

BLOCK_BYTES = 16 * 1024 * 1024
#: Queries that one block meets in one group.
GROUP_QUERIES = 4096
#: Bounds are compared at this precision; windows are wider by this share, so rounding loses no vector.
BOUND_DIGITS, SLACK = 9, 1e-9

_ITEM = "cluster_id int, block int, item_id long, radius double, vector array<double>"
_TARGET = "query_id long, vector array<double>, cluster_id int, gap double, reach double"
_COLUMNS = {"query_id": "long", "item_id": "long", "score": "double", "settled": "double", "vectors_read": "long"}
#: Rows with an item, and for each query and block one without that counts the vectors read.
_FOUND = ", ".join(f"{name} {kind}" for name, kind in _COLUMNS.items())


class Index(NamedTuple):
    """``items`` in blocks; one row per block and one per cluster about them."""

    items: DataFrame
    blocks: DataFrame
    centers: DataFrame


def build_index(store: DataFrame, *, item_id: str = "doc_id", vector: str = "embedding", block_bytes: int = BLOCK_BYTES) -> Index:
    """The index of a store ``(item_id, cluster_id, vector)``; rows without a vector stay out. Runs jobs when called."""
    rows = store.filter(F.col(vector).isNotNull()).select(
        F.col("cluster_id").cast("int").alias("cluster_id"), F.col(item_id).cast("long").alias("item_id"),
        F.col(vector).cast("array<double>").alias("vector"))
    means = broadcast_if_small(centroids(rows.withColumnRenamed("vector", "embedding")))
    measured = rows.join(means, "cluster_id").withColumn("radius", F.sqrt(V.squared_l2("vector", "centroid")))
    total = vector_bytes(rows)[1]
    ranges = measured.select("cluster_id", "item_id", "radius", "vector").repartitionByRange(
        max(1, math.ceil(total / block_bytes)), "cluster_id", "radius", F.xxhash64("item_id"))
    items = materialize(ranges.sortWithinPartitions("cluster_id", "radius").select(
        "cluster_id", F.spark_partition_id().alias("block"), "item_id", "radius", "vector"))
    return index_of(items, means)


def index_of(items: DataFrame, means: DataFrame) -> Index:
    """The index over stored items, for example read again from where ``write_index`` put them."""
    blocks = materialize(items.groupBy("cluster_id", "block").agg(
        F.min("radius").alias("low"), F.max("radius").alias("high"), F.count("*").alias("size")))
    ends = blocks.groupBy("cluster_id").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return Index(items, blocks, materialize(means.join(ends, "cluster_id").select("cluster_id", "centroid", "low", "high")))


def write_index(index: Index, path: str) -> None:
    """Files by cluster, sorted by radius, so row groups cover short ranges of it."""
    index.items.repartition("cluster_id", "block").sortWithinPartitions("cluster_id", "block", "radius").write.partitionBy(
        "cluster_id").mode("overwrite").parquet(f"{path}/items")
    index.centers.select("cluster_id", "centroid").write.mode("overwrite").parquet(f"{path}/centers")


def read_index(spark, path: str) -> Index:
    items = spark.read.schema(_ITEM).parquet(f"{path}/items")
    return index_of(items, spark.read.parquet(f"{path}/centers"))


def _bounds(vectors: np.ndarray, centers: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distance of each query to each centroid, and what any vector of the cluster is away at least."""
    gap = np.empty((len(vectors), len(centers)))
    for k, center in enumerate(centers):  # sums of squared gaps: the product form cancels
        gap[:, k] = np.sqrt(((vectors - center) ** 2).sum(1))
    return gap, np.round(np.maximum(0.0, np.maximum(gap - high, low - gap)), BOUND_DIGITS)


def _targets(asked: DataFrame, centers: DataFrame, first: int, rest: bool) -> DataFrame:
    """Clusters to probe: of each query the ``first`` by bound, or the others that its reach allows.

    Only the centroids are broadcast; ``search`` has checked their size. ``reach`` is a distance, infinite where fewer than k
    vectors are known.
    """
    table = centers.orderBy("cluster_id").toArrow()
    ids = table["cluster_id"].to_numpy()
    held = asked.sparkSession.sparkContext.broadcast((
        ids, _matrix(table["centroid"]), table["low"].to_numpy(), table["high"].to_numpy()))

    def choose(batches):
        names, matrix, low, high = held.value
        for batch in batches:
            if not batch.num_rows or not len(names):
                continue
            vectors = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            reach = batch.column("reach").to_numpy(zero_copy_only=False)
            gap, bound = _bounds(vectors, matrix, low, high)
            order = np.lexsort((np.broadcast_to(names, gap.shape), np.round(gap, BOUND_DIGITS), bound), axis=1)
            wanted = np.zeros(gap.shape, bool)
            np.put_along_axis(wanted, order[:, :first], True, axis=1)
            if rest:
                wanted = ~wanted & (bound <= _wider(reach[:, None], gap))
            row, column = np.nonzero(wanted)
            yield pa.RecordBatch.from_arrays([
                batch.column("query_id").take(pa.array(row)), batch.column("vector").take(pa.array(row)), pa.array(names[column]),
                pa.array(gap[row, column]), pa.array(reach[row])], ["query_id", "vector", "cluster_id", "gap", "reach"])

    return asked.mapInArrow(choose, _TARGET)


def _wider(reach: np.ndarray, gap: np.ndarray) -> np.ndarray:
    return reach + SLACK * (reach + gap)


def _probe(targets: DataFrame, index: Index, blocks: DataFrame, k: int, chunks: int) -> DataFrame:
    """The best k of each target's window in each block within its reach, and how many vectors that took."""
    slack = F.col("reach") + SLACK * (F.col("reach") + F.col("gap"))
    pairs = materialize(targets.join(blocks, "cluster_id").filter(
        (F.col("high") >= F.col("gap") - slack) & (F.col("low") <= F.col("gap") + slack)
    ).select("cluster_id", "block", F.pmod(F.xxhash64("query_id"), F.lit(chunks)).cast("int").alias("chunk"), "query_id", "vector", "gap", "reach"))
    keys = ("cluster_id", "block", "chunk")
    needed = pairs.select(*(F.col(c).alias(c) for c in keys)).distinct()  # aliases: the groups below meet their own source
    items = index.items.join(needed, ["cluster_id", "block"])

    def search(asked: pa.Table, held: pa.Table) -> pa.Table:
        radius = held["radius"].to_numpy()
        order = np.argsort(radius, kind="stable")
        radius, ids = radius[order], held["item_id"].to_numpy()[order]
        vectors = _matrix(held["vector"])[order]
        queries, query_ids = _matrix(asked["vector"]), asked["query_id"].to_numpy()
        gap, reach = asked["gap"].to_numpy(), asked["reach"].to_numpy()
        width = _wider(reach, gap)
        start, end = np.searchsorted(radius, gap - width, "left"), np.searchsorted(radius, gap + width, "right")
        best = best_within(query_ids, queries, ids, vectors, k, reach * reach * (1 + SLACK), start, end)
        read = np.maximum(0, end - start)
        seen = pa.table({"query_id": query_ids[read > 0], "vectors_read": read[read > 0].astype(np.int64)})
        return pa.concat_tables([pa.Table.from_batches([best]), seen], promote_options="default").select(list(_COLUMNS))

    return pairs.groupBy(*keys).cogroup(items.groupBy(*keys)).applyInArrow(search, _FOUND)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = [c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]
    return np.concatenate([np.empty(0), *flat]).reshape(len(column), -1 if len(column) else 0)


def search(
    queries: DataFrame, index: Index, k: int = 5, *, first: int = 1, query_id: str = "query_id", vector: str = "embedding", item_id: str = "doc_id"
) -> DataFrame:
    """``(query_id, item_id, rank, distance, vectors_read)``: squared distances, and the vectors compared with the query.

    ``first`` is the number of clusters that the first round probes. Query ids are longs and name a query each; queries without a
    vector give no row. Runs jobs when called.
    """
    if k < 1 or first < 1:
        raise ValueError("k and first must be at least 1")
    spark = queries.sparkSession
    with scratch_scope(spark):
        n_centers, center_bytes = vector_bytes(index.centers.select(F.col("centroid").alias("vector")))
        if center_bytes > BROADCAST_BYTES:
            raise ValueError(f"{n_centers} centroids are too many to be broadcast; use fewer clusters")
        asked = materialize(queries.filter(F.col(vector).isNotNull()).select(
            F.col(query_id).cast("long").alias("query_id"), F.col(vector).cast("array<double>").alias("vector")))
        chunks = max(1, math.ceil(asked.count() / GROUP_QUERIES))
        blocks = broadcast_if_small(index.blocks, stored=True)
        near = _targets(asked.withColumn("reach", F.lit(math.inf)), index.centers, first, rest=False)
        begun = materialize(_probe(near, index, blocks, k, chunks))
        place = F.row_number().over(Window.partitionBy("query_id").orderBy("settled", "item_id"))
        reaches = begun.filter("item_id IS NOT NULL").withColumn("place", place).filter(F.col("place") == k).select("query_id", F.sqrt("score").alias("reach"))
        waiting = asked.join(reaches, "query_id", "left").withColumn("reach", F.coalesce("reach", F.lit(math.inf)))
        others = _probe(_targets(waiting, index.centers, first, rest=True), index, blocks, k, chunks)
        found = materialize(begun.unionByName(others))
        read = found.groupBy("query_id").agg(F.sum("vectors_read").alias("vectors_read"))
        rows = ranked(found.filter("item_id IS NOT NULL").drop("vectors_read"), k).join(read, "query_id")
        return materialize(rows.select(
            F.col("query_id").alias(query_id), F.col("item_id").alias(item_id), "rank", F.col("score").alias("distance"), "vectors_read"), outlive=True)
