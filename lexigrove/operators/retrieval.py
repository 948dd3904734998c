"""Vector store, cluster selection, cluster-aware and flat search, and their comparison."""

from __future__ import annotations

from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from lexigrove.functions import vectors as V
from lexigrove.functions.constants import UNASSIGNED_CLUSTER
from lexigrove.operators.nearest import nearest, nearest_of_few, placed_by_nearest
from lexigrove.plans.runtime import materialize


def assign_clusters(embeddings: DataFrame, assignments: DataFrame, *, doc_id: str = "doc_id") -> DataFrame:
    """Add ``cluster_id`` from the assignments; -1 for a document that has none."""
    known = assignments.select(doc_id, F.col("cluster_id").cast("int").alias("cluster_id"))
    return embeddings.drop("cluster_id").join(known, doc_id, "left").withColumn(
        "cluster_id", F.coalesce("cluster_id", F.lit(UNASSIGNED_CLUSTER))
    )


def add_embeddings(store: DataFrame | None, new: DataFrame, *, doc_id: str = "doc_id") -> DataFrame:
    """Keyed upsert: a document that comes again replaces its stored row."""
    if store is None:
        return new
    return store.join(new.select(doc_id), doc_id, "left_anti").unionByName(new)


def store_cluster_sizes(store: DataFrame) -> DataFrame:
    return store.groupBy("cluster_id").agg(
        F.count("*").alias("size"), F.max(F.size("embedding")).alias("dimension")
    )


def store_stats(store: DataFrame) -> DataFrame:
    """One row: total documents, number of clusters, dimension."""
    return store_cluster_sizes(store).agg(
        F.coalesce(F.sum("size"), F.lit(0)).alias("total_documents"),
        F.count("*").alias("num_clusters"),
        F.max("dimension").alias("dimension"),
    )


def centroids(store: DataFrame) -> DataFrame:
    """``(cluster_id, centroid)``: mean vectors, combined before the shuffle."""
    means = store.select("cluster_id", V.to_ml("embedding").alias("v")).groupBy("cluster_id").agg(
        Summarizer.mean(F.col("v")).alias("mean")
    )
    return means.select("cluster_id", V.to_array("mean").alias("centroid"))


def select_cluster(queries: DataFrame, centers: DataFrame, *, query_id: str = "query_id") -> DataFrame:
    """``(query_id, cluster_id, similarity)``: the centroid with the largest cosine."""
    found = nearest_of_few(queries, centers, 1, metric="cosine", query_id=query_id)
    return found.select(
        query_id, F.col("cluster_id").cast("int").alias("cluster_id"), F.col("score").alias("similarity")
    )


def flat_search(queries: DataFrame, store: DataFrame, k: int = 5, **names) -> DataFrame:
    """``(query_id, rank, doc_id, distance)`` over the whole store, unassigned documents included."""
    found = nearest(queries, store, k, metric="l2", **names)
    return found.withColumnRenamed("score", "distance")


def cluster_aware_search(
    queries: DataFrame, store: DataFrame, centers: DataFrame, k: int = 5, *, query_id: str = "query_id", **names
) -> DataFrame:
    """Search in the best cluster only: chosen by cosine, ranked by squared distance.

    Where the store is a table partitioned by cluster, the chosen clusters become a partition
    filter of its scan.
    """
    vector = names.get("query_vector", "embedding")
    placed = placed_by_nearest(queries, centers, query_id=query_id, query_vector=vector).withColumnRenamed("score", "similarity")
    placed = materialize(placed.withColumn("cluster_id", F.col("cluster_id").cast("int")))
    return _search_placed(placed, store, placed.select(query_id, "cluster_id", "similarity"), k, query_id, names)


def search_chosen(queries: DataFrame, store: DataFrame, chosen: DataFrame, k: int = 5, *, query_id: str = "query_id", **names) -> DataFrame:
    """Search each query's chosen cluster; ``chosen`` is the stored result of ``select_cluster``."""
    placed = materialize(queries.join(chosen.select(query_id, "cluster_id"), query_id))
    return _search_placed(placed, store, chosen, k, query_id, names)


def _search_placed(placed: DataFrame, store: DataFrame, chosen: DataFrame, k: int, query_id: str, names: dict) -> DataFrame:
    found = nearest(placed, store, k, metric="l2", query_id=query_id, key="cluster_id", **names)
    return found.withColumnRenamed("score", "distance").join(chosen, query_id)


def search_cluster(queries: DataFrame, store: DataFrame, cluster_id: int, k: int = 10, **names) -> DataFrame:
    """Search inside one named cluster; an unknown cluster gives no rows."""
    part = store.filter(F.col("cluster_id") == cluster_id)
    return nearest(queries, part, k, metric="l2", **names).withColumnRenamed("score", "distance")


def documents_searched(chosen: DataFrame, store: DataFrame, *, query_id: str = "query_id") -> DataFrame:
    """Documents read per query by both methods and the share saved.

    Store sizes are one row per cluster; the grand total is a scalar over them.
    """
    sizes = store_cluster_sizes(store)
    total = sizes.agg(F.sum("size")).scalar()
    joined = chosen.join(sizes.select("cluster_id", "size"), "cluster_id", "left")
    searched = F.coalesce("size", F.lit(0))
    return joined.select(
        query_id,
        "cluster_id",
        searched.alias("docs_searched"),
        total.alias("flat_docs_searched"),
        ((F.lit(1.0) - F.try_divide(searched.cast("double"), total.cast("double"))) * 100).alias("reduction_pct"),
    )


def compare_searches(
    aware: DataFrame, flat: DataFrame, searched: DataFrame | None = None, *, aware_ms: float | None = None,
    flat_ms: float | None = None, query_id: str = "query_id",
) -> DataFrame:
    """Per query: hits of both methods and how many documents they share.

    ``searched`` (from ``documents_searched``) adds the documents read and the share saved; the two times of a query add
    the speedup (0 for a time of 0) and the difference.
    """
    both = (
        flat.select(query_id, "doc_id", F.lit(1).alias("f"), F.lit(0).alias("c"))
        .unionByName(aware.select(query_id, "doc_id", F.lit(0).alias("f"), F.lit(1).alias("c")))
        .groupBy(query_id, "doc_id")
        .agg(F.max("f").alias("f"), F.max("c").alias("c"))
    )
    compared = both.groupBy(query_id).agg(
        F.sum("f").alias("flat_hits"), F.sum("c").alias("aware_hits"),
        F.sum(F.col("f") * F.col("c")).alias("shared_hits"),
    )
    if searched is not None:
        compared = compared.join(searched.select(query_id, "docs_searched", "flat_docs_searched", "reduction_pct"), query_id, "left")
    if aware_ms is not None and flat_ms is not None:
        compared = compared.withColumns({
            "speedup": F.lit(flat_ms / aware_ms if aware_ms else 0.0), "latency_diff_ms": F.lit(float(flat_ms - aware_ms)),
        })
    return compared
