"""K-means, its metrics and cluster statistics."""

from __future__ import annotations

import time

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lexigrove.operators.nearest import nearest_of_few
from lexigrove.operators.tfidf import feature_rows
from lexigrove.plans.runtime import broadcast_if_small


#: Partitions of a small fit, and how many rows a partition of a larger one holds at most.
LAYOUT, LAYOUT_ROWS = 16, 1 << 17
INIT_STEPS = 5


def layout_of(rows: int) -> int:
    """Partitions for so many rows: a power of two that only the rows decide, not cores or input splits."""
    return max(LAYOUT, 1 << (-(-rows // LAYOUT_ROWS) - 1).bit_length())


def fit_kmeans(
    features: DataFrame, k: int = 5, *, max_iter: int = 100, seed: int = 42, doc_id: str = "doc_id", layout: int | None = None
) -> KMeansModel:
    """Fit on ``(doc_id, features)``; ``k`` is lowered to the number of rows.

    Rows are laid out by ``doc_id`` in sorted partitions whose number follows from the number of rows (``layout_of``), because the
    start of the algorithm draws by partition: cores and input splits then don't change the result. The start takes
    ``INIT_STEPS`` rounds of candidates, so that no far cluster is missed. The features are kept across the iterations and spill to disk where memory is short.
    """
    found = features.count()
    if found < 2:
        raise ValueError("clustering needs at least two rows")
    placed = features.repartition(layout or layout_of(found), doc_id).sortWithinPartitions(doc_id)
    kept = placed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return KMeans(k=min(k, found), maxIter=max_iter, seed=seed, featuresCol="features", predictionCol="cluster_id", initSteps=INIT_STEPS).fit(kept)
    finally:
        kept.unpersist()


def assign(model: KMeansModel, features: DataFrame) -> DataFrame:
    """Features with the nearest centre of each row as ``cluster_id``."""
    return model.transform(features)


def centers(spark: SparkSession, model: KMeansModel) -> DataFrame:
    """``(cluster_id, centroid)`` of a fitted model, which holds k rows."""
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, "cluster_id int, centroid array<double>")


def assign_to_centers(points: DataFrame, centers: DataFrame, *, doc_id: str = "doc_id") -> DataFrame:
    """Nearest given centre by squared distance."""
    found = nearest_of_few(points, centers, 1, metric="l2", query_id=doc_id)
    return found.select(doc_id, F.col("cluster_id").cast("int").alias("cluster_id"), F.col("score").alias("distance"))


def not_nearest(spark: SparkSession, model: KMeansModel, assigned: DataFrame, *, doc_id: str = "doc_id") -> Column:
    """Rows of sparse ``features`` whose centre is farther than another one, as a scalar: distances from products of their entries.

    The centres move as rows by feature (at most ``k`` numbers each); a document's products are summed before and after one shuffle.
    """
    middle = np.array(model.clusterCenters())
    k, squares = len(middle), (middle**2).sum(axis=1)
    used = np.flatnonzero(middle.any(axis=0))
    weights = spark.createDataFrame(
        pd.DataFrame({"feature": used.astype("int32"), "weights": middle[:, used].T.tolist()}), "feature int, weights array<double>")
    entries = feature_rows(assigned, doc_id=doc_id).join(broadcast_if_small(weights), "feature")
    products = entries.groupBy(doc_id).agg(F.array([F.sum(F.col("weight") * F.col("weights")[c]) for c in range(k)]).alias("products"))
    # a document that shares no feature with any centre is as far from each as the centre is long
    gaps = F.array([F.lit(float(squares[c])) - 2 * F.coalesce(F.col("products")[c], F.lit(0.0)) for c in range(k)])
    known = assigned.select(doc_id, "cluster_id").join(products, doc_id, "left").select("cluster_id", gaps.alias("gaps"))
    slack = 1e-9 * (1.0 + float(squares.max()))
    return known.agg(F.count_if(F.get("gaps", "cluster_id") > F.array_min("gaps") + slack)).scalar()


def one_cluster_cost(features: DataFrame) -> float:
    """Sum of squared distances to the mean of all rows."""
    row = features.select(Summarizer.metrics("mean", "normL2", "count").summary(F.col("features")).alias("s")).first()["s"]
    return float((row["normL2"].toArray() ** 2).sum() - row["count"] * (row["mean"].toArray() ** 2).sum())


def fit_facts(model: KMeansModel, assigned: DataFrame) -> DataFrame:
    """One row that any sound fit shares: points, clusters in range, and a cost no higher than that of one cluster."""
    k = len(model.clusterCenters())
    single = one_cluster_cost(assigned)
    sizes = assigned.groupBy("cluster_id").agg(F.count("*").alias("size"))
    return sizes.agg(
        F.coalesce(F.sum("size"), F.lit(0)).alias("points"),
        F.count_if(~F.col("cluster_id").between(0, k - 1)).alias("clusters_out_of_range"),
        (F.count("*") <= k).alias("clusters_at_most_k"),
        F.lit(bool(model.summary.trainingCost <= single * (1 + 1e-9))).alias("cost_not_above_one_cluster"),
    )


def silhouette(assigned: DataFrame) -> float:
    """Mean silhouette with squared Euclidean distances."""
    return ClusteringEvaluator(
        predictionCol="cluster_id", featuresCol="features", metricName="silhouette", distanceMeasure="squaredEuclidean"
    ).evaluate(assigned)


def cluster_stats(assigned: DataFrame) -> DataFrame:
    """``(cluster_id, size, percentage)``. Members stay rows of the assignment table."""
    sizes = assigned.groupBy("cluster_id").agg(F.count("*").alias("size"))
    total = sizes.agg(F.sum("size")).scalar()
    return sizes.withColumn("percentage", F.col("size").cast("double") / total * 100)


def clustering_run(
    features: DataFrame, k: int = 5, *, max_iter: int = 100, seed: int = 42
) -> tuple[KMeansModel, DataFrame, DataFrame]:
    """Model, assignments and one row of run metrics."""
    spark = features.sparkSession
    start = time.perf_counter()
    model = fit_kmeans(features, k, max_iter=max_iter, seed=seed)
    assigned = assign(model, features)
    layout = features.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n"))
    facts = layout.agg(F.count("*").alias("parts"), F.sum("n").alias("n")).first()
    workers = spark.sparkContext.defaultParallelism
    row = (
        round(time.perf_counter() - start, 3), workers, facts["parts"], model.summary.numIter, facts["n"],
        len(model.clusterCenters()[0]), facts["n"] // max(workers, 1),
    )
    schema = (
        "clustering_time_seconds double, num_workers int, num_partitions long, num_iterations int, "
        "num_documents long, feature_dimensions int, documents_per_worker long"
    )
    return model, assigned, spark.createDataFrame([row], schema)


def partition_layout(df: DataFrame) -> DataFrame:
    """``(partition, documents)``: how the rows lie over the partitions."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("documents"))
