"""The stages end to end: files, documents, features, clusters, store, experiments."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexigrove.operators import clusters as C, encoder as E, evaluate as V, profile as P, retrieval as R, tfidf as T
from lexigrove.operators.tokens import tokenize_documents
from lexigrove.plans.runtime import materialize
from lexigrove.sources import files, tables


def process_and_save(
    spark: SparkSession, directory: str, out: str, *, patterns=None, recursive: bool = True, include_metadata: bool = True,
    extractors=None,
) -> DataFrame:
    """Parse a directory and write its successes as JSON lines; nothing is written without files."""
    results = files.parse_directory(spark, directory, patterns, recursive=recursive, extractors=extractors)
    if not results.select("doc_id").isEmpty():
        tables.write_corpus_jsonl(results, out, include_metadata=include_metadata)
    return results


def ingest(spark: SparkSession, directory: str, out: str, *, patterns=None, recursive: bool = True, extractors=None) -> DataFrame:
    """Parse once into ``parsed`` and ``documents`` tables; returns the accuracy report.

    Files are parsed by many tasks at once, so the time of a file is the share it has in the
    wall-clock time of the job.
    """
    start = time.perf_counter()
    tables.write_table(files.parse_directory(spark, directory, patterns, recursive=recursive, extractors=extractors), f"{out}/parsed")
    seconds = time.perf_counter() - start
    parsed = tables.read_table(spark, f"{out}/parsed")
    tables.write_table(tables.structured_documents(parsed), f"{out}/documents")
    total = parsed.agg(F.count("*")).scalar()
    return V.accuracy_report(parsed.withColumn("extraction_time", F.lit(seconds) / total))


def build_features(spark: SparkSession, documents: DataFrame, out: str, *, num_features: int = T.NUM_FEATURES) -> DataFrame:
    """Hashed TF-IDF of the documents as a table of sparse vectors, and its metrics row."""
    start = time.perf_counter()
    tokens = tokenize_documents(documents)
    T.require_corpus(tokens)
    model = T.fit_hashed_tfidf(tokens, num_features)
    tables.write_table(T.hashed_tfidf(tokens, model), f"{out}/features")
    model.write().overwrite().save(f"{out}/features_model")
    features = tables.read_table(spark, f"{out}/features")
    seconds = time.perf_counter() - start
    n = features.count()
    metrics = spark.createDataFrame(
        [(n, num_features, [n, num_features], round(seconds, 4), round(seconds / max(1, n), 4))],
        "num_documents long, num_features int, matrix_shape array<long>, total_time_sec double, time_per_doc_sec double",
    )
    tables.append_metrics(metrics, f"{out}/feature_metrics")
    return features


def build_clusters(
    spark: SparkSession, documents: DataFrame, features: DataFrame, out: str, *, n_clusters: int = 10, max_iter: int = 20, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Cluster the features, describe the clusters, write all of it; gives assignments and clusters."""
    model, assigned, metrics = C.clustering_run(features, n_clusters, max_iter=max_iter, seed=seed)
    tables.write_table(assigned.select("doc_id", "cluster_id", "features"), f"{out}/assigned_features")
    stored = tables.read_table(spark, f"{out}/assigned_features")
    score = C.silhouette(stored)
    assignments = stored.select("doc_id", "cluster_id")
    tables.write_table(assignments, f"{out}/assignments")
    described = P.describe_clusters(documents.join(assignments, "doc_id"))
    tables.write_table(described, f"{out}/clusters")
    tables.append_metrics(metrics.withColumn("silhouette_score", F.lit(score)), f"{out}/clustering_metrics")
    model.write().overwrite().save(f"{out}/kmeans_model")
    return assignments, tables.read_table(spark, f"{out}/clusters")


def build_store(spark: SparkSession, documents: DataFrame, assignments: DataFrame, out: str, *, encoder=None):
    """Embed the documents and save the vector store and its centroids; gives both and the encoder."""
    encoder = encoder or E.fit_encoder(documents)
    vectors = E.embed(documents.select("doc_id", "text"), encoder)
    tables.write_store(R.assign_clusters(vectors, assignments), f"{out}/store")
    store = tables.read_store(spark, f"{out}/store")
    tables.write_table(R.centroids(store.filter(F.col("cluster_id") >= 0)), f"{out}/centroids")
    return store, tables.read_table(spark, f"{out}/centroids"), encoder


def run_experiments(
    spark: SparkSession, queries: DataFrame, store: DataFrame, centers: DataFrame, encoder, *, k: int = 5, num_runs: int = 10
) -> DataFrame:
    """Time both searches over the whole batch of queries, ``num_runs`` times.

    ``queries`` is ``(query_id, text)``. A run answers all queries in one job per step, and every
    query is given the run's time over the number of queries. Returns the nested rows that
    ``experiment_summary`` lays flat.
    """

    def ran(df: DataFrame) -> None:
        df.write.format("noop").mode("overwrite").save()

    n_queries = max(1, queries.count())
    rows = []
    searched = None
    for run_no in range(1, num_runs + 1):
        # each step is timed on the stored result of the one before, so no time holds another
        asked, embedding = V.timed(lambda: materialize(E.embed(queries.select("query_id", "text"), encoder)))
        chosen, selection = V.timed(lambda: materialize(R.select_cluster(asked, centers)))
        _, search = V.timed(lambda: ran(R.search_chosen(asked, store, chosen, k)))
        _, flat = V.timed(lambda: ran(R.flat_search(asked, store, k)))
        if searched is None:
            searched = R.documents_searched(chosen, store)
        rows.append((run_no, *[t / n_queries for t in (embedding, selection + search, selection, search, flat, flat)]))
    times = spark.createDataFrame(
        rows,
        "run_no int, embedding_time_ms double, cluster_latency_ms double, cluster_selection_ms double, "
        "cluster_search_ms double, flat_latency_ms double, flat_search_ms double",
    )
    # the times are one row per run, so each query is repeated num_runs times
    per_query = queries.join(searched, "query_id").withColumn("run_no", F.explode(F.sequence(F.lit(1), F.lit(num_runs))))
    runs = per_query.join(times, "run_no").select(
        F.col("text").alias("query"), "run_no", *V.RUN_COLUMNS,
        F.col("docs_searched").alias("cluster_docs_searched"), "flat_docs_searched",
    )
    return V.experiment_rows(runs, k=k, corpus_size=store.agg(F.count("*")).scalar())
