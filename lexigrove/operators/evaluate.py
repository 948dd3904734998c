"""Reports: parsing accuracy, latency, experiments, precision and scaling."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, functions as F

from lexigrove.functions.constants import SIGNIFICANT_SPEEDUP


def _ratio(a: Column, b: Column) -> Column:
    """``a / b`` in double precision, 0 where the divisor is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def accuracy_report(results: DataFrame, *, success: str = "success", seconds: str = "extraction_time") -> DataFrame:
    """One row, also over no results at all, where every number is 0."""
    sums = results.agg(
        F.count("*").alias("total_processed"),
        F.count_if(success).alias("successful"),
        F.count_if(~F.col(success)).alias("failed"),
        F.coalesce(F.sum(seconds), F.lit(0.0)).alias("total_time"),
    )
    total = F.col("total_processed")
    return sums.select(
        "total_processed", "successful", "failed",
        (_ratio(F.col("successful"), total) * 100).alias("accuracy"),
        _ratio(F.col("total_time"), total).alias("avg_time_per_doc"),
        "total_time",
        _ratio(total, F.col("total_time")).alias("docs_per_second"),
        (_ratio(F.col("total_time"), total) * 1000).alias("ms_per_doc"),
    )


def latency_stats(runs: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Mean, population deviation, smallest and largest value per group."""
    return runs.groupBy(*keys).agg(
        F.count("*").alias("runs"),
        F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.sum(value).alias("total"),
    )


RUN_COLUMNS = [
    "embedding_time_ms", "cluster_latency_ms", "cluster_selection_ms", "cluster_search_ms",
    "flat_latency_ms", "flat_search_ms",
]


def experiment_rows(runs: DataFrame, *, k: int, corpus_size: Column | int) -> DataFrame:
    """Nested experiment result per query from one row per (query, run).

    Documents searched come from the first run, times are means over the runs.
    """
    size = corpus_size if isinstance(corpus_size, Column) else F.lit(corpus_size)
    stats = runs.groupBy("query").agg(
        F.count("*").alias("num_runs"),
        *[F.avg(c).alias(c) for c in RUN_COLUMNS],
        F.stddev_pop("cluster_latency_ms").alias("cluster_std"),
        F.min("cluster_latency_ms").alias("cluster_min"),
        F.max("cluster_latency_ms").alias("cluster_max"),
        F.stddev_pop("flat_latency_ms").alias("flat_std"),
        F.min("flat_latency_ms").alias("flat_min"),
        F.max("flat_latency_ms").alias("flat_max"),
        F.min_by("cluster_docs_searched", "run_no").alias("cluster_docs"),
        F.min_by("flat_docs_searched", "run_no").alias("flat_docs"),
    )
    speedup = _ratio(F.col("flat_latency_ms"), F.col("cluster_latency_ms"))
    reduction = F.lit(1.0) - F.try_divide(F.col("cluster_docs").cast("double"), F.col("flat_docs").cast("double"))
    return stats.select(
        "query",
        F.lit(k).alias("k"),
        "num_runs",
        size.alias("corpus_size"),
        F.struct(
            F.col("embedding_time_ms").alias("avg_embedding_time_ms"),
            F.struct(
                F.col("cluster_latency_ms").alias("avg_total_latency_ms"),
                F.col("cluster_selection_ms").alias("avg_cluster_selection_ms"),
                F.col("cluster_search_ms").alias("avg_search_ms"),
                F.col("cluster_std").alias("std_latency_ms"),
                F.col("cluster_min").alias("min_latency_ms"),
                F.col("cluster_max").alias("max_latency_ms"),
                F.col("cluster_docs").alias("documents_searched"),
            ).alias("cluster_aware"),
            F.struct(
                F.col("flat_latency_ms").alias("avg_total_latency_ms"),
                F.col("flat_search_ms").alias("avg_search_ms"),
                F.col("flat_std").alias("std_latency_ms"),
                F.col("flat_min").alias("min_latency_ms"),
                F.col("flat_max").alias("max_latency_ms"),
                F.col("flat_docs").alias("documents_searched"),
            ).alias("flat"),
            F.struct(
                speedup.alias("speedup"),
                (F.col("flat_latency_ms") - F.col("cluster_latency_ms")).alias("latency_difference_ms"),
                (reduction * 100).alias("search_space_reduction_pct"),
            ).alias("comparison"),
        ).alias("metrics"),
    )


def experiment_summary(experiments: DataFrame) -> DataFrame:
    """The nested rows laid flat: fifteen columns."""
    m = "metrics"
    return experiments.select(
        "query", "corpus_size", "k", "num_runs",
        F.col(f"{m}.avg_embedding_time_ms").alias("embedding_time_ms"),
        F.col(f"{m}.cluster_aware.avg_total_latency_ms").alias("cluster_aware_latency_ms"),
        F.col(f"{m}.cluster_aware.avg_cluster_selection_ms").alias("cluster_selection_ms"),
        F.col(f"{m}.cluster_aware.avg_search_ms").alias("cluster_faiss_search_ms"),
        F.col(f"{m}.cluster_aware.documents_searched").alias("cluster_aware_docs_searched"),
        F.col(f"{m}.flat.avg_total_latency_ms").alias("flat_latency_ms"),
        F.col(f"{m}.flat.avg_search_ms").alias("flat_faiss_search_ms"),
        F.col(f"{m}.flat.documents_searched").alias("flat_docs_searched"),
        F.col(f"{m}.comparison.speedup").alias("speedup"),
        F.col(f"{m}.comparison.latency_difference_ms").alias("latency_diff_ms"),
        F.col(f"{m}.comparison.search_space_reduction_pct").alias("search_space_reduction_pct"),
    )


def batch_summary(summary: DataFrame) -> DataFrame:
    """One row over all queries, with the verdict on the mean speedup."""
    row = summary.agg(
        F.count("*").alias("queries"),
        F.avg("cluster_aware_latency_ms").alias("cluster_mean_ms"),
        F.stddev_pop("cluster_aware_latency_ms").alias("cluster_std_ms"),
        F.avg("flat_latency_ms").alias("flat_mean_ms"),
        F.stddev_pop("flat_latency_ms").alias("flat_std_ms"),
        F.avg("speedup").alias("speedup_mean"),
        F.min("speedup").alias("speedup_min"),
        F.max("speedup").alias("speedup_max"),
        F.avg("search_space_reduction_pct").alias("reduction_mean_pct"),
    )
    return row.withColumn(
        "verdict", F.when(F.col("speedup_mean") > SIGNIFICANT_SPEEDUP, F.lit("significant")).otherwise(F.lit("modest"))
    )


def query_caption(query: str | Column, length: int = 50) -> Column:
    return F.substring(query, 1, length)


def latency_breakdown(summary: DataFrame) -> DataFrame:
    """Mean time per component and method; a missing search time is latency less embedding."""
    embedding = F.avg("embedding_time_ms")

    def search(column: str, latency: str) -> Column:
        return F.avg(column) if column in summary.columns else F.avg(latency) - embedding

    selection = F.avg("cluster_selection_ms") if "cluster_selection_ms" in summary.columns else F.lit(0.0)
    row = summary.agg(
        embedding.alias("embedding"),
        selection.alias("selection"),
        search("cluster_faiss_search_ms", "cluster_aware_latency_ms").alias("cluster_search"),
        search("flat_faiss_search_ms", "flat_latency_ms").alias("flat_search"),
    )
    return row.select(
        F.inline(
            F.array(
                F.struct(
                    F.lit("cluster_aware").alias("method"), F.col("embedding").alias("embedding"),
                    F.col("selection").alias("cluster_selection"), F.col("cluster_search").alias("search"),
                ),
                F.struct(
                    F.lit("flat").alias("method"), F.col("embedding").alias("embedding"),
                    F.lit(0.0).alias("cluster_selection"), F.col("flat_search").alias("search"),
                ),
            )
        )
    )


def mark_relevant(found: DataFrame, relevant: DataFrame, *, query_id: str = "query_id") -> DataFrame:
    """Add ``is_relevant`` from a table of relevant ``(query_id, doc_id)`` pairs."""
    marks = relevant.select(query_id, "doc_id").distinct().withColumn("is_relevant", F.lit(True))
    return found.join(marks, [query_id, "doc_id"], "left").withColumn(
        "is_relevant", F.coalesce("is_relevant", F.lit(False))
    )


def mark_same_class(found: DataFrame, query_classes: DataFrame, doc_classes: DataFrame, *, query_id: str = "query_id") -> DataFrame:
    """Add ``is_relevant`` where query and document share a class, without listing the pairs."""
    with_query = found.join(query_classes.select(query_id, F.col("class").alias("_q")), query_id)
    with_doc = with_query.join(doc_classes.select("doc_id", F.col("class").alias("_d")), "doc_id", "left")
    return with_doc.withColumn("is_relevant", F.coalesce(F.col("_q") == F.col("_d"), F.lit(False))).drop("_q", "_d")


def precision_at_k(
    marked: DataFrame, queries: DataFrame, k: int = 5, *, query_id: str = "query_id", total: str = "total_relevant"
) -> DataFrame:
    """``(query_id, k, total_relevant, relevant_retrieved, precision)`` per query.

    ``queries`` is ``(query_id, total_relevant)``; a query whose total is null has no labels and
    gets a null precision. The divisor is ``k`` even where fewer were found.
    """
    hits = marked.filter(F.col("is_relevant") & (F.col("rank") <= k)).groupBy(query_id).agg(
        F.count_distinct("doc_id").alias("hits")
    )
    labelled = F.col(total).isNotNull()
    hit = F.coalesce("hits", F.lit(0))
    return queries.select(query_id, total).join(hits, query_id, "left").select(
        query_id,
        F.lit(k).alias("k"),
        F.col(total).alias("total_relevant"),
        F.when(labelled, hit).alias("relevant_retrieved"),
        F.when(labelled, F.round(hit / F.lit(float(k)), 3)).alias("precision"),
    )


def compare_precision(aware: DataFrame, flat: DataFrame, *, query_id: str = "query_id") -> DataFrame:
    """Both precisions per query and flat minus cluster-aware; an unlabelled query counts 0."""
    a = aware.select(query_id, F.coalesce("precision", F.lit(0.0)).alias("cluster_aware_precision"))
    f = flat.select(query_id, F.coalesce("precision", F.lit(0.0)).alias("flat_precision"))
    return a.join(f, query_id).withColumn(
        "precision_difference", F.round(F.col("flat_precision") - F.col("cluster_aware_precision"), 3)
    )


def scaling_analysis(runs: DataFrame) -> DataFrame:
    """Add speedup, efficiency, time reduction and parallel overhead against the one-worker run.

    The baseline is one row, read as a scalar.
    """
    baseline = runs.filter(F.col("num_workers") == 1).agg(F.min("total_time_sec")).scalar()
    with_base = runs.withColumn("_base", baseline)
    speedup = _ratio(F.col("_base"), F.col("total_time_sec"))
    workers = F.col("num_workers").cast("double")
    return with_base.select(
        *runs.columns,
        speedup.alias("speedup"),
        (speedup / workers).alias("efficiency"),
        ((F.lit(1.0) - F.col("total_time_sec") / F.col("_base")) * 100).alias("time_reduction_pct"),
        ((workers - speedup) / workers * 100).alias("overhead_pct"),
    )


def scaling_summary(analysis: DataFrame, max_overhead_pct: float = 50.0) -> DataFrame:
    """Best run, best efficiency, reduction from one worker to the most, overhead flag."""
    best = F.struct("speedup", (-F.col("num_workers")).alias("fewer"))
    return analysis.agg(
        F.max("speedup").alias("max_speedup"),
        F.max_by("num_workers", best).alias("optimal_workers"),
        F.max("efficiency").alias("best_efficiency"),
        F.max("num_workers").alias("max_workers"),
        F.max_by("time_reduction_pct", "num_workers").alias("total_reduction_pct"),
        F.max_by("overhead_pct", "num_workers").alias("overhead_pct"),
    ).withColumn("overhead_ok", F.col("overhead_pct") < max_overhead_pct)


def timed(action) -> tuple[object, float]:
    """Result of an action and its wall-clock time in milliseconds."""
    start = time.perf_counter()
    result = action()
    return result, (time.perf_counter() - start) * 1000
