import pytest
from pyspark.sql import functions as F

from lexigrove.operators import clusters as C, evaluate as V, profile as P, running as RU
from lexigrove.functions import text as X


def test_scaling_numbers(spark):
    runs = spark.createDataFrame([(1, 5.234), (2, 2.987), (4, 1.876), (8, 1.456)], "num_workers int, total_time_sec double")
    analysis = V.scaling_analysis(runs)
    assert [round(r.speedup, 2) for r in analysis.orderBy("num_workers").collect()] == [1.0, 1.75, 2.79, 3.59]
    row = V.scaling_summary(analysis).first()
    assert row.optimal_workers == 8 and row.max_speedup == pytest.approx(3.595, abs=1e-3)
    assert row.overhead_pct == pytest.approx(55.06, abs=0.01) and not row.overhead_ok


def test_precision_divides_by_k(spark):
    found = spark.createDataFrame([(0, 1, 1), (0, 2, 9)], "query_id long, rank int, doc_id long")
    relevant = spark.createDataFrame([(0, 1), (0, 2), (0, 3)], "query_id long, doc_id long")
    queries = spark.createDataFrame([(0, 3), (1, None)], "query_id long, total_relevant long")
    rows = {r.query_id: r for r in V.precision_at_k(V.mark_relevant(found, relevant), queries, 5).collect()}
    assert rows[0].precision == 0.2 and rows[0].relevant_retrieved == 1
    assert rows[1].precision is None
    both = V.compare_precision(V.precision_at_k(V.mark_relevant(found, relevant), queries, 5), V.precision_at_k(V.mark_relevant(found, relevant), queries, 2))
    assert {r.query_id: r.precision_difference for r in both.collect()} == {0: 0.3, 1: 0.0}


@pytest.mark.parametrize("run", [None, "run"])
def test_running_totals_over_one_hot_run(spark, run):
    rows = [("hot" if i % 3 else f"r{i % 5}", i // 4, i, float(i % 7)) for i in range(300)]
    frame = spark.createDataFrame(rows, "run string, t long, id long, v double").repartition(5)
    got = {r.id: (r.ordinal, r.cumulative) for r in RU.running_totals(frame, "v", ["t", "id"], run=run, partitions=7).collect()}
    seen = {}
    for key, _, i, v in sorted(rows, key=lambda r: (r[1], r[2])):
        n, total = seen.get(key if run else None, (0, 0.0))
        seen[key if run else None] = (n + 1, total + v)
        assert got[i] == seen[key if run else None]


@pytest.mark.parametrize("n,expected", [(10, [10]), (25, [10, 20, 25]), (120, [25, 50, 75, 100, 120]), (600, [100, 200, 300, 400, 500, 600])])
def test_milestones(spark, n, expected):
    frame = spark.range(n).select(F.col("id"), F.lit(1.0).alias("v"))
    rows = RU.milestones(RU.running_totals(frame, "v", ["id"])).collect()
    assert sorted(r.ordinal for r in rows) == expected


def test_experiment_summary_and_verdict(spark):
    runs = spark.createDataFrame(
        [("q", 1, 10.0, 2.0, 0.5, 1.5, 8.0, 7.0, 20, 100), ("q", 2, 20.0, 4.0, 0.5, 3.5, 10.0, 9.0, 30, 100), ("z", 1, 1.0, 0.0, 0.0, 0.0, 3.0, 3.0, 10, 100)],
        "query string, run_no int, embedding_time_ms double, cluster_latency_ms double, cluster_selection_ms double, cluster_search_ms double, "
        "flat_latency_ms double, flat_search_ms double, cluster_docs_searched long, flat_docs_searched long",
    )
    summary = V.experiment_summary(V.experiment_rows(runs, k=5, corpus_size=100))
    assert len(summary.columns) == 15
    rows = {r.query: r for r in summary.collect()}
    assert rows["q"].speedup == 3.0 and rows["q"].latency_diff_ms == 6.0
    assert rows["q"].cluster_aware_docs_searched == 20 and rows["q"].search_space_reduction_pct == pytest.approx(80.0)
    assert rows["z"].speedup == 0.0
    batch = V.batch_summary(summary).first()
    assert batch.queries == 2 and batch.verdict == "modest" and batch.speedup_max == 3.0
    breakdown = {r.method: r for r in V.latency_breakdown(summary.drop("cluster_selection_ms", "flat_faiss_search_ms")).collect()}
    assert breakdown["flat"].search == pytest.approx((9.0 + 3.0) / 2 - (15.0 + 1.0) / 2)
    assert breakdown["cluster_aware"].cluster_selection == 0.0


def test_cluster_description(spark):
    long = "word " * 20 + "alpha ending here"
    docs = spark.createDataFrame(
        [(1, 0, f"Alpha beta gamma. {long}. Alpha short.", ".txt", 5), (2, 0, "Alpha beta gamma medical!", None, None), (3, 1, "delta", ".json", 1)],
        "doc_id long, cluster_id int, raw_text string, format string, word_count int",
    ).withColumn("text", X.clean_text("raw_text"))
    rows = {r.cluster_id: r for r in P.describe_clusters(docs).collect()}
    first = rows[0]
    assert first.size == 2 and first.percentage == pytest.approx(200 / 3)
    assert first.formats == {".txt": 1, "unknown": 1}
    assert first.average_doc_length == 2.5
    assert first.label.startswith("Medical/Clinical - ") and " / " in first.label
    assert first.representative_snippets == [long]
    assert first.simple_label == first.simple_label.upper() and first.centroid_norm > 0
    assert rows[1].label == "Cluster" and [t.term for t in rows[1].top_terms] == ["delta"]
    assert rows[1].representative_snippets == []


def test_cluster_with_only_empty_documents_is_described(spark):
    docs = spark.createDataFrame([(1, 0, "alpha beta"), (2, 1, "  ")], "doc_id long, cluster_id int, text string")
    docs = docs.select("*", F.col("text").alias("raw_text"), F.lit(".txt").alias("format"), F.lit(1).alias("word_count"))
    rows = {r.cluster_id: r for r in P.describe_clusters(docs).collect()}
    assert rows[1].size == 1 and rows[1].label == "Cluster" and rows[1].top_terms == []


def test_partition_layout(spark):
    assert C.partition_layout(spark.range(0, 10, 1, 4)).agg(F.sum("documents")).first()[0] == 10
