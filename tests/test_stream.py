import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import functions as F

from lexigrove.operators import encoder as E
from lexigrove.plans import stages
from lexigrove.sources import tables
from lexigrove.operators import evaluate as V
from lexigrove.streaming import embed as ST

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def length_encoder(texts):
    return np.array([[len(t), 1.0] for t in texts], dtype=np.float32)


def test_stream_picks_up_new_files_and_last_write_wins(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    docs = spark.createDataFrame([(1, "one"), (2, "three")], "doc_id long, text string")
    docs.write.parquet(source)
    stream = ST.read_document_stream(spark, source, docs.schema, max_files=1)
    query = ST.start_embedding(stream, length_encoder, out, state)
    assert ST.wait_for_completion(query, 120)
    report = ST.progress(spark, query, out)
    assert report["processed"] == 2 and not report["is_running"]
    spark.createDataFrame([(1, "changed")], docs.schema).write.mode("append").parquet(source)
    ST.wait_for_completion(ST.start_embedding(ST.read_document_stream(spark, source, docs.schema), length_encoder, out, state))
    got = {r.doc_id: (r.embedding[0], r.cluster_id) for r in ST.embeddings(spark, out).collect()}
    assert got == {1: (7.0, -1), 2: (5.0, -1)}
    assert ST.embedding_of(spark, out, 2).first().embedding[0] == 5.0
    assert ST.embedding_of(spark, out, 99).count() == 0


def test_encoder_properties(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    encoder = E.fit_encoder(docs)
    first = docs.filter(F.length("text") > 200).limit(1).first()["text"]
    texts = spark.createDataFrame([(1, first), (2, first), (3, "")], "query_id long, text string")
    rows = {r.query_id: np.array(r.embedding) for r in E.embed(texts, encoder).collect()}
    assert all(len(v) == 384 for v in rows.values())
    assert rows[1] @ rows[2] > 0.99
    assert not rows[3].any()


def test_function_encoder_matches_per_row(spark):
    texts = spark.createDataFrame([(i, "x" * i, i % 2) for i in range(100)], "doc_id long, text string, cluster_id int")
    rows = E.embed(texts, length_encoder, batch_size=7).collect()
    assert {r.doc_id: r.embedding[0] for r in rows} == {i: float(i) for i in range(100)}
    assert all(r.cluster_id == r.doc_id % 2 for r in rows)


def test_stages_end_to_end(spark, tmp_path):
    source = tmp_path / "raw"
    source.mkdir()
    topics = {"data": "python spark cluster analysis pipeline", "food": "chef kitchen menu cuisine recipe"}
    for i in range(12):
        topic = list(topics)[i % 2]
        (source / f"doc_{i}.txt").write_text(f"Document about {topic}: {topics[topic]} number{i}. " * 3)
    out = str(tmp_path / "out")
    assert stages.ingest(spark, str(source), out).first().successful == 12
    docs = tables.read_table(spark, f"{out}/documents")
    features = stages.build_features(spark, docs, out)
    assignments, clusters = stages.build_clusters(spark, docs, features, out, n_clusters=2)
    assert clusters.agg(F.sum("size")).first()[0] == 12
    assert tables.read_table(spark, f"{out}/clustering_metrics").first().silhouette_score > 0.3
    store, centers, encoder = stages.build_store(spark, docs, assignments, out)
    queries = spark.createDataFrame([(0, "chef with a kitchen menu"), (1, "spark analysis pipeline")], "query_id long, text string")
    experiments = stages.run_experiments(spark, queries, store, centers, encoder, k=3, num_runs=2)
    tables.write_json(experiments, f"{out}/experiments")
    summary = V.experiment_summary(experiments)
    tables.write_csv(summary, f"{out}/summary")
    rows = summary.collect()
    assert len(rows) == 2 and all(r.num_runs == 2 and r.flat_docs_searched == 12 and r.cluster_aware_docs_searched == 6 for r in rows)
    assert V.batch_summary(summary).first().queries == 2
    assert spark.read.option("header", True).csv(f"{out}/summary").count() == 2
