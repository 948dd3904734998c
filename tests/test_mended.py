"""Inputs that the given tables do not hold: readers, distances off the unit sphere, streams, layouts."""

import io
import os
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexigrove.functions import text as X, vectors as V
from lexigrove.operators import clusters as C, tfidf as T
from lexigrove.operators.nearest import nearest
from lexigrove.plans import runtime
from lexigrove.sources import files, tables
from lexigrove.streaming import embed as ST


def test_jsonl_keeps_rows_whose_optional_fields_have_another_type(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text(
        '{"doc_id":"a","text":"one","word_count":2.5}\n{"doc_id":"b","text":"two","word_count":"3"}\n{bad\n'
        '{"doc_id":"c","text":" "}\n{"doc_id":7,"text":"t","word_count":4,"processing_time":1}\n')
    rows = {r.doc_id: (r.text, r.word_count, r.processing_time) for r in tables.read_corpus_jsonl(spark, str(tmp_path)).collect()}
    assert rows == {"a": ("one", None, None), "b": ("two", 3, None), "7": ("t", 4, 1.0)}


def test_rejected_lines_are_counted_in_the_same_pass(spark, tmp_path):
    lines = ['{"doc_id":"a","text":"one","word_count":2.5}', "{bad", '{"doc_id":"c","text":" "}', '{"doc_id":"d"}', "[1", '{"doc_id":7,"text":"t"}', ""]
    (tmp_path / "x.jsonl").write_text("\n".join(lines) + "\n")
    kept, seen = tables.read_corpus_with_rejects(spark, str(tmp_path))
    assert kept._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert sorted(r.doc_id for r in kept.collect()) == ["7", "a"]
    assert seen.get == {"kept": 2, "blank": 2, "bad": 2}
    # the rows are those of the reader that only drops
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, tables.read_corpus_jsonl(spark, str(tmp_path)).collect()))


def test_byte_order_marks(spark):
    texts = ["héllo".encode("utf-16"), b"\xef\xbb\xbfhi\xc3\xa9", b"\xfe\xff" + "hé".encode("utf-16-be"), "hé".encode("latin-1"),
             "hé".encode("utf-32"), b"", b"\xff\xfe"]
    df = spark.createDataFrame([(i, bytearray(t)) for i, t in enumerate(texts)], "i int, c binary")
    got = [r.t for r in df.select("i", X.decode_bytes("c").alias("t")).orderBy("i").collect()]
    assert got == ["héllo", "hié", "hé", "hé", "hé", "", ""]


def test_docx_tab_stops_are_no_text():
    word = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    body = ('<w:p><w:pPr><w:tabs><w:tab w:val="left"/><w:tab w:val="left"/></w:tabs></w:pPr><w:r><w:t>one</w:t><w:tab/></w:r>'
            '<w:hyperlink><w:r><w:t>two</w:t></w:r></w:hyperlink><w:r><w:noBreakHyphen/><w:t>three</w:t></w:r></w:p>')
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w") as archive:
        archive.writestr("word/document.xml", f"<w:document {word}><w:body>{body}</w:body></w:document>")
    assert files.docx_text(content.getvalue()) == "one\ttwo-three"


@pytest.mark.parametrize("scale, gap", [(1e-6, 1e-6), (1.0, 1.0), (1e6, 1e-2)])
@pytest.mark.parametrize("bounds", [{}, {"broadcast_bytes": 4000}, {"broadcast_bytes": 1000}])
def test_nearest_is_exact_at_any_length(spark, scale, gap, bounds):
    draw = np.random.default_rng(5)
    centre = draw.normal(size=6) * scale
    items = centre + draw.normal(size=(60, 6)) * gap
    queries = items[:20] + draw.normal(size=(20, 6)) * gap * 0.01
    spread = lambda m, name: spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], f"{name} long, embedding array<double>")
    found = nearest(spread(queries, "query_id"), spread(items, "doc_id"), 3, **bounds).collect()
    got = {(r.query_id, r["rank"]): r.doc_id for r in found}
    exact = ((queries[:, None, :] - items[None, :, :]) ** 2).sum(2)
    for q, row in enumerate(exact):
        assert [got[q, k + 1] for k in range(3)] == list(np.argsort(row, kind="stable")[:3])


def test_newer_of_two_files_in_one_batch_wins(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "doc_id long, text string"
    lengths = lambda texts: np.array([[len(t)] for t in texts], dtype=np.float32)
    for name, text, when in (("newer", "newest text", 2_000_000_000), ("older", "old", 1_000_000_000)):
        spark.createDataFrame([(1, text)], schema).coalesce(1).write.parquet(f"{source}/{name}")
        for folder, _, names in os.walk(f"{source}/{name}"):
            for n in names:
                os.utime(f"{folder}/{n}", (when, when))
    seen, ends = [], []
    query = ST.start_embedding(ST.read_document_stream(spark, f"{source}/*", spark.createDataFrame([], schema).schema), lengths, out, state)
    assert ST.wait_for_completion(query, 120, on_progress=seen.append, on_complete=ends.append)
    assert ST.embeddings(spark, out).first().embedding[0] == 11.0
    assert ST.embedding_of(spark, out, 1).first().embedding[0] == 11.0
    assert seen and len(ends) == 1
    report = ST.progress(spark, query, out)
    assert report["processed"] == 2 and report["batches"] == 1 and not report["is_running"]


def test_kmeans_does_not_depend_on_the_layout(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("doc_id"), V.to_ml("embedding").alias("features"))
    fits = [C.fit_kmeans(vectors.repartition(n), 5, max_iter=5) for n in (1, 7)]
    a, b = (np.array(sorted(c.tolist() for c in m.clusterCenters())) for m in fits)
    assert np.allclose(a, b)


def test_sparse_and_dense_vectors_give_the_same_rows(spark):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(1, Vectors.sparse(9, [2, 5], [1.0, 3.0])), (2, Vectors.dense([0.0, 4.0])), (3, Vectors.sparse(4, [], []))], ["doc_id", "features"])
    assert sorted(tuple(r) for r in T.feature_rows(df).collect()) == [(1, 2, 1.0), (1, 5, 3.0), (2, 1, 4.0)]


def test_hot_term_join_can_be_split(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        tokens = spark.range(50).select(F.col("id").alias("doc_id"), F.array(F.lit("all"), F.concat(F.lit("t"), F.col("id"))).alias("tokens"))
        rows = T.tfidf(tokens)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        join = plan[plan.index("SortMergeJoin"):]
        assert join.count("Sort [term") >= 2 and join.count("hashpartitioning(term") >= 2
        assert rows.filter("term = 'all'").count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_scope_deletes_what_was_stored(spark):
    with runtime.scratch_scope(spark):
        path = runtime.materialize(spark.range(3)).inputFiles()[0]
        assert os.path.exists(path.removeprefix("file://"))
    assert not os.path.exists(path.removeprefix("file://"))


def test_clusters_with_member_lists(spark, tmp_path):
    clusters = spark.createDataFrame([(0, "a", 3), (1, "b", 1), (2, "c", 0)], "cluster_id int, label string, size long")
    members = spark.createDataFrame([(1, 0), (2, 0), (3, 0), (9, 1)], "doc_id long, cluster_id int")
    tables.write_clusters_json(clusters, members, str(tmp_path / "c"))
    got = {r.cluster_id: r.document_indices for r in spark.read.json(str(tmp_path / "c")).collect()}
    assert got == {0: [1, 2, 3], 1: [9], 2: None}
