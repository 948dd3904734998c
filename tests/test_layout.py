"""Bucketed joins, a model loaded once a worker, and the layout of K-means."""

import os

import numpy as np
import pytest
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from lexigrove.operators import clusters as C, encoder as E
from lexigrove.sources.bucketed import Buckets


@pytest.fixture
def held(spark, tmp_path):
    buckets = Buckets(spark, str(tmp_path / "held"), number=4)
    yield buckets
    buckets.forget()


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_bucketed_join_has_no_exchange(spark, held):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    held.write("documents", docs)
    held.write("vectors", docs.filter("doc_id % 2 = 0").select("doc_id", F.array(F.lit(1.0)).alias("embedding")))
    held.write("assignments", docs.filter("doc_id % 3 = 0").select("doc_id", (F.col("doc_id") % 5).alias("cluster_id")))
    joined = held.join("documents", "vectors", "assignments")
    assert joined.count() == 200 and joined.filter("embedding IS NOT NULL").count() == 100
    assert joined.filter("cluster_id IS NOT NULL").count() == 67
    assert "SortMergeJoin" in plan_of(joined) and "Exchange" not in plan_of(joined)
    assert held.join("documents", "vectors", "assignments", how="inner").count() == 34


def test_bucketed_odd_rows(spark, held):
    held.write("documents", spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, None)], "doc_id long, text string"))
    held.write("vectors", spark.createDataFrame([(1, 0.5), (None, 0.7)], "doc_id long, value double"))
    held.write("nothing", spark.createDataFrame([], "doc_id long, extra string"))
    rows = {(r.doc_id, r.text, r.value, r.extra) for r in held.join("documents", "vectors", "nothing").collect()}
    assert rows == {(1, "a", 0.5, None), (1, "b", 0.5, None), (None, "c", None, None), (2, None, None, None)}
    assert held.join("nothing", "vectors").count() == 0


def test_bucketed_table_is_replaced(spark, held):
    held.write("documents", spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    held.write("documents", spark.createDataFrame([(2, "b"), (3, "c")], "doc_id long, text string"))
    assert sorted(r.doc_id for r in held.read("documents").collect()) == [2, 3]


def test_model_is_loaded_once_a_worker(spark, tmp_path):
    folder = str(tmp_path)

    def load():
        with open(os.path.join(folder, "loads"), "a") as file:
            file.write(f"{os.getpid()}\n")
        return lambda texts: np.array([[len(t), len(texts)] for t in texts], np.float32)

    texts = spark.range(640).repartition(20).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") != 7, F.repeat(F.lit("x"), F.col("id").cast("int") % 9)).alias("text"), F.lit("k").alias("kept"))
    found = {r.doc_id: r for r in E.embed_with_model(texts, load, batch_size=8).collect()}
    assert len(found) == 640 and found[7].embedding[0] == 0 and found[8].embedding[0] == 8 and found[8].kept == "k"
    assert max(r.embedding[1] for r in found.values()) <= 8
    with open(os.path.join(folder, "loads")) as file:
        loads = file.read().split()
    assert len(loads) == len(set(loads)) < 20


def test_model_over_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    found = E.embed_with_model(empty, lambda: None)
    assert found.columns == ["doc_id", "embedding"] and found.count() == 0


def test_layout_follows_rows():
    assert [C.layout_of(n) for n in (0, 2, 16 << 17, (16 << 17) + 1, 10**10)] == [16, 16, 16, 32, 131072]


def test_wrong_assignment_is_seen(spark):
    draw = np.random.default_rng(4)
    rows = [(i, SparseVector(8, sorted({i % 2 * 4 + 1, i % 2 * 4 + 2}), draw.uniform(5, 6, 2))) for i in range(40)] + [(40, SparseVector(8, [], []))]
    features = spark.createDataFrame(rows, ["doc_id", "features"])
    model = C.fit_kmeans(features, 2)
    assigned = C.assign(model, features)
    count = lambda frame: spark.range(1).select(C.not_nearest(spark, model, frame)).first()[0]
    assert count(assigned) == 0
    wrong = assigned.withColumn("cluster_id", F.when(F.col("doc_id") < 3, 1 - F.col("cluster_id")).otherwise(F.col("cluster_id")))
    assert count(wrong) == 3
