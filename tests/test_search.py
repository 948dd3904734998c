import numpy as np
import pytest
from pyspark.sql import functions as F

from lexigrove.operators import clusters as C, nearest as N, retrieval as R
from lexigrove.functions import vectors as V
from lexigrove.sources import tables


def vectors(spark, matrix, id_name, keys=None):
    rows = [(i, [float(x) for x in v], int(keys[i]) if keys is not None else 0) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{id_name} long, embedding array<double>, cluster_id int").repartition(4)


def brute_force(queries, items, k, metric, qkeys=None, ikeys=None):
    out = set()
    for q, v in enumerate(queries):
        near = []
        for i, u in enumerate(items):
            if qkeys is not None and qkeys[q] != ikeys[i]:
                continue
            if metric == "l2":
                near.append((round(float(((v - u) ** 2).sum()), 9), i))
            else:
                norm = np.linalg.norm(v) * np.linalg.norm(u)
                if norm > 0:
                    near.append((-round(float(v @ u / norm), 9), i))
        out |= {(q, rank + 1, i, abs(s) if metric == "l2" else -s) for rank, (s, i) in enumerate(sorted(near)[:k])}
    return out


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(42)
    items = np.round(rng.normal(size=(120, 6)), 1)
    items[40:80] = items[40]  # a third of the items are copies
    queries = np.round(rng.normal(size=(25, 6)), 1)
    queries[3] = 0.0
    ikeys = np.where(np.arange(120) % 3 == 0, 0, np.arange(120) % 7)
    return queries, items, np.arange(25) % 8, ikeys


FORMS = {
    "queries broadcast": {},
    "items broadcast": {"broadcast_bytes": 0},
    "blocks": {"broadcast_bytes": 400},
}


@pytest.mark.parametrize("metric", ["l2", "cosine"])
@pytest.mark.parametrize("form", list(FORMS))
@pytest.mark.parametrize("keyed", [False, True])
def test_every_form_matches_brute_force(spark, data, metric, form, keyed):
    queries, items, qkeys, ikeys = data
    q = vectors(spark, queries, "query_id", qkeys)
    d = vectors(spark, items, "doc_id", ikeys)
    if form == "items broadcast":
        asked, stored = N._prepared(q, "query_id", "embedding", "cluster_id" if keyed else None), N._prepared(d, "doc_id", "embedding", "cluster_id" if keyed else None)
        rows = N._ranked(N._by_broadcast_items(asked, stored, 4, metric), 4, metric, "query_id", "doc_id")
    else:
        rows = N.nearest(q, d, 4, metric=metric, key="cluster_id" if keyed else None, **FORMS[form])
    found = {(r.query_id, r.rank, r.doc_id, round(r.score, 9)) for r in rows.collect()}
    assert found == brute_force(queries, items, 4, metric, qkeys if keyed else None, ikeys if keyed else None)


def test_k_above_cluster_size_unknown_cluster_and_null_vector(spark):
    store = spark.createDataFrame([(1, [1.0], 0), (2, [2.0], 0), (3, None, 0)], "doc_id long, embedding array<double>, cluster_id int")
    query = spark.createDataFrame([(9, [0.0])], "query_id long, embedding array<double>")
    assert R.search_cluster(query, store, 0, k=10).count() == 2
    assert R.search_cluster(query, store, 5, k=10).count() == 0
    with pytest.raises(ValueError):
        N.nearest(query, store, 0)


def test_opposite_clusters(spark):
    rows = [(i, [v] * 384, c) for i, (v, c) in enumerate([(1.0, 0), (1.1, 0), (-1.0, 1), (-0.9, 1)])]
    store = spark.createDataFrame(rows, "doc_id long, embedding array<double>, cluster_id int")
    query = spark.createDataFrame([(0, [1.0] * 384)], "query_id long, embedding array<double>")
    assert {r.doc_id for r in R.search_cluster(query, store, 0, k=2).collect()} == {0, 1}
    assert R.search_cluster(query, store, 0, k=1).first().distance == 0.0


def test_planted_clusters(spark):
    rng = np.random.default_rng(42)
    centers = rng.normal(size=(5, 384))
    matrix = np.array([centers[i % 5] + rng.normal(size=384) * 0.1 for i in range(100)])
    store = vectors(spark, matrix, "doc_id", np.arange(100) % 5)
    query = vectors(spark, [centers[0] + rng.normal(size=384) * 0.05], "query_id").select("query_id", "embedding")
    means = R.centroids(store)
    chosen = R.select_cluster(query, means)
    assert chosen.first().cluster_id == 0
    found = R.cluster_aware_search(query, store, means, 5).collect()
    assert len(found) == 5 and all(r.doc_id % 5 == 0 for r in found)
    assert R.flat_search(query, store, 5).count() == 5
    searched = R.documents_searched(chosen, store).first()
    assert (searched.docs_searched, searched.flat_docs_searched) == (20, 100)
    assert searched.reduction_pct == pytest.approx(80.0)
    features = store.select("doc_id", V.to_ml("embedding").alias("features"))
    model, assigned, metrics = C.clustering_run(features, 5)
    groups = assigned.groupBy((F.col("doc_id") % 5).alias("planted")).agg(F.count_distinct("cluster_id").alias("n")).collect()
    assert all(r.n == 1 for r in groups)
    assert C.cluster_stats(assigned).agg(F.sum("size")).first()[0] == 100
    assert metrics.first().num_documents == 100
    nearest = C.assign_to_centers(store, C.centers(spark, model)).select("doc_id", F.col("cluster_id").alias("c"))
    assert assigned.join(nearest, "doc_id").filter("cluster_id <> c").count() == 0
    assert C.silhouette(assigned) > 0.9


def test_zero_vectors_have_no_similarity(spark):
    centers = spark.createDataFrame([(0, [0.0, 0.0]), (1, [1.0, 0.0])], "cluster_id int, centroid array<double>")
    queries = spark.createDataFrame([(1, [1.0, 1.0]), (2, [0.0, 0.0])], "query_id long, embedding array<double>")
    assert [(r.query_id, r.cluster_id) for r in R.select_cluster(queries, centers).collect()] == [(1, 1)]
    row = spark.createDataFrame([([0.0], [1.0])], "a array<double>, b array<double>").select(V.cosine("a", "b"), V.squared_l2("a", "b"), V.normalize("a")[0]).first()
    assert tuple(row) == (None, 1.0, None)


def test_store_round_trip_upsert_and_stats(spark, tmp_path):
    old = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0])], "doc_id long, embedding array<double>")
    assigned = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, cluster_id int")
    store = R.assign_clusters(old, assigned)
    tables.write_store(store, str(tmp_path / "store"))
    read = tables.read_store(spark, str(tmp_path / "store"))
    assert {r.doc_id: r.cluster_id for r in read.collect()} == {1: 0, 2: 1, 3: -1}
    again = R.add_embeddings(read, read.filter("doc_id = 1").withColumn("embedding", F.array(F.lit(9.0), F.lit(9.0))))
    assert R.store_stats(again).first().asDict() == {"total_documents": 3, "num_clusters": 3, "dimension": 2}
    with pytest.raises(Exception):
        tables.read_store(spark, str(tmp_path / "absent"))


def test_store_scan_is_pruned_to_the_chosen_clusters(spark, tmp_path):
    store = spark.createDataFrame([(i, [float(i % 4), 1.0], i % 4) for i in range(40)], "doc_id long, embedding array<double>, cluster_id int")
    tables.write_store(store, str(tmp_path / "store"))
    read = tables.read_store(spark, str(tmp_path / "store"))
    query = spark.createDataFrame([(0, [3.0, 1.0], 3)], "query_id long, embedding array<double>, cluster_id int")
    found = N.nearest(query, read, 3, key="cluster_id")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cluster_id" in plan or "PartitionFilters: [(cast(cluster_id" in plan or "PartitionFilters: [cast(cluster_id" in plan
    assert [r.doc_id for r in found.orderBy("rank").collect()] == [3, 7, 11]
