"""Pruned search: the flat search's rows, fewer vectors read, and what decides ties."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexigrove.operators import nearest as N, pruned as PR, retrieval as R


def clouds(spark, seed, clusters=8, each=60, width=5, spread=0.05):
    """Tight clusters far apart, one of them with a third of all vectors, with copies and a cluster of one."""
    draw = np.random.default_rng(seed)
    rows, doc_id = [], 0
    for cluster in range(clusters):
        centre = draw.normal(size=width) * 10
        for _ in range(each * (4 if cluster == 0 else 1)):
            rows.append((doc_id, [float(x) for x in centre + draw.normal(size=width) * spread], cluster))
            doc_id += 1
    rows += [(doc_id + k, rows[3][1], 0) for k in range(20)]
    rows += [(doc_id + 20, [0.0] * width, -1), (doc_id + 21, None, 2)]
    return spark.createDataFrame(rows, "doc_id long, embedding array<double>, cluster_id int").repartition(4)


def asked_of(store):
    return store.select(F.col("doc_id").alias("query_id"), "embedding")


def found(df):
    return sorted((r["query_id"], r["rank"], r["doc_id"], round(r["distance"], 9)) for r in df.collect())


@pytest.mark.parametrize("block_bytes,k,first", [(1 << 24, 5, 1), (800, 5, 1), (3000, 90, 2), (800, 1, 8)])
def test_pruned_search_is_the_flat_search(spark, block_bytes, k, first):
    store = clouds(spark, 7)
    index = PR.build_index(store, block_bytes=block_bytes)
    assert found(PR.search(asked_of(store), index, k, first=first)) == found(R.flat_search(asked_of(store), store, k))


def test_queries_in_several_groups(spark, monkeypatch):
    monkeypatch.setattr(PR, "GROUP_QUERIES", 50)
    store = clouds(spark, 8)
    assert found(PR.search(asked_of(store), PR.build_index(store, block_bytes=2000), 3)) == found(R.flat_search(asked_of(store), store, 3))


def test_far_clusters_are_not_read(spark):
    store = clouds(spark, 9)
    sizes = {r["cluster_id"]: r["count"] for r in store.filter("embedding IS NOT NULL").groupBy("cluster_id").count().collect()}
    rows = PR.search(asked_of(store.filter("cluster_id > 0")), PR.build_index(store), 5).select("query_id", "vectors_read").distinct().collect()
    assert max(r["vectors_read"] for r in rows) <= max(n for c, n in sizes.items() if c > 0)
    # in one cluster the window leaves most vectors out
    draw = np.random.default_rng(1)
    ring = [(i, [float(i), float(x)], 0) for i, x in enumerate(draw.normal(size=400))]
    line = spark.createDataFrame(ring, "doc_id long, embedding array<double>, cluster_id int")
    read = PR.search(asked_of(line).filter("query_id = 399"), PR.build_index(line), 2).first()["vectors_read"]
    assert read == 400  # the first cluster is read whole, as nothing is known before


def test_blocks_hold_short_ranges_and_split_hot_clusters(spark):
    store = clouds(spark, 10)
    index = PR.build_index(store, block_bytes=2000)
    blocks = index.blocks.collect()
    assert sum(b["size"] for b in blocks) == store.filter("embedding IS NOT NULL").count()
    assert max(b["size"] for b in blocks) < 200 and sum(b["cluster_id"] == 0 for b in blocks) > 3


def test_index_written_and_read_again(spark, tmp_path):
    store = clouds(spark, 11)
    PR.write_index(PR.build_index(store, block_bytes=2000), str(tmp_path))
    again = PR.read_index(spark, str(tmp_path))
    assert found(PR.search(asked_of(store), again, 4)) == found(R.flat_search(asked_of(store), store, 4))
    # a radius range reaches the scan
    plan = again.items.filter("cluster_id = 0 AND radius < 0.01")._jdf.queryExecution().toString()
    assert "LessThan(radius,0.01)" in plan and "PartitionFilters: [isnotnull(cluster_id" in plan


def test_no_items_no_queries_and_bad_arguments(spark):
    store = clouds(spark, 12)
    index = PR.build_index(store)
    assert PR.search(asked_of(store).limit(0), index, 3).collect() == []
    assert PR.search(asked_of(store), PR.build_index(store.limit(0)), 3).collect() == []
    with pytest.raises(ValueError):
        PR.search(asked_of(store), index, 0)


def test_distance_is_returned_as_it_is(spark, sf_dir):
    vectors = {r["vec_id"]: np.array(r["embedding"], float) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()}
    exact = float(((vectors[136] - vectors[147]) ** 2).sum())
    one = spark.createDataFrame([(136, vectors[136].tolist())], "query_id long, embedding array<double>")
    other = spark.createDataFrame([(147, vectors[147].tolist())], "doc_id long, embedding array<double>")
    assert N.nearest(one, other, 1).first()["score"] == pytest.approx(exact, rel=1e-15)


def test_ties_by_id_whatever_the_block(spark):
    rows = [(i, [float(i % 3), 1.0], 0) for i in range(30)]
    store = spark.createDataFrame(rows, "doc_id long, embedding array<double>, cluster_id int")
    for bound in (1 << 20, 200):
        got = N.nearest(asked_of(store), store, 4, broadcast_bytes=bound).filter("query_id = 29").orderBy("rank")
        assert [r["doc_id"] for r in got.collect()] == [2, 5, 8, 11]


def test_keyed_blocks_cut_a_hot_key(spark):
    draw = np.random.default_rng(3)
    rows = [(i, [float(x) for x in draw.normal(size=4)], 0 if i < 150 else i % 5) for i in range(200)]
    store = spark.createDataFrame(rows, "doc_id long, embedding array<double>, cluster_id int")
    queries = store.withColumnRenamed("doc_id", "query_id")
    whole = N.nearest(queries, store, 3, key="cluster_id")
    cut = N.nearest(queries, store, 3, key="cluster_id", broadcast_bytes=1500)
    shown = lambda df: sorted((r["query_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect())
    assert shown(cut) == shown(whole)
