"""Batches of a fixed size, the keyed store and progress events, over streams that stop, repeat and fail."""

import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from lexigrove.streaming import batches as B, embed as ST, progress as PG, store as KS

cloudpickle.register_pickle_by_value(sys.modules[__name__])
DOC = "doc_id long, text string, version int"


def length_encoder(texts):
    assert 0 < len(texts) <= 32
    return np.array([[len(t), 1.0] for t in texts], dtype=np.float32)


# keyed store

def shown(df):
    return sorted((r["doc_id"], r["text"], r["version"]) for r in df.collect())


@pytest.fixture
def store(spark, tmp_path):
    return KS.KeyedStore(spark, str(tmp_path / "store"), DOC, order_by=["version"], buckets=8)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), DOC)


def test_later_rows_replace_earlier_ones(spark, store):
    assert store.read().collect() == [] and store.get(1).collect() == []
    store.upsert(frame(spark, (1, "a", 1), (2, "b", 1), (1, "c", 3), (1, "d", 2)), 0)
    assert shown(store.read()) == [(1, "c", 3), (2, "b", 1)]
    store.upsert(frame(spark, (1, "old", 2), (2, "new", 2), (3, None, None)), 1)
    assert shown(store.read()) == [(1, "c", 3), (2, "new", 2), (3, None, None)]
    store.upsert(frame(spark, (2, "same version", 2)), 2)  # a tie: the later batch
    assert shown(store.get(2)) == [(2, "same version", 2)] and store.get(99).collect() == []


def test_a_batch_sent_twice_changes_nothing(spark, store):
    assert store.upsert(frame(spark, (1, "a", 1)), 0) == 1
    before = store.current()
    assert store.upsert(frame(spark, (1, "other", 9), (2, "b", 1)), 0) == 0
    assert store.current() == before and shown(store.read()) == [(1, "a", 1)]


def test_only_touched_buckets_are_rewritten(spark, store):
    store.upsert(frame(spark, *((i, "x", 1) for i in range(200))), 0)
    before = store.current()["buckets"]
    assert store.upsert(frame(spark, (7, "y", 2)), 1) == 1
    after = store.current()["buckets"]
    assert len(before) == 8 and sum(before[b] != after[b] for b in before) == 1
    assert store.read().count() == 200


def test_a_batch_that_fails_half_way_leaves_the_old_rows(spark, store, monkeypatch):
    store.upsert(frame(spark, (1, "a", 1)), 0)
    monkeypatch.setattr(store, "_publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        store.upsert(frame(spark, (1, "b", 2)), 1)
    monkeypatch.undo()
    assert shown(store.read()) == [(1, "a", 1)]
    store.upsert(frame(spark, (1, "c", 3)), 1)
    assert shown(store.read()) == [(1, "c", 3)]


def test_old_versions_go(spark, store, tmp_path):
    for batch in range(5):
        store.upsert(frame(spark, (1, f"v{batch}", batch)), batch)
    assert len(list((tmp_path / "store").glob("batch=*/_bucket=*"))) == 2
    assert shown(store.read()) == [(1, "v4", 4)]


def test_empty_batch_and_null_keys(spark, store):
    store.upsert(frame(spark), 0)
    assert store.current()["batch"] == 0 and store.read().collect() == []
    store.upsert(frame(spark, (None, "x", 1), (None, "y", 2)), 1)
    assert [r["text"] for r in store.read().collect()] == ["y"]


def test_stream_into_the_store_goes_on_where_it_stopped(spark, tmp_path):
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    store = KS.KeyedStore(spark, str(tmp_path / "store"), DOC, order_by=["version"], buckets=4)
    for version in (1, 2):
        frame(spark, *((i, f"{i} at {version}", version) for i in range(20))).write.mode("append").parquet(source)
        seen = []
        rows = ST.read_document_stream(spark, source, frame(spark).schema, max_files=2).select("doc_id", "text", "version")
        KS.start_upserts(rows, store, state, on_batch=lambda number, rewritten: seen.append((number, rewritten))).awaitTermination(120)  # noqa: B023
        assert seen
    assert shown(store.read()) == sorted((i, f"{i} at 2", 2) for i in range(20))


# progress

def test_totals_over_more_batches_than_spark_keeps(spark, tmp_path):
    source, files, told, ended = tmp_path / "in", 130, [], []
    source.mkdir()
    for i in range(files):
        (source / f"{i:03}.json").write_text(f'{{"doc_id": {2 * i}}}\n{{"doc_id": {2 * i + 1}}}\n')
    listener = PG.listen(spark, on_progress=told.append, on_complete=ended.append, interval=0.5)
    try:
        rows = spark.readStream.schema("doc_id long").option("maxFilesPerTrigger", 1).json(str(source))
        query = rows.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        listener.expect(query.id, 2 * files)
        query.awaitTermination(300)
        report = listener.wait(query)
    finally:
        spark.streams.removeListener(listener)
    assert (report["batches"], report["processed"], report["waiting"], report["is_running"]) == (files, 2 * files, 0, False)
    assert len(ended) == 1 and ended[0]["processed"] == 2 * files
    assert 2 <= len(told) < files / 2  # held back
    assert [r["processed"] for r in told] == sorted(r["processed"] for r in told)
    assert any(r["waiting"] > 0 for r in told)


def test_documents_added_later_wait_and_errors_are_told():
    listener = PG.ProgressListener()
    assert listener.report("x")["waiting"] is None
    listener.add_documents("x", 5)
    listener.add_documents("x", 2)
    assert listener.report("x")["waiting"] == 7 and listener.report("x")["total"] == 7


# batches

def given_out(spark, out):
    return spark.read.schema(B.OUT).parquet(out).collect()


def test_every_document_once_in_batches_of_at_most_the_size(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    docs = spark.createDataFrame([(i, "x" * i if i % 7 else None) for i in range(150)], "doc_id long, text string")
    docs.repartition(3).write.parquet(source)
    rows = B.encode_in_batches(spark.readStream.schema(docs.schema).parquet(source), length_encoder, lanes=2, idle_ms=500)
    with B.rocksdb(spark):
        query = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "state")).trigger(
            processingTime="200 milliseconds").start()
    assert B.written(spark, str(tmp_path / "none")) == 0
    assert B.run_until(query, 150, lambda: {"given_out": B.written(spark, out)}, 120)
    found = given_out(spark, out)
    assert sorted(r["doc_id"] for r in found) == list(range(150))
    assert {r["doc_id"]: r["embedding"][0] for r in found} == {i: float(i if i % 7 else 0) for i in range(150)}
    by_batch = {}
    for r in found:
        by_batch.setdefault((r["lane"], r["batch_no"]), []).append(r)
    assert all(len(b) == b[0]["size"] <= 32 and (b[0]["reason"] == B.FULL) == (len(b) == 32) for b in by_batch.values())
    assert sum(b[0]["reason"] == B.IDLE for b in by_batch.values()) == 2  # what was left in each lane, by its timer
