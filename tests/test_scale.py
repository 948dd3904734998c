"""What a step takes must not grow with more than its share of the input: distances, terms, file and stream steps."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexigrove.operators import nearest as N, tfidf as T
from lexigrove.operators.encoder import embed
from lexigrove.plans.runtime import spread


def exact(queries, items, ids, k):
    out = []
    for q in queries:
        score = N._significant(((q - items) ** 2).sum(1))
        out.append([int(ids[i]) for i in np.lexsort((ids, score))[:k]])
    return out


@pytest.mark.parametrize("scale, offset", [(1.0, 0.0), (1e-6, 0.0), (1e-30, 0.0), (1e30, 0.0), (1e-2, 1e6), (1e-9, 1.0)])
@pytest.mark.parametrize("digits", [None, 1])
def test_tiles_find_what_all_pairs_give(scale, offset, digits, monkeypatch):
    monkeypatch.setattr(N, "TILE", 64)
    draw = np.random.default_rng(3)
    plain = draw.normal(size=(500, 5))
    items = (plain if digits is None else np.round(plain, digits)) * scale + offset
    queries, ids = items[:150], draw.permutation(500)
    best, asked = N._Best(150, 4), N._Asked(N._Block(np.arange(150), np.zeros(150, np.int64), queries))
    for start in range(0, 500, 170):
        part = slice(start, start + 170)
        N._search(best, asked, N._Block(ids[part], np.zeros(len(ids[part]), np.int64), items[part]), "l2")
    assert best.ids.tolist() == exact(queries, items, ids, 4)


def test_vectors_that_are_not_finite_are_no_neighbours():
    items = np.random.default_rng(4).normal(size=(40, 3))
    items[3], items[5] = np.nan, np.inf
    items[7] *= 1e25
    best, block = N._Best(40, 2), N._Block(np.arange(40), np.zeros(40, np.int64), items)
    N._search(best, N._Asked(block), block, "l2")
    sound = [i for i in range(40) if i not in (3, 5)]
    assert [best.ids[i].tolist() for i in sound] == exact(items[sound], items[sound], np.array(sound), 2)
    assert (best.ids[[3, 5]] == -1).all()


def test_few_pairs_are_computed_twice(monkeypatch):
    """Once the best are known, the product in single precision leaves few pairs to be computed exactly, and no tile is larger than stated."""
    draw = np.random.default_rng(6)
    items = draw.normal(size=(20_000, 64))
    items /= np.linalg.norm(items, axis=1)[:, None]
    seen, largest = [], []
    add, tile = N._Best.add_pairs, N._Tiles._tile
    monkeypatch.setattr(N._Best, "add_pairs", lambda self, rows, *rest: (seen.append(len(rows)), add(self, rows, *rest))[1])
    monkeypatch.setattr(N._Tiles, "_tile", lambda self, rows, low, high, *rest: (largest.append((rows.stop - rows.start) * (high - low)), tile(self, rows, low, high, *rest))[1])
    asked = N._Asked(N._Block(np.arange(2000), np.zeros(2000, np.int64), items[:2000]))
    best = N._Best(2000, 5)
    N._search(best, asked, N._Block(np.arange(20_000), np.zeros(20_000, np.int64), items), "l2")
    assert sum(seen) < 2000 * 60 and max(largest) <= N.TILE**2
    assert best.ids[:5].tolist() == exact(items[:5], items, np.arange(20_000), 5)


def test_terms_are_counted_inside_their_document(spark):
    """No table of the terms of all documents of a task: the lists are grouped by document, and each row counts its own."""
    rows = [(1, ["b", "a", "b"]), (1, ["a", "c"]), (2, []), (3, None), (None, ["x", None, "x"]), (None, ["x"]), (4, ["q"]), (5, [None])]
    tokens = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    plain, marked = T.term_frequency(T.place_tokens(tokens)), T.marked_term_frequency(T.place_tokens(tokens))
    for found in (plain, marked):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"Aggregate\(keys=\[[^\]]*term", plan) and plan.count("Exchange hashpartitioning") == plan.count("== Initial Plan ==") + 1
    counts = {(1, "a", 2), (1, "b", 2), (1, "c", 1), (None, "x", 3), (4, "q", 1)}
    assert sorted(map(tuple, plain.collect()), key=str) == sorted(counts, key=str)
    marks = {(1, "", 0), (None, "", 0), (4, "", 0), (5, "", 0)}
    assert sorted(map(tuple, marked.collect()), key=str) == sorted(counts | marks, key=str)


def test_an_encoder_gets_texts_only(spark):
    docs = spark.range(70).select(
        "id", F.struct(F.lit("p").alias("path"), F.col("id").alias("place")).alias("written"), F.timestamp_seconds("id").alias("ts"),
        F.when(F.col("id") != 3, F.repeat(F.lit("x"), F.col("id").cast("int"))).alias("text")).coalesce(1)
    sizes = lambda texts: np.array([[len(t), len(texts)] for t in texts])
    found = embed(docs, sizes)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "MapInPandas" not in plan
    want = [(r.id, r.written, r.ts, [0.0 if r.id == 3 else float(r.id), 32.0 if r.id < 64 else 6.0]) for r in docs.collect()]
    assert [tuple(r) for r in found.collect()] == want
    assert embed(docs.filter("id < 0"), sizes).count() == 0


def test_a_task_gets_so_many_bytes(spark, tmp_path):
    spark.range(400).select(F.repeat(F.lit("t"), 1000).alias("text")).coalesce(1).write.parquet(str(tmp_path / "t"))
    texts = spark.read.parquet(str(tmp_path / "t"))
    dealt = spread(texts, 20_000)
    assert dealt.rdd.getNumPartitions() == 21 and dealt.count() == 400  # 1,032 bytes a row
    assert spread(texts.filter("text = ''"), 20_000).count() == 0
