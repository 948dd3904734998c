"""What near-dedup moves and leaves on disk."""

import random
import time

import numpy as np

from lexigrove.llm import shingles, simhash
from lexigrove.plans import runtime


def texts(n, seed, words=300):
    draw = random.Random(seed)
    return [" ".join("".join(draw.choice("abcdefgh") for _ in range(6)) for _ in range(words)) for _ in range(n)]


def shuffled_bytes(df):
    """Bytes that the exchanges of a collected plan have moved."""

    def of(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return of(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return of(node.plan())
        own = node.metrics().get("dataSize").get().value() if name == "ShuffleExchangeExec" else 0
        children = node.children()
        return own + sum(of(children.apply(i)) for i in range(children.size()))

    return of(df._jdf.queryExecution().executedPlan())


def test_rows_that_surely_stay_are_not_moved(spark, monkeypatch):
    unlike = texts(300, 1)
    rows = [(i, t, "en") for i, t in enumerate(unlike)]
    rows += [(1000, unlike[0], "en"), (1, unlike[1], "en"), (1, unlike[1], "fr"), (None, unlike[2], "en"), (None, None, None), (None, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = simhash.keep_one(docs)
        got = kept.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    ids = sorted((r["doc_id"] for r in got), key=lambda x: (x is None, x))
    assert ids == [*range(300), None] and kept.columns == docs.columns
    assert shuffled_bytes(kept) < 0.2 * sum(len(t) for t in unlike)
    monkeypatch.setattr("lexigrove.llm.wordstream.Sieve.passes", lambda self, hashes: np.ones(len(hashes), bool))
    assert {tuple(r) for r in simhash.keep_one(docs).collect()} == {tuple(r) for r in got}


def test_verified_pairs_are_those_of_whole_sets(spark, monkeypatch):
    draw, base = random.Random(2), texts(1, 3)[0].split()
    bodies = [" ".join(base)]
    for _ in range(40):
        words = list(base)
        for at in draw.sample(range(len(words)), draw.randrange(1, 9)):
            words[at] = f"x{draw.random()}"
        bodies.append(" ".join(words))
    sets = [shingles.shingle_set(shingles.word_hashes(simhash.words_of(b))) for b in bodies]
    nodes = [shingles.node_of(s) for s in sets]
    docs = spark.createDataFrame([(b,) for b in [*bodies, *bodies[:5], None, ""]], "text string")
    hashes = {r["text"]: r["h"] for r in docs.selectExpr("text", "xxhash64(coalesce(text, '')) as h").collect()}
    table = spark.createDataFrame([(n, hashes[b]) for n, b in zip(nodes, bodies, strict=True)], "node long, text_hash long")
    chosen = [(0, j) for j in range(1, 41)] + [(i, i + 1) for i in range(1, 40)] + [(5, 30), (6, 31)]
    pairs = [tuple(sorted((nodes[i], nodes[j]))) for i, j in chosen]
    stored = []
    monkeypatch.setattr(shingles, "materialize", lambda df, **k: stored.append(df.columns) or runtime.materialize(df, **k))
    monkeypatch.setattr(shingles, "LEAVES", 3, raising=False)
    found = shingles._verified(spark.createDataFrame(pairs, "a long, b long"), docs, table, "text", simhash.words_of)
    alike = {p for (i, j), p in zip(chosen, pairs, strict=True) if 9 * len(np.intersect1d(sets[i], sets[j])) >= 4 * (len(sets[i]) + len(sets[j]))}
    got = [tuple(r) for r in found.collect()]
    assert sorted(got) == sorted(alike) and 0 < len(alike) < len(pairs)
    assert all("set" not in columns for columns in stored)  # no whole set is stored
    assert shingles._verified(spark.createDataFrame([], "a long, b long"), docs, table, "text", simhash.words_of).count() == 0


def test_shuffle_files_go_with_their_job(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = manager.getAllFiles()
        return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffles(), spark.conf.get(key, None)
    with runtime.scratch_scope(spark), runtime.shuffles_deleted(spark):
        table = runtime.materialize(spark.range(10_000).repartition(5, "id"))
        until = time.time() + 20
        while shuffles() - before and time.time() < until:
            time.sleep(0.2)
        assert not shuffles() - before and table.count() == 10_000
    assert spark.conf.get(key, None) == setting
