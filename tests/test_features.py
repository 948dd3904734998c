import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexigrove.operators import similarity as S, tfidf as T


def tokens(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, tokens array<string>")


def test_hash_buckets(spark):
    words = {"data": 1695, "science": 3363, "abcd": 2100, "abcde": 1384, "spark": 3286, "e": 3550}
    frame = tokens(spark, [(i, [w, f"other{i}"]) for i, w in enumerate(words)])
    raw = T.fit_hashed_tfidf(frame).stages[0].transform(frame).select("tokens", "raw_features").collect()
    for row in raw:
        assert row.raw_features[words[row.tokens[0]]] >= 1


def test_idf_values(spark):
    rows = {(r.doc_id, r.term): r.tfidf for r in T.tfidf(tokens(spark, [(1, ["a", "b"]), (2, ["a", "c", "c"])])).collect()}
    assert rows[1, "a"] == 0.0
    assert rows[1, "b"] == pytest.approx(math.log(1.5))
    assert rows[2, "c"] == pytest.approx(2 * math.log(1.5))


@pytest.mark.parametrize("n", [5, 10, 20])
def test_repeated_documents_weigh_nothing(spark, n):
    frame = tokens(spark, [(i, ["same", "words"]) for i in range(n)])
    assert all(r.tfidf == 0.0 for r in T.tfidf(frame).collect())
    assert T.feature_rows(T.hashed_tfidf(frame)).count() == 0


def test_vocabulary_limit_and_guards(spark):
    frame = tokens(spark, [(1, ["a", "a", "b"]), (2, ["a", "c"])])
    assert {r.term for r in T.tfidf(frame, max_terms=2).collect()} == {"a", "b"}
    with pytest.raises(ValueError):
        T.require_corpus(frame.limit(1))
    with pytest.raises(ValueError):
        T.require_corpus(frame.limit(0))


def test_feature_and_term_names(spark):
    row = spark.createDataFrame([(7, None)], "i int, t string").select(T.feature_name(F.col("i")), T.term_name(F.col("i"), F.col("t"))).first()
    assert tuple(row) == ("feature_7", "term_7")


def brute_force(docs, k, threshold):
    df = {}
    for words in docs.values():
        for w in set(words):
            df[w] = df.get(w, 0) + 1
    vectors = {}
    for d, words in docs.items():
        v = {w: words.count(w) * math.log((len(docs) + 1) / (df[w] + 1)) for w in set(words)}
        norm = math.sqrt(sum(x * x for x in v.values()))
        vectors[d] = {w: x / norm for w, x in v.items()} if norm else {}
    out = set()
    for d, v in vectors.items():
        near = []
        for o, u in vectors.items():
            score = round(sum(x * u.get(w, 0.0) for w, x in v.items()), 9)
            if o != d and score >= threshold:
                near.append((-score, o))
        out |= {(d, i + 1, o, -s) for i, (s, o) in enumerate(sorted(near)[:k])}
    return out


@pytest.mark.parametrize("hot,block", [(64, 2000), (2, 5)])
def test_similar_documents_match_brute_force(spark, hot, block):
    """A third of the documents are one text's copies and near copies, also when cut into blocks."""
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)]
    base = list(rng.choice(words, 12))
    docs = {}
    for d in range(60):
        if d % 6 == 0:
            docs[d] = list(base)
        elif d % 6 == 1:
            docs[d] = base[:11] + [str(rng.choice(words))]
        else:
            docs[d] = [str(w) for w in rng.choice(words, rng.integers(3, 15))]
    docs = {d: [str(w) for w in ws] for d, ws in docs.items()}
    frame = tokens(spark, list(docs.items()))
    found = {
        (r.doc_id, r.rank, r.other_id, round(r.similarity, 9))
        for r in S.similar_documents(frame, k=3, threshold=0.6, hot=hot, block=block).collect()
    }
    assert found == brute_force(docs, 3, 0.6)
