"""Search before, amid and after documents get their embeddings."""

import numpy as np
import pytest

from lexigrove.operators import readiness
from lexigrove.operators.readiness import EMBEDDING, TERM, TermIndex, search_until_ready

DOCS = [(1, "apple orchard harvest"), (2, "apple cider"), (3, "river bridge stone"), (4, None), (5, "apple apple orchard"), (6, "apple cider")]


@pytest.fixture(scope="module")
def lengths():
    return lambda texts: np.array([[1.0 + len(t), 1.0] for t in texts], np.float32)


@pytest.fixture(scope="module")
def index(spark):
    return TermIndex(spark.createDataFrame(DOCS, "doc_id long, text string"))


def held(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, embedding array<float>")


def asked(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "query_id long, text string")


def found(rows, query=0):
    return [(r.doc_id, r.space) for r in sorted(rows.collect(), key=lambda r: r.rank) if r.query_id == query]


def test_terms_only_before_any_is_ready(spark, index, lengths):
    rows = search_until_ready(asked(spark, "apple cider", "unknown word", None), index, held(spark, []), lengths)
    # equal texts tie and rank by id, documents without a shared term have no rank
    assert found(rows)[:2] == [(2, TERM), (6, TERM)] and {d for d, _ in found(rows)} == {1, 2, 5, 6}
    assert found(rows, 1) == found(rows, 2) == []


def test_each_document_in_one_space(spark, index, lengths):
    rows = search_until_ready(asked(spark, "apple cider"), index, held(spark, [(2, [5.0, 1.0]), (3, [1.0, 5.0]), (9, None)]), lengths)
    merged = found(rows)
    assert merged[0] == (2, EMBEDDING) and merged[1] == (6, TERM) and merged[2] == (3, EMBEDDING)
    assert len({d for d, _ in merged}) == len(merged) == 5


def test_embeddings_only_once_all_are_ready(spark, index, lengths):
    everything = held(spark, [(d, [float(d), 1.0]) for d, _ in DOCS])
    rows = search_until_ready(asked(spark, "apple cider"), index, everything, lengths, k=3)
    assert [s for _, s in found(rows)] == [EMBEDDING] * 3 and [r.rank for r in rows.orderBy("rank").collect()] == [1, 2, 3]


def test_empty_sides(spark, index, lengths):
    assert search_until_ready(asked(spark, "apple").limit(0), index, held(spark, [(1, [1.0, 0.0])]), lengths).count() == 0
    nothing = TermIndex(spark.createDataFrame([], "doc_id long, text string"))
    assert search_until_ready(asked(spark, "apple"), nothing, held(spark, []), lengths).count() == 0


def test_a_row_a_document_and_blocks_of_queries(spark, index, monkeypatch):
    """Postings never become rows of query and document: the index has a row a document, and a task gives at most k rows a query."""
    assert index.weights.count() == 5
    texts = ("apple cider", "orchard", "apple orchard harvest", "river bridge")
    whole = index.search(asked(spark, *texts), 2)
    monkeypatch.setattr(readiness, "BROADCAST_BYTES", 60)
    monkeypatch.setattr(readiness, "CHUNK_CELLS", 3)
    key = lambda r: (r.query_id, r.rank, r.doc_id, round(r.score, 9))
    assert sorted(map(key, index.search(asked(spark, *texts), 2).collect())) == sorted(map(key, whole.collect()))
    assert [d for q, _, d, _ in sorted(map(key, whole.collect())) if q == 0] == [2, 6]
