"""Search over a corpus of which only some documents have embeddings yet.

A document is ready once the store holds an embedding of it. Ready documents are ranked by the cosine of their embeddings, the others by
the cosine of their TF-IDF weights, so every document is ranked in one space. Both lists are merged by rank, because scores of
two spaces don't compare: the better rank comes first, at the same rank the embedding, then the smaller id. Before any document is
ready this is term search, and once all are it is embedding search.

Defined results: a query without known terms finds ready documents only; a document without terms is found once it is ready, and
then only if its embedding is not zero; null texts count as empty; ties rank by id; an empty corpus or no query gives no rows. Ids are
unique on both sides. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from lexigrove.functions import text as X
from lexigrove.operators.encoder import TextEncoder, embed
from lexigrove.operators.nearest import CHUNK_CELLS, RESULT, _Best, nearest, ranked
from lexigrove.operators.tfidf import idf, marked_count, marked_term_frequency, place_tokens
from lexigrove.operators.tokens import tokenize_documents
from lexigrove.plans.runtime import BROADCAST_BYTES, broadcast_if_small, materialize

EMBEDDING, TERM = "embedding", "term"


def _unit(weights: DataFrame, key: str) -> DataFrame:
    """``(key, term, weight)`` at length one; a row of weight 0 adds nothing and goes."""
    found = weights.filter(F.col("weight") > 0)
    length = found.groupBy(key).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("length"))
    return found.join(length, key).select(key, "term", (F.col("weight") / F.col("length")).alias("weight"))


class _Wanted:
    """A block of queries: their terms, and for each term its queries and weights one after the other."""

    def __init__(self, rows: pa.Table):
        rows = rows.sort_by("term")
        self.ids, query = np.unique(rows.column("query_id").to_numpy(), return_inverse=True)
        self.query, self.asked = query, rows.column("asked").to_numpy()
        terms = rows.column("term").combine_chunks().dictionary_encode()
        self.terms, self.sizes = terms.dictionary, np.bincount(terms.indices.to_numpy(), minlength=len(terms.dictionary))
        self.begins = np.cumsum(self.sizes) - self.sizes

    def fold(self, best: _Best, batch: pa.RecordBatch) -> None:
        """Score documents, a slice at a time whose matrix of documents and queries is bounded, and keep the best."""
        step = max(1, CHUNK_CELLS // len(self.ids))
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            weights = part.column("weights")
            terms, values = weights.flatten().flatten()
            met = pc.index_in(terms, self.terms).to_numpy(zero_copy_only=False)
            document = np.repeat(np.arange(len(part)), pc.list_value_length(weights).to_numpy(zero_copy_only=False))
            known = np.flatnonzero(~np.isnan(met)) if met.dtype.kind == "f" else np.arange(len(met))
            met, document = met[known].astype(np.int64), document[known]
            unit = values.to_numpy()[known] / part.column("length").to_numpy()[document]
            # each posting meets the queries that have its term
            sizes = self.sizes[met]
            at = np.arange(sizes.sum()) + np.repeat(self.begins[met] - np.cumsum(sizes) + sizes, sizes)
            cells = self.query[at] * len(part) + np.repeat(document, sizes)
            scores = np.bincount(cells, np.repeat(unit, sizes) * self.asked[at], len(self.ids) * len(part)).reshape(len(self.ids), len(part))
            best.add(np.arange(len(self.ids)), np.where(scores > 0, -scores, np.inf), part.column("doc_id").to_numpy())


def _best_of_block(wanted: DataFrame, documents: DataFrame, k: int) -> DataFrame:
    block = _Wanted(wanted.toArrow())
    held = wanted.sparkSession.sparkContext.broadcast(block)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = held.value
        best = _Best(len(asked.ids), k, "terms")
        for batch in batches:
            if len(asked.ids):
                asked.fold(best, batch)
        yield best.to_arrow(asked.ids)

    return documents.mapInArrow(scan, RESULT)


class TermIndex:
    """TF-IDF weights, a row a document, with their length, and the weight of each term, both stored when made."""

    def __init__(self, documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text"):
        tokens = tokenize_documents(documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
        tf = materialize(marked_term_frequency(place_tokens(tokens)))
        totals = materialize(tf.groupBy("term").agg(F.count("*").alias("df")))
        known = totals.filter(F.col("term") != "")
        self.terms = materialize(known.select("term", idf(marked_count(totals, "df"), F.col("df")).alias("idf")))
        weighted = tf.filter(F.col("tf") > 0).join(self.terms, "term").select("doc_id", "term", (F.col("tf") * F.col("idf")).alias("weight"))
        weighted = weighted.filter(F.col("weight") > 0).groupBy("doc_id").agg(
            F.collect_list(F.struct("term", "weight")).alias("weights"), F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("length"))
        self.weights = materialize(weighted)

    def search(self, queries: DataFrame, k: int = 5, *, besides: DataFrame | None = None, query_id: str = "query_id", text: str = "text") -> DataFrame:
        """``(query_id, rank, doc_id, score)`` by cosine, of documents that share a term; those of ``besides`` are left out.

        The queries' weights are broadcast, a block of bounded size after the other. The documents stream by once for it, and a task keeps
        the best ``k`` of each query: only these move. Document ids are longs.
        """
        asked = queries.select(F.col(query_id).alias("query_id"), F.explode(X.tokenize(F.coalesce(text, F.lit("")))).alias("term"))
        counted = asked.groupBy("query_id", "term").agg(F.count("*").alias("tf")).join(self.terms, "term")
        wanted = _unit(counted.select("query_id", "term", (F.col("tf") * F.col("idf")).alias("weight")), "query_id")
        wanted = materialize(wanted.withColumnRenamed("weight", "asked"))
        size = F.sum(F.octet_length("term") + 32) + F.count_distinct("query_id") * (k * 24)
        blocks = max(1, math.ceil((wanted.agg(size).first()[0] or 0) / BROADCAST_BYTES))
        documents = self.weights.filter(F.col("doc_id").isNotNull())
        if besides is not None:
            documents = documents.join(broadcast_if_small(besides.select("doc_id"), 4_000_000), "doc_id", "left_anti")
        documents = documents.withColumn("doc_id", F.col("doc_id").cast("long"))
        found = None
        for block in range(blocks):
            part = wanted.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block)
            best = _best_of_block(part, documents, k)
            found = best if found is None else found.unionByName(best)
        return ranked(found, k).select("query_id", "rank", F.col("item_id").alias("doc_id"), (-F.col("score")).alias("score"))


def search_until_ready(
    queries: DataFrame, index: TermIndex, store: DataFrame, encoder: TextEncoder, k: int = 5, *, query_id: str = "query_id", text: str = "text"
) -> DataFrame:
    """``(query_id, rank, doc_id, space, score)``: the ``k`` best of both lists; ``space`` says where a document was ranked.

    ``store`` holds ``(doc_id, embedding)`` of what is ready now. The index covers the whole corpus and isn't changed as documents get ready.
    """
    asked = queries.select(F.col(query_id).cast("long").alias("query_id"), F.col(text).alias("text"))
    ready = store.filter(F.col("embedding").isNotNull()).select("doc_id", "embedding")
    near = nearest(embed(asked, encoder), ready, k, metric="cosine").select("query_id", "rank", "doc_id", F.lit(EMBEDDING).alias("space"), "score")
    waiting = index.search(asked, k, besides=ready).select("query_id", "rank", "doc_id", F.lit(TERM).alias("space"), "score")
    order = Window.partitionBy("query_id").orderBy("rank", "space", "doc_id")  # "embedding" sorts before "term"
    merged = near.unionByName(waiting).withColumn("rank", F.row_number().over(order))
    return merged.filter(F.col("rank") <= k)
