"""Descriptions of clusters: terms, labels, formats, lengths, snippets.

All clusters are described by one set of grouped jobs. The only table of corpus size that is
shuffled is the token lists; everything after the first aggregation has one row per
(cluster, term) or fewer.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexigrove.functions import text as X
from lexigrove.functions.constants import TOPIC_PREFIXES, UNKNOWN_FORMAT
from lexigrove.operators.tfidf import DOCUMENT_MARK, idf, marked_count, marked_term_frequency, place_tokens
from lexigrove.plans.runtime import broadcast_if_small, materialize

WEIGHT_DIGITS = 9


def cluster_term_weights(tokens: DataFrame, *, doc_id: str = "doc_id") -> DataFrame:
    """``(cluster_id, term, weight)``: TF-IDF centroid of each cluster as sparse rows.

    The mean TF-IDF of a term in a cluster is its IDF times its frequency there over the number
    of documents, so documents and terms never have to be joined.
    """
    placed = place_tokens(tokens, doc_id=doc_id, keep=("cluster_id",))
    tf = marked_term_frequency(placed, doc_id=doc_id, keep=("cluster_id",))
    # stored, because all that follows reads these far fewer rows and not the documents again
    by_cluster = materialize(
        tf.groupBy("cluster_id", "term").agg(F.sum("tf").alias("tf"), F.count("*").alias("docs"))
    )
    vocabulary = by_cluster.groupBy("term").agg(F.sum("docs").alias("df"))
    sizes = by_cluster.groupBy("cluster_id").agg(
        F.max(F.when(F.col("term") == DOCUMENT_MARK, F.col("docs"))).alias("n_docs")
    )
    n_documents = marked_count(vocabulary, "df")
    weighted = by_cluster.filter(F.col("tf") > 0).join(vocabulary, "term").join(sizes, "cluster_id")
    return weighted.select(
        "cluster_id", "term",
        (F.col("tf") * idf(n_documents, F.col("df")) / F.col("n_docs")).alias("weight"),
    )


def top_terms(weights: DataFrame, n: int = 10) -> DataFrame:
    """``(cluster_id, rank, term, weight)``: the heaviest terms with a positive weight.

    Weights are compared at ``WEIGHT_DIGITS`` digits, so that the order of adding doesn't decide; equal ones rank by term.
    """
    order = Window.partitionBy("cluster_id").orderBy(F.round("weight", WEIGHT_DIGITS).desc(), "term")
    return (
        weights.filter(F.col("weight") > 0)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= n)
        .select("cluster_id", "rank", "term", "weight")
    )


def term_list(ranked: DataFrame) -> DataFrame:
    """Top terms as one ``array<struct<term, weight>>`` per cluster; at most a few entries each."""
    entries = F.array_sort(F.collect_list(F.struct("rank", "term", "weight")))
    return ranked.groupBy("cluster_id").agg(
        F.transform(entries, lambda e: F.struct(e["term"].alias("term"), e["weight"].alias("weight"))).alias("top_terms")
    )


def centroid_norms(weights: DataFrame) -> DataFrame:
    return weights.groupBy("cluster_id").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("centroid_norm"))


def first_documents(documents: DataFrame, n: int, *, doc_id: str = "doc_id") -> DataFrame:
    """``(cluster_id, doc_id, place)`` of the first ``n`` documents of each cluster by id.

    Only the two id columns are read and sorted, and the rank limit is applied before the shuffle.
    """
    order = Window.partitionBy("cluster_id").orderBy(doc_id)
    return documents.select("cluster_id", doc_id, F.row_number().over(order).alias("place")).filter(F.col("place") <= n)


def topic_prefixes(first_texts: DataFrame, *, text: str = "text") -> DataFrame:
    """``(cluster_id, prefix)`` from words in the first five documents; null where none is there."""
    low = F.lower(F.coalesce(text, F.lit("")))
    hits = [
        F.bool_or(reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in words])) for _, words in TOPIC_PREFIXES
    ]
    prefix = F.lit(None).cast("string")
    for hit, (name, _) in reversed(list(zip(hits, TOPIC_PREFIXES))):
        prefix = F.when(hit, F.lit(name)).otherwise(prefix)
    return first_texts.filter(F.col("place") <= 5).groupBy("cluster_id").agg(prefix.alias("prefix"))


def label(terms: Column, prefix: Column) -> Column:
    """Three top terms in title case, with the topic before them where one was found."""
    base = F.when(F.size(terms) >= 3, F.initcap(F.array_join(F.slice(terms, 1, 3), " / "))).otherwise(F.lit("Cluster"))
    return F.concat(F.coalesce(F.concat(prefix, F.lit(" - ")), F.lit("")), base)


def simple_label(terms: Column) -> Column:
    return F.upper(F.array_join(F.slice(terms, 1, 3), " | "))


def format_mix(documents: DataFrame, *, format: str = "format") -> DataFrame:
    """``(cluster_id, format, n)``."""
    named = documents.select("cluster_id", F.coalesce(format, F.lit(UNKNOWN_FORMAT)).alias("format"))
    return named.groupBy("cluster_id", "format").agg(F.count("*").alias("n"))


def average_length(documents: DataFrame, *, words: str = "word_count") -> DataFrame:
    """``(cluster_id, size, average_doc_length)``; a missing count is 0."""
    return documents.groupBy("cluster_id").agg(
        F.count("*").alias("size"), F.avg(F.coalesce(words, F.lit(0))).alias("average_doc_length")
    )


def snippets(
    first_texts: DataFrame, terms: DataFrame, *, doc_id: str = "doc_id", raw_text: str = "text",
    n_docs: int = 10, n_snippets: int = 3,
) -> DataFrame:
    """``(cluster_id, place, doc_id, snippet)``: sentences of 21 to 49 words with a top-five term.

    At most ``n_snippets`` per cluster, in document and then sentence order, from the first
    ``n_docs`` documents. ``terms`` is ``(cluster_id, top_terms)``.
    """
    words = terms.select("cluster_id", F.slice(F.transform("top_terms", lambda t: t["term"]), 1, 5).alias("words"))
    pieces = first_texts.filter(F.col("place") <= n_docs).select(
        "cluster_id", doc_id, F.posexplode_outer(X.sentences(raw_text)).alias("pos", "snippet")
    )
    fitting = pieces.withColumn("n_words", X.word_count("snippet")).filter(F.col("n_words").between(21, 49))
    hits = fitting.join(words, "cluster_id").filter(X.contains_any("snippet", F.col("words")))
    order = Window.partitionBy("cluster_id").orderBy(doc_id, "pos")
    return (
        hits.withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= n_snippets)
        .select("cluster_id", "place", doc_id, "snippet")
    )


def first_texts(documents: DataFrame, n: int, columns: list[str], *, doc_id: str = "doc_id") -> DataFrame:
    """The first documents of each cluster with text columns.

    The ids found are few (``n`` per cluster), so they are broadcast to one pass over the texts;
    with very many clusters the join is left to Spark.
    """
    chosen = broadcast_if_small(first_documents(documents, n, doc_id=doc_id))
    return documents.select(doc_id, *columns).join(chosen, doc_id)


def describe_clusters(
    documents: DataFrame, *, doc_id: str = "doc_id", raw_text: str = "raw_text", text: str = "text",
    format: str = "format", words: str = "word_count", n_terms: int = 10, n_snippets: int = 3,
) -> DataFrame:
    """One row of metadata per cluster of ``documents``, which carries ``cluster_id``.

    ``text`` is the cleaned text the terms come from, ``raw_text`` the one snippets are cut from.
    """
    tokens = documents.select(doc_id, "cluster_id", X.tokenize_clean(text).alias("tokens"))
    weights = cluster_term_weights(tokens, doc_id=doc_id)
    # a few terms per cluster, read by the labels and by the snippets
    terms = materialize(
        centroid_norms(weights).join(term_list(top_terms(weights, n_terms)), "cluster_id", "left")
    )
    # raw texts are joined and the few that are left cleaned; stored, because snippets and prefixes both read them
    firsts = materialize(first_texts(documents, 10, [raw_text], doc_id=doc_id))
    cleaned = firsts.withColumn("_clean", X.clean_text(raw_text))
    cut = snippets(firsts, terms, doc_id=doc_id, raw_text=raw_text, n_snippets=n_snippets)
    cut_lists = cut.groupBy("cluster_id").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("place", "snippet"))), lambda s: s["snippet"]
        ).alias("representative_snippets")
    )
    formats = format_mix(documents, format=format).groupBy("cluster_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("format", "n")))).alias("formats")
    )
    basics = average_length(documents, words=words)
    total = basics.agg(F.sum("size")).scalar()
    joined = (
        basics.join(terms, "cluster_id", "left")
        .join(topic_prefixes(cleaned, text="_clean"), "cluster_id", "left")
        .join(formats, "cluster_id", "left")
        .join(cut_lists, "cluster_id", "left")
    )
    names = F.coalesce(F.transform("top_terms", lambda t: t["term"]), F.array().cast("array<string>"))
    return joined.select(
        "cluster_id",
        label(names, F.col("prefix")).alias("label"),
        simple_label(names).alias("simple_label"),
        "size",
        (F.col("size").cast("double") / total * 100).alias("percentage"),
        F.coalesce("top_terms", F.array().cast("array<struct<term:string,weight:double>>")).alias("top_terms"),
        "formats",
        "average_doc_length",
        F.coalesce("representative_snippets", F.array().cast("array<string>")).alias("representative_snippets"),
        F.coalesce("centroid_norm", F.lit(0.0)).alias("centroid_norm"),
    )
