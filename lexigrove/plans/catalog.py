"""The registered queries: every operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lexigrove.functions import text as X, vectors as V
from lexigrove.functions.constants import UNASSIGNED_CLUSTER
from lexigrove.operators import (
    clusters as C, encoder as E, evaluate as EV, profile as P, pruned as PR, readiness as RD, retrieval as R, running as RU, similarity as S,
    tfidf as T, tokens as K,
)
from lexigrove.plans.runtime import TASK_BYTES, materialize, scratch_path, spread
from lexigrove.sources import bucketed as B, files, listed, tables
from lexigrove.streaming import batches as SB, embed as ST, progress as SP, store as SS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(digits: int, *names: str) -> list[Column]:
    return [F.round(F.col(n), digits).alias(n) for n in names]


def documents(spark: SparkSession, sf_dir: str, *columns: str, task_bytes: int | None = None) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", *columns), task_bytes)


def clustered(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Documents with their source as the given cluster."""
    docs = documents(spark, sf_dir, "source", *columns)
    return docs.withColumn("cluster_id", F.regexp_extract("source", r"(\d+)$", 1).cast("int")).drop("source")


def cluster_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.tokenize_documents(clustered(spark, sf_dir, "text"), clean=True, keep=("cluster_id",))


def store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as a vector store whose clusters are the labels."""
    vectors = table(spark, sf_dir, "embeddings")
    return vectors.select(F.col("vec_id").alias("doc_id"), "embedding", F.col("label").alias("cluster_id"))


def vector_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector asks for its neighbours."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("query_id"), "embedding")


# text

@query
def clean_text(spark, sf_dir):
    return documents(spark, sf_dir, "text").select("doc_id", X.clean_text("text").alias("text"))


@query
def word_char_counts(spark, sf_dir):
    counts = K.word_char_counts(documents(spark, sf_dir, "text"))
    return counts.select("doc_id", *[F.col(c).cast("long").alias(c) for c in ("char_count", "word_count")])


@query
def tokenize(spark, sf_dir):
    tokens = K.tokenize_documents(documents(spark, sf_dir, "text"))
    return tokens.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens"))


@query
def document_filter_counts(spark, sf_dir):
    return K.document_filter_counts(documents(spark, sf_dir, "text"))


@query
def ngrams(spark, sf_dir):
    return K.ngram_counts(K.tokenize_documents(documents(spark, sf_dir, "text", task_bytes=TASK_BYTES)), 2)


@query
def lemma_clean(spark, sf_dir):
    """Lemma table made from the corpus: a form in -s whose stem is a word of the corpus too."""
    docs = documents(spark, sf_dir, "text")
    words = materialize(
        docs.select(F.explode_outer(F.split(X.clean_text("text"), " ")).alias("w")).filter(F.length("w") > 2).distinct()
    )
    forms = words.filter(F.col("w").endswith("s")).select(
        F.col("w").alias("form"), F.expr("substring(w, 1, length(w) - 1)").alias("lemma")
    )
    lemmas = forms.join(words.select(F.col("w").alias("lemma")), "lemma", "left_semi")
    return K.lemmatize_documents(docs, lemmas)


@query
def json_extract(spark, sf_dir):
    parsed = files.parse_json_documents(table(spark, sf_dir, "events"), content="props", key="event_id")
    return parsed.select("event_id", "text", F.try_element_at("metadata", F.lit("k")).alias("k"), "success")


@query
def json_documents(spark, sf_dir):
    """Each turn of a conversation as a JSON document, parsed back."""
    turns = table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 100000 + F.col("turn")).alias("turn_id"),
        F.to_json(F.struct("role", "turn", F.col("text").alias("content"))).alias("doc"),
    )
    parsed = files.parse_json_documents(turns, content="doc", key="turn_id")
    return parsed.select(
        "turn_id", "text", F.get_json_object(F.concat(F.lit('{"v":'), F.try_element_at("metadata", F.lit("role")), F.lit("}")), "$.v").alias("role"),
        F.try_element_at("metadata", F.lit("turn")).cast("long").alias("turn"),
    )


# files

@query
def corpus_roundtrip(spark, sf_dir):
    """Documents written as JSON lines and read back."""
    path = scratch_path(spark, "corpus")
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("file_name"), "text", F.col("n_chars").cast("int").alias("word_count"),
        F.lit(0.5).alias("extraction_time"), F.lit(True).alias("success"),
    )
    tables.write_corpus_jsonl(docs, path, include_metadata=False)
    return tables.read_corpus_jsonl(spark, path).select(
        "doc_id", "text", F.col("word_count").cast("long").alias("word_count"), "processing_time"
    )


@query
def corpus_rejects(spark, sf_dir):
    """Documents as JSON lines, some of them cut off or without text, and what became of the lines."""
    path, empty = scratch_path(spark, "lines"), F.col("doc_id") % 5 == 0
    docs = table(spark, sf_dir, "documents").select("doc_id", F.when(empty, F.lit(" ")).otherwise(F.col("text")).alias("text"))
    line = F.to_json(F.struct(F.col("doc_id").cast("string").alias("doc_id"), "text"))
    docs.select(F.when(F.col("doc_id") % 7 == 0, F.substr(line, F.lit(1), F.length(line) - 1)).otherwise(line)).write.text(path)
    kept, seen = tables.read_corpus_with_rejects(spark, path)
    kept.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(sorted(seen.get.items()), "kind string, lines long")


@query
def files_roundtrip(spark, sf_dir):
    """Every document as a text file of its own, listed and parsed back from the folder."""
    base = scratch_path(spark, "files")
    listed.write_files(documents(spark, sf_dir, "text"), f"{base}/texts")
    listed.refresh(spark, f"{base}/texts", f"{base}/manifest", ["*.txt"])
    return file_rows(listed.parse_manifest(spark, f"{base}/manifest", extractors={}))


def file_rows(parsed: DataFrame) -> DataFrame:
    rows = tables.structured_documents(parsed, keep=("file_path",))
    return rows.select(
        F.regexp_extract("file_path", r"/(\d+)\.txt$", 1).cast("long").alias("doc_id"), "format", "raw_text", "text",
        F.col("word_count").cast("long").alias("word_count"),
    )


@query
def files_stream(spark, sf_dir):
    """The same as a stream: odd ids are listed first, the others join the folder and the manifest while it runs."""
    base, docs = scratch_path(spark, "streamed"), documents(spark, sf_dir, "text")
    out = f"{base}/out"
    for part in (1, 0):
        listed.write_files(docs.filter(F.pmod("doc_id", F.lit(2)) == part), f"{base}/texts")
        listed.refresh(spark, f"{base}/texts", f"{base}/manifest", ["*.txt"])
        parsed = listed.stream_manifest(spark, f"{base}/manifest", extractors={})
        running = parsed.writeStream.format("parquet").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start(out)
        running.awaitTermination()
    return file_rows(spark.read.schema(parsed.schema).parquet(out))


# features

@query
def term_frequency(spark, sf_dir):
    return T.term_frequency(T.place_tokens(K.tokenize_documents(documents(spark, sf_dir, "text"))))


@query
def document_frequency(spark, sf_dir):
    return T.document_frequency(T.term_frequency(T.place_tokens(K.tokenize_documents(documents(spark, sf_dir, "text")))))


@query
def tfidf_exact(spark, sf_dir):
    weights = T.tfidf(K.tokenize_documents(documents(spark, sf_dir, "text"), clean=True))
    return weights.select("doc_id", "term", "tf", "df", *rounded(9, "tfidf"))


@query
def tfidf_top_vocabulary(spark, sf_dir):
    """TF-IDF over the 5000 most frequent terms."""
    weights = T.tfidf(K.tokenize_documents(documents(spark, sf_dir, "text")), max_terms=5000)
    return weights.select("doc_id", "term", "tf", "df", *rounded(9, "tfidf"))


@query
def hashed_tfidf(spark, sf_dir):
    tokens = K.tokenize_documents(documents(spark, sf_dir, "text"))
    rows = T.feature_rows(T.hashed_tfidf(tokens))
    return rows.select("doc_id", T.feature_name(F.col("feature")).alias("feature"), *rounded(9, "weight"))


@query
def doc_similarity(spark, sf_dir):
    tokens = K.tokenize_documents(documents(spark, sf_dir, "text"))
    found = S.similar_documents(tokens, k=5, threshold=0.8)
    return found.select("doc_id", F.col("rank").cast("long").alias("rank"), "other_id", *rounded(9, "similarity"))


# clusters

@query
def cluster_stats(spark, sf_dir):
    stats = C.cluster_stats(store(spark, sf_dir))
    return stats.select(F.col("cluster_id").cast("long").alias("cluster_id"), "size", *rounded(9, "percentage"))


@query
def cluster_centroids(spark, sf_dir):
    rows = R.centroids(store(spark, sf_dir)).select(
        F.col("cluster_id").cast("long").alias("cluster_id"), F.posexplode("centroid").alias("dim", "value")
    )
    return rows.select("cluster_id", F.col("dim").cast("long").alias("dim"), *rounded(9, "value"))


@query
def kmeans_assign(spark, sf_dir):
    vectors = store(spark, sf_dir)
    found = C.assign_to_centers(vectors, R.centroids(vectors))
    return found.select("doc_id", F.col("cluster_id").cast("long").alias("cluster_id"), *rounded(9, "distance"))


@query
def kmeans_cluster(spark, sf_dir):
    """What any sound fit of ten centres fulfils; points not at their nearest centre are found by the exact search."""
    vectors = store(spark, sf_dir)
    features = vectors.select("doc_id", V.to_ml("embedding").alias("features"))
    model = C.fit_kmeans(features, 10, max_iter=20)
    assigned = C.assign(model, features)
    nearest = C.assign_to_centers(vectors, C.centers(spark, model)).select("doc_id", F.col("cluster_id").alias("nearest"))
    wrong = assigned.join(nearest, "doc_id", "left").filter(~F.col("cluster_id").eqNullSafe(F.col("nearest")))
    return C.fit_facts(model, assigned).withColumn("not_nearest", wrong.agg(F.count("*")).scalar())


@query
def kmeans_documents(spark, sf_dir):
    """Hashed TF-IDF of the corpus clustered with ten centres: what any sound fit fulfils."""
    features = materialize(T.hashed_tfidf(K.tokenize_documents(documents(spark, sf_dir, "text"))))
    model = C.fit_kmeans(features, 10, max_iter=20)
    assigned = C.assign(model, features)
    return C.fit_facts(model, assigned).withColumn("not_nearest", C.not_nearest(spark, model, assigned))


@query
def silhouette(spark, sf_dir):
    features = store(spark, sf_dir).select("cluster_id", V.to_ml("embedding").alias("features"))
    return spark.range(1).select(F.round(F.lit(C.silhouette(features)), 6).alias("silhouette"))


@query
def cluster_top_terms(spark, sf_dir):
    ranked = P.top_terms(P.cluster_term_weights(cluster_tokens(spark, sf_dir)))
    return ranked.select(
        F.col("cluster_id").cast("long").alias("cluster_id"), F.col("rank").cast("long").alias("rank"), "term", *rounded(9, "weight")
    )


@query
def cluster_label(spark, sf_dir):
    terms = P.term_list(P.top_terms(P.cluster_term_weights(cluster_tokens(spark, sf_dir))))
    firsts = P.first_texts(clustered(spark, sf_dir, "text"), 5, ["text"])
    prefixes = P.topic_prefixes(firsts.withColumn("text", X.clean_text("text")))
    names = F.transform("top_terms", lambda t: t["term"])
    return terms.join(prefixes, "cluster_id", "left").select(
        F.col("cluster_id").cast("long").alias("cluster_id"), P.label(names, F.col("prefix")).alias("label"),
        P.simple_label(names).alias("simple_label"),
    )


@query
def representative_snippets(spark, sf_dir):
    terms = P.term_list(P.top_terms(P.cluster_term_weights(cluster_tokens(spark, sf_dir))))
    firsts = P.first_texts(clustered(spark, sf_dir, "text"), 10, ["text"])
    return P.snippets(firsts, terms).select(
        F.col("cluster_id").cast("long").alias("cluster_id"), F.col("place").cast("long").alias("place"), "doc_id", "snippet"
    )


@query
def cluster_format_mix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        F.regexp_extract("source", r"(\d+)$", 1).cast("long").alias("cluster_id"), F.col("lang").alias("format")
    )
    return P.format_mix(docs)


@query
def cluster_avg_length(spark, sf_dir):
    docs = clustered(spark, sf_dir, "text").withColumn("word_count", X.word_count("text"))
    return P.average_length(docs).select(
        F.col("cluster_id").cast("long").alias("cluster_id"), "size", *rounded(9, "average_doc_length")
    )


@query
def cluster_metadata(spark, sf_dir):
    docs = clustered(spark, sf_dir, "text", "lang").select(
        "doc_id", "cluster_id", F.col("text").alias("raw_text"), X.clean_text("text").alias("text"),
        F.col("lang").alias("format"), X.word_count("text").alias("word_count"),
    )
    described = P.describe_clusters(docs)
    return described.select(
        F.col("cluster_id").cast("long").alias("cluster_id"), "label", "simple_label", "size", *rounded(9, "percentage"),
        F.array_join(F.transform("top_terms", lambda t: t["term"]), ",").alias("top_terms"),
        F.array_join(
            F.transform(F.map_entries("formats"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ","
        ).alias("formats"),
        *rounded(9, "average_doc_length"),
        F.array_join("representative_snippets", "|").alias("representative_snippets"),
        *rounded(6, "centroid_norm"),
    )


# embeddings and retrieval

@query
def doc_embed(spark, sf_dir):
    docs = documents(spark, sf_dir, "text")
    rows = E.embedding_rows(E.embed(docs, E.fit_encoder(docs)), "doc_id")
    return rows.select("doc_id", F.col("dim").cast("long").alias("dim"), F.round(F.col("value").cast("double"), 6).alias("value"))


@query
def query_embed(spark, sf_dir):
    encoder = E.fit_encoder(documents(spark, sf_dir, "text"))
    rows = E.embedding_rows(E.embed(table(spark, sf_dir, "benchmark"), encoder), "item_id")
    return rows.select("item_id", F.col("dim").cast("long").alias("dim"), F.round(F.col("value").cast("double"), 6).alias("value"))


def _load_letter_counter():
    """A stand-in for a model: a matrix from bytes to the letters a to z, and a function that applies it to the byte counts of texts."""
    weights = np.zeros((256, 26), np.float32)
    for letter in range(26):
        weights[ord("a") + letter, letter] = weights[ord("A") + letter, letter] = 1

    def encode(texts):
        counts = np.stack([np.bincount(np.frombuffer(t.encode("utf-8", "replace"), np.uint8), minlength=256) for t in texts])
        return counts.astype(np.float32) @ weights

    return encode


@query
def model_embed(spark, sf_dir):
    """Documents encoded by a model that each Python worker loads once."""
    rows = E.embedding_rows(E.embed_with_model(documents(spark, sf_dir, "text"), _load_letter_counter), "doc_id")
    return rows.select("doc_id", F.col("dim").cast("long").alias("dim"), F.col("value").cast("long").alias("value"))


@query
def joined_documents(spark, sf_dir):
    """Documents with their vectors and clusters out of bucketed tables: three tables, no shuffle in the join."""
    held = B.Buckets(spark, number=16)
    vectors = store(spark, sf_dir)
    held.write("documents", documents(spark, sf_dir, "lang", "source", "text"))
    held.write("vectors", vectors.select("doc_id", "embedding"))
    held.write("assignments", vectors.select("doc_id", "cluster_id"))
    return held.join("documents", "vectors", "assignments").select(
        "doc_id", "lang", "source", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"),
        F.coalesce(F.col("cluster_id").cast("long"), F.lit(UNASSIGNED_CLUSTER).cast("long")).alias("cluster_id"),
        F.coalesce(F.array_size("embedding"), F.lit(0)).cast("long").alias("dimension"))


@query
def query_captions(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select(
        "item_id", F.concat(F.lit("Q"), F.col("item_id") + 1).alias("name"), EV.query_caption("text").alias("caption")
    )


@query
def text_search(spark, sf_dir):
    """The five documents nearest to every benchmark text in embedding space."""
    docs = documents(spark, sf_dir, "text")
    encoder = E.fit_encoder(docs)
    asked = E.embed(table(spark, sf_dir, "benchmark").withColumnRenamed("item_id", "query_id"), encoder)
    found = R.flat_search(asked, E.embed(docs, encoder), 5)
    return found.select("query_id", F.col("rank").cast("long").alias("rank"), "doc_id", *rounded(6, "distance"))


@query
def vector_store_stats(spark, sf_dir):
    """Stored vectors joined with their assignments, and the size of each cluster."""
    vectors = store(spark, sf_dir)
    joined = R.assign_clusters(vectors, vectors.select("doc_id", "cluster_id"))
    sizes = R.store_cluster_sizes(joined)
    return sizes.select(*[F.col(c).cast("long").alias(c) for c in ("cluster_id", "size", "dimension")])


@query
def vector_store_totals(spark, sf_dir):
    totals = R.store_stats(store(spark, sf_dir))
    return totals.select(*[F.col(c).cast("long").alias(c) for c in totals.columns])


@query
def flat_knn(spark, sf_dir):
    found = R.flat_search(vector_queries(spark, sf_dir), store(spark, sf_dir), 5)
    return found.select("query_id", F.col("rank").cast("long").alias("rank"), "doc_id", *rounded(9, "distance"))


@query
def pruned_knn(spark, sf_dir):
    """``flat_knn`` by an index that skips what the triangle inequality rules out, and how many vectors each query reads."""
    found = PR.search(vector_queries(spark, sf_dir), PR.build_index(store(spark, sf_dir)), 5)
    return found.select("query_id", F.col("rank").cast("long").alias("rank"), "doc_id", *rounded(9, "distance"), "vectors_read")


@query
def flat_knn_scaled(spark, sf_dir):
    """``flat_knn`` over vectors a million times shorter; distances are shown in units of 1e-12."""
    short = store(spark, sf_dir).withColumn("embedding", F.transform("embedding", lambda v: v.cast("double") * 1e-6))
    found = R.flat_search(short.withColumnRenamed("doc_id", "query_id"), short, 5)
    return found.select(
        "query_id", F.col("rank").cast("long").alias("rank"), "doc_id", F.round(F.col("distance") * 1e12, 6).alias("distance")
    )


@query
def cluster_select(spark, sf_dir):
    chosen = R.select_cluster(vector_queries(spark, sf_dir), R.centroids(store(spark, sf_dir)))
    return chosen.select("query_id", F.col("cluster_id").cast("long").alias("cluster_id"), "similarity")


@query
def cluster_aware_knn(spark, sf_dir):
    vectors = store(spark, sf_dir)
    found = R.cluster_aware_search(vector_queries(spark, sf_dir), vectors, R.centroids(vectors), 5)
    return found.select(
        "query_id", F.col("rank").cast("long").alias("rank"), "doc_id", *rounded(9, "distance"),
        F.col("cluster_id").cast("long").alias("cluster_id"), "similarity",
    )


@query
def store_roundtrip(spark, sf_dir):
    """``cluster_aware_knn`` on the store written by cluster and loaded again: chosen clusters become partition filters."""
    path = scratch_path(spark, "store")
    tables.write_store(store(spark, sf_dir), path)
    loaded = tables.read_store(spark, path)
    found = R.cluster_aware_search(vector_queries(spark, sf_dir), loaded, R.centroids(loaded), 5)
    return found.select(
        "query_id", F.col("rank").cast("long").alias("rank"), "doc_id", *rounded(9, "distance"),
        F.col("cluster_id").cast("long").alias("cluster_id"), "similarity",
    )


@query
def search_space_reduction(spark, sf_dir):
    vectors = store(spark, sf_dir)
    chosen = R.select_cluster(vector_queries(spark, sf_dir), R.centroids(vectors))
    rows = R.documents_searched(chosen, vectors)
    return rows.select("query_id", "docs_searched", "flat_docs_searched", *rounded(9, "reduction_pct"))


@query
def retrieval_compare(spark, sf_dir):
    vectors, asked = store(spark, sf_dir), vector_queries(spark, sf_dir)
    chosen = materialize(R.select_cluster(asked, R.centroids(vectors)))
    aware = R.search_chosen(asked, vectors, chosen, 5)
    flat = R.flat_search(asked, vectors, 5)
    compared = R.compare_searches(aware, flat, R.documents_searched(chosen, vectors))
    return compared.withColumn("reduction_pct", F.round("reduction_pct", 9))


def _classes(spark, sf_dir):
    labels = table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("class"))
    sizes = labels.groupBy("class").agg(F.count("*").alias("total_relevant"))
    asked = labels.select(F.col("vec_id").alias("query_id"), "class")
    return asked, labels.withColumnRenamed("vec_id", "doc_id"), asked.join(sizes, "class")


@query
def precision_at_k(spark, sf_dir):
    """Relevant to a vector are the vectors of its label."""
    asked, stored, totals = _classes(spark, sf_dir)
    found = R.flat_search(vector_queries(spark, sf_dir), store(spark, sf_dir), 5)
    rows = EV.precision_at_k(EV.mark_same_class(found, asked, stored), totals, 5)
    return rows.select("query_id", F.col("k").cast("long").alias("k"), "total_relevant", "relevant_retrieved", "precision")


@query
def precision_compare(spark, sf_dir):
    asked, stored, totals = _classes(spark, sf_dir)
    vectors, queries = store(spark, sf_dir), vector_queries(spark, sf_dir)
    flat = R.flat_search(queries, vectors, 5)
    aware = R.cluster_aware_search(queries, vectors, R.centroids(vectors), 5)
    return EV.compare_precision(
        EV.precision_at_k(EV.mark_same_class(aware, asked, stored), totals, 5),
        EV.precision_at_k(EV.mark_same_class(flat, asked, stored), totals, 5),
    )


# reports

@query
def accuracy_report(spark, sf_dir):
    results = table(spark, sf_dir, "events").select(
        (F.col("event_type") != "error").alias("success"), F.col("value").alias("extraction_time")
    )
    report = EV.accuracy_report(results)
    return report.select(
        "total_processed", "successful", "failed",
        *rounded(6, "accuracy", "avg_time_per_doc", "total_time", "docs_per_second", "ms_per_doc"),
    )


@query
def latency_stats(spark, sf_dir):
    stats = EV.latency_stats(table(spark, sf_dir, "events"), ["event_type"], "value")
    return stats.select("event_type", "runs", *rounded(9, "mean"), *rounded(6, "std"), "min", "max", *rounded(6, "total"))


def _settled_mean() -> list[Column]:
    """The total settled at six digits and its mean, which then needs no rounding of its own."""
    settled = F.round("cumulative", 6)
    return [settled.alias("cumulative"), (settled / F.col("ordinal")).alias("running_mean")]


@query
def cumulative_latency(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_type", "ts", "event_id", "value")
    totals = RU.running_totals(events, "value", ["ts", "event_id"], run="event_type")
    return totals.select("event_type", "event_id", "ordinal", *_settled_mean())


@query
def latency_milestones(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("ts", "event_id", "value")
    rows = RU.milestones(RU.running_totals(events, "value", ["ts", "event_id"]))
    return rows.select("ordinal", "event_id", "total_documents", *_settled_mean())


def experiment_runs(spark, sf_dir):
    """Events as measured runs: a user is a query, an event a run, its type the thing measured."""
    def measured(kind: str) -> Column:
        return F.when(F.col("event_type") == kind, F.col("value"))

    k = F.get_json_object("props", "$.k").cast("long")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("user "), F.col("user_id")).alias("query"),
        F.col("event_id").alias("run_no"),
        k.cast("double").alias("embedding_time_ms"),
        measured("view").alias("cluster_latency_ms"),
        measured("signup").alias("cluster_selection_ms"),
        measured("purchase").alias("cluster_search_ms"),
        measured("click").alias("flat_latency_ms"),
        measured("error").alias("flat_search_ms"),
        k.alias("cluster_docs_searched"),
        F.lit(100).cast("long").alias("flat_docs_searched"),
    )


def summary(spark, sf_dir):
    size = table(spark, sf_dir, "documents").agg(F.count("*")).scalar()
    return EV.experiment_summary(EV.experiment_rows(experiment_runs(spark, sf_dir), k=5, corpus_size=size))


@query
def experiment_summary(spark, sf_dir):
    rows = summary(spark, sf_dir)
    whole = ("corpus_size", "k", "num_runs", "cluster_aware_docs_searched", "flat_docs_searched")
    return rows.select(
        "query", *[F.col(c).cast("long").alias(c) for c in whole],
        *rounded(6, *[c for c in rows.columns if c not in ("query", *whole)]),
    )


@query
def experiment_batch(spark, sf_dir):
    row = EV.batch_summary(summary(spark, sf_dir))
    return row.select("queries", *rounded(6, *[c for c in row.columns if c not in ("queries", "verdict")]), "verdict")


@query
def latency_breakdown(spark, sf_dir):
    return EV.latency_breakdown(summary(spark, sf_dir)).select("method", *rounded(6, "embedding", "cluster_selection", "search"))


def scaling_runs(spark, sf_dir):
    """Events grouped as runs with 1, 2, 4 and 8 workers."""
    return table(spark, sf_dir, "events").groupBy(
        F.expr("cast(shiftleft(1, cast(user_id % 4 as int)) as long)").alias("num_workers")
    ).agg(F.sum("value").alias("total_time_sec"), F.count("*").alias("num_documents"))


@query
def scaling_analysis(spark, sf_dir):
    rows = EV.scaling_analysis(scaling_runs(spark, sf_dir))
    return rows.select(
        "num_workers", "num_documents", *rounded(6, "total_time_sec", "speedup", "efficiency", "time_reduction_pct", "overhead_pct")
    )


@query
def scaling_summary(spark, sf_dir):
    row = EV.scaling_summary(EV.scaling_analysis(scaling_runs(spark, sf_dir)))
    numbers = ("max_speedup", "best_efficiency", "total_reduction_pct", "overhead_pct")
    return row.select("optimal_workers", "max_workers", "overhead_ok", *rounded(6, *numbers))


# streams

@query
def latest_wins(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return ST.latest(events, "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


@query
def stream_embed(spark, sf_dir):
    """Documents embedded as a file stream, read back as the latest embedding of each."""
    docs = documents(spark, sf_dir, "text")
    stream = ST.read_document_stream(spark, f"{sf_dir}/documents*.parquet", docs.schema)
    out = scratch_path(spark, "embedded")
    cores = spark.sparkContext.defaultParallelism
    running = ST.start_embedding(stream, E.fit_encoder(docs), out, f"{out}-state", partitions=cores)
    ST.wait_for_completion(running)
    rows = E.embedding_rows(ST.embeddings(spark, out), "doc_id")
    return rows.select("doc_id", F.col("dim").cast("long").alias("dim"), F.round(F.col("value").cast("double"), 6).alias("value"))


@query
def search_until_ready(spark, sf_dir):
    """Every benchmark text searched before, amid and after a stream that embeds the documents, even ids first."""
    docs = documents(spark, sf_dir, "text")
    sent, out = scratch_path(spark, "sent"), scratch_path(spark, "ready")
    encoder, index = E.fit_encoder(docs), RD.TermIndex(docs)
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")

    def found(stage, held):
        return RD.search_until_ready(asked, index, held, encoder).select(F.lit(stage).alias("stage"), "*")

    results = [found("before", spark.createDataFrame([], "doc_id long, embedding array<float>"))]
    for part, stage in enumerate(("amid", "after")):
        docs.filter(F.pmod("doc_id", F.lit(2)) == part).write.mode("append").parquet(sent)
        running = ST.start_embedding(ST.read_document_stream(spark, sent, docs.schema), encoder, out, f"{out}-state")
        ST.wait_for_completion(running)
        results.append(found(stage, materialize(ST.embeddings(spark, out).select("doc_id", "embedding"))))
    merged = results[0].unionByName(results[1]).unionByName(results[2])
    return merged.select("stage", "query_id", F.col("rank").cast("long").alias("rank"), "doc_id", "space", *rounded(6, "score"))


def _lengths(texts):
    return np.array([[len(t)] for t in texts], dtype=np.float32)


@query
def stream_latest(spark, sf_dir):
    """Every document sent twice in one batch, first with another text; the one with the higher sequence number stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    sent = scratch_path(spark, "sent")
    both = docs.select("doc_id", "text", F.lit(2).alias("version")).unionByName(
        docs.select("doc_id", F.lit("an older text").alias("text"), F.lit(1).alias("version"))
    )
    both.write.parquet(sent)
    out = scratch_path(spark, "latest")
    running = ST.start_embedding(ST.read_document_stream(spark, sent, both.schema), _lengths, out, f"{out}-state", sequence="version")
    ST.wait_for_completion(running)
    return ST.embeddings(spark, out).select("doc_id", F.get("embedding", F.lit(0)).cast("long").alias("n_chars"))


@query
def store_upsert(spark, sf_dir):
    """Events upserted into a keyed store in four batches, one of them sent twice; the last event of each user stays."""
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    held = SS.KeyedStore(spark, scratch_path(spark, "upserted"), events.schema, key="user_id", order_by=["ts", "event_id"], buckets=16)
    for number, part in enumerate((0, 1, 2, 2, 3)):
        # a batch that is sent again has its old number
        held.upsert(events.filter(F.pmod("event_id", F.lit(4)) == part), number if number < 3 else number - 1)
    return held.read().select("user_id", "event_id", "event_type", "value")


@query
def stream_progress(spark, sf_dir):
    """Totals that events have added up over a stream of the documents in eight files, a file a batch."""
    sent = scratch_path(spark, "sent")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs.repartition(8).write.parquet(sent)
    listener = SP.listen(spark)
    try:
        stream = ST.read_document_stream(spark, sent, docs.schema, max_files=1)
        running = stream.writeStream.format("noop").option("checkpointLocation", f"{sent}-state").trigger(availableNow=True).start()
        listener.expect(running.id, docs.count())
        running.awaitTermination()
        report = listener.wait(running)
    finally:
        spark.streams.removeListener(listener)
    names = ("batches", "processed", "waiting", "total")
    return spark.createDataFrame([tuple(report[n] for n in names)], ", ".join(f"{n} long" for n in names))


@query
def stream_batches(spark, sf_dir):
    """Every document in a batch of 32 or, flushed by its timer, in a smaller one."""
    sent, out = scratch_path(spark, "sent"), scratch_path(spark, "batches")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs.write.parquet(sent)
    wanted = docs.count()
    with SB.rocksdb(spark):
        rows = SB.encode_in_batches(spark.readStream.schema(docs.schema).parquet(sent), _lengths, lanes=8)
        running = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-state").trigger(
            processingTime="500 milliseconds").start()
    SB.run_until(running, wanted, lambda: {"given_out": SB.written(spark, out)}, timeout=600)
    found = spark.read.schema(SB.OUT).parquet(out)
    sound = (F.col("size") <= SB.SIZE) & ((F.col("reason") == SB.FULL) == (F.col("size") == SB.SIZE))
    return found.select("doc_id", F.get("embedding", F.lit(0)).cast("long").alias("n_chars"), sound.alias("sound"))
