"""Term frequencies, document frequencies and TF-IDF, exact and hashed."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import HashingTF, IDF
from pyspark.sql import Column, DataFrame, functions as F

from lexigrove.plans.runtime import materialize

NUM_FEATURES = 5000
DOCUMENT_MARK = ""


def place_tokens(tokens: DataFrame, *, doc_id: str = "doc_id", keep: tuple = ()) -> DataFrame:
    """``(doc_id, *keep, tokens)``: the sorted tokens of each document, moved to its partition.

    A token list is smaller than its rows of terms. The rows of a document become one, so that its terms are counted inside
    that row, and a task never holds a table of all terms of all its documents. Every use of the result in one plan
    reads the same exchange.
    """
    placed = tokens.select(doc_id, *keep, "tokens").repartition(doc_id)
    return placed.groupBy(doc_id, *keep).agg(F.sort_array(F.flatten(F.collect_list("tokens"))).alias("tokens"))


def _counted(placed: DataFrame, doc_id: str, keep: tuple) -> DataFrame:
    """``(doc_id, *keep, counts)`` with the distinct terms of the sorted tokens and how often each is there."""
    begins = F.filter(
        F.sequence(F.lit(0), F.size("tokens") - 1), lambda i: (i == 0) | ~F.get("tokens", i).eqNullSafe(F.get("tokens", i - 1)))
    found = placed.select(doc_id, *keep, "tokens", F.when(F.size("tokens") > 0, begins).alias("_begins"))
    until = lambda at: F.coalesce(F.get("_begins", at + 1), F.size("tokens"))
    counts = F.transform("_begins", lambda begin, at: F.struct(
        F.get("tokens", begin).alias("term"), (until(at) - begin).cast("long").alias("tf")))
    return found.select(doc_id, *keep, counts.alias("counts"))


def _rows(counted: DataFrame, doc_id: str, keep: tuple) -> DataFrame:
    # The outer form keeps the optimiser from filtering on the size of the list, which would build the list twice.
    rows = counted.select(doc_id, *keep, F.explode_outer("counts").alias("_e"))
    return rows.select(doc_id, *keep, F.col("_e.term").alias("term"), F.col("_e.tf").alias("tf")).filter(F.col("term").isNotNull())


def term_frequency(placed: DataFrame, *, doc_id: str = "doc_id", keep: tuple = ()) -> DataFrame:
    """``(doc_id, *keep, term, tf)`` of token lists from ``place_tokens``."""
    return _rows(_counted(placed, doc_id, keep), doc_id, keep)


def marked_term_frequency(placed: DataFrame, *, doc_id: str = "doc_id", keep: tuple = ()) -> DataFrame:
    """``term_frequency`` with one more row per document: the empty term, with a frequency of 0.

    Its document frequency is the number of documents, so one pass over the tokens gives both.
    """
    marker = F.array(F.struct(F.lit(DOCUMENT_MARK).alias("term"), F.lit(0).cast("long").alias("tf")))
    terms = F.filter("counts", lambda e: e["term"] != DOCUMENT_MARK)
    counted = _counted(placed, doc_id, keep)
    return _rows(counted.select(doc_id, *keep, F.concat(terms, marker).alias("counts")), doc_id, keep)


def marked_count(counts: DataFrame, column: str) -> Column:
    """The number of documents out of counts per term, as a scalar subquery."""
    return counts.agg(F.max(F.when(F.col("term") == DOCUMENT_MARK, F.col(column)))).scalar()


def document_frequency(tf: DataFrame) -> DataFrame:
    """``(term, df)``: in how many documents each term occurs."""
    return tf.groupBy("term").agg(F.count("*").alias("df"))


def idf(n_documents: Column, df: Column) -> Column:
    """Smoothed inverse document frequency; 0 for a term that every document has."""
    return F.ln((n_documents + F.lit(1.0)) / (df + F.lit(1)))


def tfidf(tokens: DataFrame, *, doc_id: str = "doc_id", max_terms: int | None = None) -> DataFrame:
    """``(doc_id, term, tf, df, tfidf)`` over the true vocabulary.

    ``max_terms`` keeps the vocabulary's most frequent terms only, as a bounded baseline does. The document frequencies are
    stored when called: the join then has a plain exchange on either side, and the rows of a term that every
    document has can be split over tasks.
    """
    tf = marked_term_frequency(place_tokens(tokens, doc_id=doc_id), doc_id=doc_id)
    totals = materialize(tf.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("total")))
    n_documents = marked_count(totals, "df")
    vocabulary = totals.select("term", "df")
    if max_terms is not None:
        vocabulary = totals.orderBy(F.desc("total"), "term").limit(max_terms).select("term", "df")
    return tf.filter(F.col("tf") > 0).join(vocabulary, "term").select(
        doc_id, "term", "tf", "df", (F.col("tf") * idf(n_documents, F.col("df"))).alias("tfidf")
    )


def require_corpus(tokens: DataFrame, minimum: int = 2) -> None:
    """Stop where fewer than ``minimum`` documents have tokens; looks at that many rows only."""
    found = len(tokens.select(F.lit(1)).limit(minimum).collect())
    if found == 0:
        raise ValueError("no documents with valid tokens")
    if found < minimum:
        raise ValueError(f"need at least {minimum} documents, found {found}")


def fit_hashed_tfidf(tokens: DataFrame, num_features: int = NUM_FEATURES) -> PipelineModel:
    """Fitted hashing and IDF stages; keep it, because queries must use the same weights."""
    hashing = HashingTF(inputCol="tokens", outputCol="raw_features", numFeatures=num_features)
    weights = IDF(inputCol="raw_features", outputCol="features")
    return Pipeline(stages=[hashing, weights]).fit(tokens)


def hashed_tfidf(
    tokens: DataFrame, model: PipelineModel | None = None, *, num_features: int = NUM_FEATURES, doc_id: str = "doc_id"
) -> DataFrame:
    """``(doc_id, features)`` with sparse vectors that are never made dense or collected."""
    model = model or fit_hashed_tfidf(tokens, num_features)
    return model.transform(tokens).select(doc_id, "features")


def feature_rows(features: DataFrame, *, doc_id: str = "doc_id", column: str = "features") -> DataFrame:
    """Vectors as ``(doc_id, feature, weight)`` rows of their non-zero entries."""
    parts = features.select(doc_id, F.unwrap_udt(column).alias("_v"))
    # a sparse vector lists its indices; a dense one has them by position
    at = F.coalesce(F.col("_v.indices"), F.sequence(F.lit(0), F.size("_v.values") - 1))
    pairs = parts.select(doc_id, F.explode_outer(F.arrays_zip(at.alias("feature"), F.col("_v.values").alias("weight"))).alias("_p"))
    return pairs.select(doc_id, F.col("_p")["feature"].alias("feature"), F.col("_p")["weight"].alias("weight")).filter(F.col("weight") != 0)


def feature_name(index: Column) -> Column:
    return F.concat(F.lit("feature_"), index.cast("string"))


def term_name(index: Column, term: Column) -> Column:
    """Vocabulary term of a feature index, or a stand-in where the vocabulary has none."""
    return F.coalesce(term, F.concat(F.lit("term_"), index.cast("string")))
