"""Documents to token lists, n-grams and lemmas."""

from __future__ import annotations

from pyspark.ml.feature import NGram
from pyspark.sql import DataFrame, functions as F

from lexigrove.functions import text as X
from lexigrove.functions.constants import ENGLISH_STOP_WORDS
from lexigrove.plans.runtime import broadcast_if_small


def tokenize_documents(
    documents: DataFrame, *, text: str = "text", doc_id: str = "doc_id", clean: bool = False, keep: tuple = ()
) -> DataFrame:
    """``(doc_id, *keep, tokens)`` of the documents that have at least one token.

    ``clean`` runs ``clean_text`` first, which glues ``foo-bar`` to one word; the plain form
    works on the raw text. Blank documents fall out with the ones that have no token. The list is
    unpacked from a one-element array instead of filtered, because a filter on its size would
    evaluate the whole tokeniser a second time.
    """
    tokens = X.tokenize_clean(X.clean_text(text)) if clean else X.tokenize(text)
    packed = F.filter(F.array(F.coalesce(tokens, F.array().cast("array<string>"))), lambda t: F.size(t) > 0)
    unpacked = documents.select(doc_id, *keep, F.explode_outer(packed).alias("tokens"))
    return unpacked.filter(F.col("tokens").isNotNull())


def document_filter_counts(documents: DataFrame, *, text: str = "text") -> DataFrame:
    """One row: documents in all, blank ones, ones without a token, ones kept."""
    with_flags = documents.select(X.is_blank(text).alias("blank"), F.size(X.tokenize(text)).alias("n_tokens"))
    return with_flags.agg(
        F.count("*").alias("total"),
        F.count_if("blank").alias("blank"),
        F.count_if(~F.col("blank") & (F.coalesce("n_tokens", F.lit(0)) <= 0)).alias("without_tokens"),
        F.count_if(F.coalesce("n_tokens", F.lit(0)) > 0).alias("kept"),
    )


def ngram_counts(tokens: DataFrame, n: int = 2) -> DataFrame:
    """``(ngram, n)`` over the whole corpus; equal n-grams combine before the shuffle."""
    grams = NGram(n=n, inputCol="tokens", outputCol="ngrams").transform(tokens)
    rows = grams.select(F.explode_outer("ngrams").alias("ngram")).filter(F.col("ngram").isNotNull())
    return rows.groupBy("ngram").agg(F.count("*").alias("n"))


def lemmatize_documents(
    documents: DataFrame, lemmas: DataFrame, *, text: str = "text", doc_id: str = "doc_id",
    stop_words=ENGLISH_STOP_WORDS,
) -> DataFrame:
    """Advanced cleaning: letters only, no stop or short words, each form replaced by its lemma.

    ``lemmas`` is the caller's ``(form, lemma)`` table with one row per form. Texts are cleaned where they are read; the word
    lists that are left go to their document's partition before they are taken apart, so putting them together again
    needs no further shuffle where the lemma table is broadcast.
    """
    words = (
        documents.select(doc_id, F.split(X.clean_text(text), " ").alias("words"))
        .select(doc_id, X.without_stop_words(F.col("words"), stop_words).alias("words"))
        .repartition(doc_id)
    )
    placed = words.select(doc_id, F.posexplode_outer("words").alias("pos", "form"))
    joined = placed.join(broadcast_if_small(lemmas.select("form", "lemma"), 500_000), "form", "left")
    rebuilt = joined.groupBy(doc_id).agg(
        F.array_sort(
            F.collect_list(F.when(F.col("form").isNotNull(), F.struct("pos", F.coalesce("lemma", "form").alias("w"))))
        ).alias("parts")
    )
    return rebuilt.select(doc_id, F.array_join(F.transform("parts", lambda p: p["w"]), " ").alias("text"))


def head(documents: DataFrame, n: int, *, doc_id: str = "doc_id") -> DataFrame:
    """The first ``n`` documents by id, to try a smaller corpus."""
    return documents.orderBy(doc_id).limit(n)


def word_char_counts(documents: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    stripped = X.strip(text)
    return documents.select(
        doc_id, X.char_count(stripped).alias("char_count"), X.word_count(text).alias("word_count")
    )
