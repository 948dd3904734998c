"""Registered queries of the training-data operators, each over its whole table, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lexigrove.llm.oracles import LLM_ORACLES
from lexigrove.llm import bpe, collocations, decontaminate, divergence, fuzzyhash, langid, packing, pii, quality, shards, simhash, toxicity, urls

URL_RULES = [
    urls.Rule(urls.ALLOW, "org/"),
    urls.Rule(urls.BLOCK, "example.org/es/"),
    urls.Rule(urls.BLOCK, "example.org/en/1"),
    urls.Rule(urls.ALLOW, "com/fr/"),
    urls.Rule(urls.BLOCK, "com/de/"),
]
#: Key of the surrogates in the registered query; a real run takes its own.
PII_KEY = "registered-query"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Vocabulary of the packed sequences, and the id that ends a document.
PACKED, END = public_tokenizers.path("byte_bpe_50k.json"), 2


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _held_out() -> Column:
    """Documents from whose labels nothing is learned."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1


def op1_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes; equal texts share a shard."""
    placed = shards.kd_shards(_table(spark, sf_dir, "documents"), n_shards=16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items they contain, verbatim or with other values."""
    found = decontaminate.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "windows", "item_windows", "coverage", "slots_changed")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity and toxic spans, learned from the labels of two thirds."""
    docs = _table(spark, sf_dir, "documents")
    learnt = docs.filter(F.coalesce(~_held_out(), F.lit(False)))
    model = toxicity.fit(learnt, _table(spark, sf_dir, "labels"))
    tagged = toxicity.tag(docs, model)
    return tagged.select(
        "doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"), "spans",
    )


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learned from two thirds."""
    docs = _table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(F.coalesce(~_held_out(), F.lit(False))), RANKS)
    return langid.identify(docs, model).select(
        "doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of three-word shingles, linked within three bits."""
    return simhash.components(_table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded again; lengths and digests of both."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_fuzzy_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's fingerprint, and its likeness to an edit of it and to the next document."""
    return fuzzyhash.compare_edited(_table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weak label, score and decision."""
    return quality.score_documents(_table(spark, sf_dir, "documents"))


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, rule and verdict."""
    return urls.judge(_table(spark, sf_dir, "pages"), URL_RULES)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with surrogates in place of personal data, and where they stand."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace_entities(docs, PII_KEY).withColumn("n_entities", F.size("entities").cast("long"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source against each other source of its language, and the terms it uses more than the language does."""
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2,000 phrases of two to four words."""
    return collocations.mine(_table(spark, sf_dir, "documents"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of 1,024 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), PACKED, END)


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_shards": op1_shards,
    "op2_decontaminate": op2_decontaminate,
    "op3_toxicity": op3_toxicity,
    "op4_langid": op4_langid,
    "op5_simhash": op5_simhash,
    "op6_bpe": op6_bpe,
    "op7_fuzzy_hash": op7_fuzzy_hash,
    "op8_quality": op8_quality,
    "op9_urls": op9_urls,
    "op10_pii": op10_pii,
    "op11_source_divergence": op11_source_divergence,
    "op12_collocations": op12_collocations,
    "op13_packing": op13_packing,
}

__all__ = ["LLM_ORACLES", "LLM_QUERIES"]
