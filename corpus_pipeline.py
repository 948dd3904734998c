"""The training-data pipeline: five stages over the documents, each stored and read again."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lexigrove.llm import bpe, decontaminate, pii, quality, simhash
from lexigrove.plans.runtime import scratch_path

#: Key of the surrogates; a real run takes its own.
PII_KEY = "corpus-pipeline"


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier fitted on them rejects go."""
    return quality.keep_good(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    return simhash.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item, verbatim or with other values, go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts become surrogates; ``n_chars`` follows the text where there is such a column."""
    out = pii.replace_entities(docs, PII_KEY, entities=None)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether decoding them gives the text back."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    decoded = bpe.round_trip(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id", "token_ids", F.size("token_ids").cast("long").alias("n_tokens"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


STAGES = [
    ("quality classifier", drop_low_quality),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("pii surrogates", replace_personal_data),
    ("byte-level bpe", encode_texts),
]

#: The first and the last stage have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each leaves is written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = scratch_path(spark, f"pipeline-{uuid.uuid4().hex[:8]}")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{base}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
