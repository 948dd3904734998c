"""Readers and writers of the tables between stages. Parquet is the native form."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lexigrove.functions import text as X

DOCUMENTS_JSON = (
    "id long, file_name string, format string, text string, metadata map<string,string>, word_count int"
)
MEMBERS_PER_LINE = 10_000
CLUSTERS_JSON = (
    "clusters map<string, struct<cluster_id:int, label:string, size:int, document_indices:array<long>, "
    "top_terms:array<array<string>>, formats:map<string,long>, average_doc_length:double, "
    "representative_snippets:array<string>, centroid_norm:double, simple_label:string, percentage:double>>, "
    "silhouette_score double, total_documents long, num_clusters int"
)


def read_corpus_jsonl(spark: SparkSession, path: str, schema: str = "doc_id string, text string, word_count int, processing_time double") -> DataFrame:
    """One object per line; bad lines and blank texts are left out.

    Fields are read as strings and then cast, so a field of another type becomes null and its row stays.
    """
    fields = StructType.fromDDL(schema).fields
    loose = StructType([StructField(f.name, StringType()) for f in fields])
    rows = spark.read.schema(loose).option("mode", "DROPMALFORMED").json(path)
    cast = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fields]
    return rows.filter(~X.is_blank("text")).select(*cast)


#: What becomes of a line of a corpus.
KEPT, BLANK, BAD = "kept", "blank", "bad"


def read_corpus_with_rejects(
    spark: SparkSession, path: str, schema: str = "doc_id string, text string, word_count int, processing_time double"
) -> tuple[DataFrame, Observation]:
    """``read_corpus_jsonl`` and, once it has been read, how many lines were ``kept``, ``blank`` and ``bad``.

    The counts come from the pass that reads the rows: no second scan, nothing stored. ``observation.get`` waits for the first job
    over the rows; later jobs over them do not change it.
    """
    fields = StructType.fromDDL(schema).fields
    loose = StructType([*(StructField(f.name, StringType()) for f in fields), StructField("_bad_line", StringType())])
    rows = spark.read.schema(loose).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad_line").json(path)
    kind = F.when(F.col("_bad_line").isNotNull(), BAD).when(X.is_blank("text"), BLANK).otherwise(KEPT)
    seen = Observation()
    # kinds are counted before the filter, which can't move below the counters
    counted = rows.withColumn("_kind", kind).observe(seen, *(F.count_if(F.col("_kind") == k).alias(k) for k in (KEPT, BLANK, BAD)))
    cast = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fields]
    return counted.filter(F.col("_kind") == KEPT).select(*cast), seen


def read_documents_json(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of documents, as an import of files made elsewhere."""
    return spark.read.option("multiLine", True).schema(DOCUMENTS_JSON).json(path).withColumnRenamed("id", "doc_id")


def read_clusters_json(spark: SparkSession, path: str) -> DataFrame:
    """One row per cluster, with ``top_terms`` as structs."""
    rows = spark.read.option("multiLine", True).schema(CLUSTERS_JSON).json(path)
    opened = rows.select(F.explode("clusters").alias("key", "c")).select(
        F.col("key").cast("int").alias("cluster_id"), *[F.col(f"c.{n}").alias(n) for n in (
            "label", "simple_label", "size", "percentage", "document_indices", "top_terms", "formats",
            "average_doc_length", "representative_snippets", "centroid_norm")]
    )
    pairs = F.transform(
        "top_terms", lambda p: F.struct(F.get(p, 0).alias("term"), F.get(p, 1).cast("double").alias("weight"))
    )
    return opened.withColumn("top_terms", pairs)


def cluster_members(clusters: DataFrame) -> DataFrame:
    """``(doc_id, cluster_id)`` from clusters that list their documents."""
    return clusters.select(F.explode("document_indices").alias("doc_id"), "cluster_id")


def write_clusters_json(clusters: DataFrame, members: DataFrame, path: str, *, doc_id: str = "doc_id") -> None:
    """One object per cluster with the ids of its members, split over lines of ``MEMBERS_PER_LINE`` ids.

    A member list has no bound, so no cluster is one value: each line repeats the cluster and holds one part of the list.
    """
    part = F.pmod(F.xxhash64(doc_id), F.greatest(F.ceil(F.col("size") / MEMBERS_PER_LINE), F.lit(1)))
    placed = members.select(doc_id, "cluster_id").join(clusters.select("cluster_id", "size"), "cluster_id")
    lists = placed.withColumn("part", part).groupBy("cluster_id", "part").agg(F.sort_array(F.collect_list(doc_id)).alias("document_indices"))
    clusters.join(lists, "cluster_id", "left").write.mode("overwrite").json(path)


def write_corpus_jsonl(results: DataFrame, path: str, *, include_metadata: bool = True) -> None:
    """Successes only: all fields, or id, text, word count and time."""
    rows = results.filter("success")
    if not include_metadata:
        rows = rows.select(
            F.col("file_name").alias("doc_id"), "text", "word_count", F.col("extraction_time").alias("processing_time")
        )
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def structured_documents(results: DataFrame, *, keep: tuple = ()) -> DataFrame:
    """Parsed files with raw and cleaned text, and the columns ``keep``; ``word_count`` is that of the raw text."""
    return results.filter("success").select(
        "doc_id", "file_name", "format", F.col("text").alias("raw_text"), X.clean_text("text").alias("text"),
        F.coalesce("metadata", F.create_map().cast("map<string,string>")).alias("metadata"), "word_count", *keep,
    )


def write_table(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_store(store: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """Vectors partitioned by cluster.

    Rebalancing gathers a small cluster in one file and lets adaptive execution split a large
    one over many tasks.
    """
    store.hint("rebalance", "cluster_id").write.mode(mode).partitionBy("cluster_id").parquet(path)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """A saved vector store; a missing one raises."""
    return spark.read.parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def append_metrics(metrics: DataFrame, path: str) -> None:
    """Add a run's row to a metrics table."""
    metrics.write.mode("append").parquet(path)
