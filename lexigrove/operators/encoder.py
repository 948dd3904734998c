"""Embedding of documents and queries with one replaceable encoder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import HashingTF, IDF, Normalizer
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame, functions as F, types as T

from lexigrove.functions import text as X, vectors as V
from lexigrove.operators.tokens import tokenize_documents

DIMENSION = 384
BATCH_SIZE = 32

TextEncoder = Callable[[list[str]], np.ndarray]


def _with_tokens(texts: DataFrame, text: str) -> DataFrame:
    return texts.withColumn("tokens", X.tokenize(F.coalesce(text, F.lit(""))))


def fit_encoder(documents: DataFrame, *, text: str = "text", dimension: int = DIMENSION) -> PipelineModel:
    """Default encoder: hashed TF-IDF at unit length, fitted on the documents that have tokens.

    Save it with the store, because queries must be encoded with the same weights.
    """
    tokens = tokenize_documents(documents, text=text, doc_id=text).select("tokens")
    return Pipeline(
        stages=[
            HashingTF(inputCol="tokens", outputCol="_tf", numFeatures=dimension),
            IDF(inputCol="_tf", outputCol="_tfidf"),
            Normalizer(p=2.0, inputCol="_tfidf", outputCol="_unit"),
        ]
    ).fit(tokens)


def embed(
    texts: DataFrame, encoder: PipelineModel | TextEncoder, *, text: str = "text", batch_size: int = BATCH_SIZE
) -> DataFrame:
    """``texts`` with an ``embedding`` array instead of the text; works on streams too.

    A fitted pipeline runs in the JVM. A function from texts to a matrix is called per batch of
    ``batch_size`` texts in the Python workers; give it a model it can load once per worker.
    """
    kept = [c for c in texts.columns if c != text]
    if isinstance(encoder, PipelineModel):
        encoded = encoder.transform(_with_tokens(texts, text))
        return encoded.select(*kept, V.to_array("_unit").cast("array<float>").alias("embedding"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = [t or "" for t in part.column(text).to_pylist()]
            vectors = [np.asarray(encoder(texts[at : at + batch_size]), dtype=np.float32) for at in range(0, len(texts), batch_size)]
            widths = np.repeat([v.shape[1] for v in vectors], [len(v) for v in vectors]) if vectors else np.empty(0, np.int64)
            ends = pa.array(np.cumsum([0, *widths]).astype(np.int32))
            flat = pa.array(np.concatenate([np.empty(0, np.float32), *(v.ravel() for v in vectors)]))
            # the other columns are handed on as they came: as Python objects, structs and times would take most of the time
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.ListArray.from_arrays(ends, flat)], [*kept, "embedding"])

    fields = [f for f in texts.schema.fields if f.name != text]
    return texts.mapInArrow(run, T.StructType([*fields, T.StructField("embedding", T.ArrayType(T.FloatType()))]))


def embed_with_model(
    texts: DataFrame, load: Callable[[], TextEncoder], *, text: str = "text", batch_size: int = BATCH_SIZE
) -> DataFrame:
    """``embed`` for a model that is dear to load: ``load`` runs once in each Python worker and gives the function that encodes.

    Workers outlive tasks, so a table of many partitions loads the model as often as there are workers. A null text counts as empty.
    Columns other than the text are passed on and never reach Python; works on streams too.
    """

    def predictor() -> Callable[[np.ndarray], np.ndarray]:
        encode = load()
        return lambda batch: np.asarray(encode(["" if t is None else t for t in batch.tolist()]), dtype=np.float32)

    run = predict_batch_udf(predictor, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size)
    kept = [c for c in texts.columns if c not in (text, "embedding")]
    return texts.select(*kept, run(F.coalesce(text, F.lit(""))).alias("embedding"))


def embedding_rows(embeddings: DataFrame, doc_id: str) -> DataFrame:
    """Non-zero entries as ``(doc_id, dim, value)`` rows."""
    return embeddings.select(doc_id, F.posexplode_outer("embedding").alias("dim", "value")).filter(F.col("value") != 0)
