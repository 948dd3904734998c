"""Column expressions over vectors kept as arrays."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a: str | Column, b: str | Column) -> Column:
    """Inner product in double precision."""
    products = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def squared_l2(a: str | Column, b: str | Column) -> Column:
    """Squared Euclidean distance in double precision."""
    gaps = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") - y.cast("double"))
    return F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x * x)


def norm(a: str | Column) -> Column:
    return F.sqrt(F.aggregate(_col(a), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a: str | Column, b: str | Column) -> Column:
    """Cosine similarity; null where a vector is all zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def normalize(a: str | Column) -> Column:
    """The vector at unit length; null where it is all zero."""
    return F.transform(_col(a), lambda x: F.try_divide(x.cast("double"), norm(a)))


def to_ml(a: str | Column) -> Column:
    return array_to_vector(_col(a).cast("array<double>"))


def to_array(v: str | Column) -> Column:
    return vector_to_array(_col(v))
