"""Dense vector expressions for single pairs; bulk scoring is in operators/scorers.py."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity in double precision; 0 when a vector has no length."""
    return F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))


def demote_duplicates(similarity: Column, threshold: float) -> Column:
    """Near-identical items get -1, so they rank last but remain."""
    return F.when(similarity > threshold, F.lit(-1.0)).otherwise(similarity)


def blend(similarity: Column, matches: Column, n_features: int, weight: float) -> Column:
    return weight * similarity + (1.0 - weight) * (matches / F.lit(n_features))
