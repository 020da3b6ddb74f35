"""Vector expressions over array columns, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quadrivium.functions.text import _col


def dot(a: Column | str, b: Column | str) -> Column:
    pairs = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity; 0 where either vector is zero."""
    size = norm(a) * norm(b)
    return F.when(size > 0, dot(a, b) / size).otherwise(F.lit(0.0))


def euclidean(a: Column | str, b: Column | str) -> Column:
    squares = F.zip_with(
        _col(a), _col(b), lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))
    )
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x))


def has_dim(vector: Column | str, dim: int) -> Column:
    return F.size(_col(vector)) == dim
