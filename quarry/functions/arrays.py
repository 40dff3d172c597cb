"""Dense-vector algebra on ``array<double>`` columns with higher-order functions.

Element-wise sums over many rows use ``pyspark.ml.stat.Summarizer`` (a partial aggregate, so
it combines map-side instead of collecting arrays into one task).
"""
from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_double_array(x) -> Column:
    return F.transform(_c(x), lambda v: v.cast("double"))


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(_c(a), F.lit(0.0), lambda acc, v: acc + v * v))


def cosine(a, b) -> Column:
    """Cosine similarity; a zero vector gives 0."""
    return F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))


def l2_normalize(a) -> Column:
    n = norm(a)
    return F.transform(_c(a), lambda v: F.coalesce(F.try_divide(v, n), F.lit(0.0)))


def scale(a, s) -> Column:
    return F.transform(_c(a), lambda v: v * s)


def add(a, b) -> Column:
    return F.zip_with(_c(a), _c(b), lambda x, y: x + y)


def array_mean(a) -> Column:
    return F.aggregate(_c(a), F.lit(0.0), lambda acc, v: acc + v) / F.size(_c(a))


def zscore(a) -> Column:
    """Population z-score of the values of one vector.  One pass gathers (n, sum, sum of squares)
    so no per-element expression re-evaluates an aggregate over the array."""
    s = F.aggregate(_c(a), F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("q")),
                    lambda acc, v: F.struct((acc["s"] + v).alias("s"), (acc["q"] + v * v).alias("q")))
    n = F.size(_c(a))
    return F.transform(_c(a), lambda v: F.try_divide(v - s["s"] / n, F.sqrt(F.greatest(
        s["q"] / n - (s["s"] / n) * (s["s"] / n), F.lit(0.0)))))


def vector_sum(col) -> Column:
    """Aggregate: element-wise sum of an ``array<double>`` column (use inside ``agg``)."""
    return vector_to_array(Summarizer.sum(array_to_vector(_c(col))))


def vector_mean(col) -> Column:
    """Aggregate: element-wise mean of an ``array<double>`` column (use inside ``agg``)."""
    return vector_to_array(Summarizer.mean(array_to_vector(_c(col))))
