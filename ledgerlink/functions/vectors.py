"""Vector expressions on ``array<double>`` columns (JVM higher-order functions)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlink.functions.cols import c


def _as_col(x) -> Column:
    return c(x) if isinstance(x, str) else x


def as_double_vector(col) -> Column:
    """Vectors arrive as ``array<float>``; compute in double."""
    return _as_col(col).cast("array<double>")


def dot(a, b) -> Column:
    a, b = _as_col(a), _as_col(b)
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def norm(a) -> Column:
    a = _as_col(a)
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v * v))


def cosine(a, b) -> Column:
    """F16: cosine similarity; a zero-norm side gives 0 (as scikit-learn)."""
    na, nb = norm(a), norm(b)
    return F.when((na == 0) | (nb == 0), F.lit(0.0)).otherwise(dot(a, b) / (na * nb))


def sq_distance(a, b) -> Column:
    a, b = _as_col(a), _as_col(b)
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0),
                       lambda acc, v: acc + v)


def mean_vectors(df: DataFrame, vec: str, keys: list[str]) -> DataFrame:
    """Element-wise mean vector per key group (``keys`` may be empty), with the
    group size ``n``.

    ``Summarizer.mean`` keeps one running buffer per group and partition
    (partial aggregation of whole vectors), so rows are neither exploded into
    one row per dimension nor gathered per group: a group holding a third of
    all rows costs one buffer per map task.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    x = df.select(*keys, array_to_vector(as_double_vector(vec)).alias("_fv"))
    agg = x.groupBy(*keys).agg(Summarizer.mean(F.col("_fv")).alias("_m"), F.count(F.lit(1)).alias("n"))
    return agg.select(*keys, vector_to_array("_m").alias(vec), "n")
