"""Vector arithmetic on ``array`` columns and vector means as aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# One sum per dimension keeps the aggregate inside generated code; above this many buffer
# fields Spark gives up on code generation and the ML summarizer is the better choice.
MAX_GENERATED_DIMENSIONS = 96


def dot(left: Column, right: Column) -> Column:
    return F.aggregate(
        F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double")),
        F.lit(0.0),
        lambda acc, value: acc + value,
    )


def norm(vector: Column) -> Column:
    squares = F.aggregate(
        vector.cast("array<double>"), F.lit(0.0), lambda acc, value: acc + value * value
    )
    return F.sqrt(squares)


def l2_normalize(vector: Column) -> Column:
    """Unit vector in double precision; a zero vector is returned unchanged."""
    # One-element arrays bind the length to a name, so it is computed once per row.
    divisor = F.transform(
        F.array(norm(vector)),
        lambda length: F.when(length == 0.0, F.lit(1.0)).otherwise(length),
    )
    values = vector.cast("array<double>")
    return F.flatten(F.transform(divisor, lambda d: F.transform(values, lambda v: v / d)))


def scale(vector: Column, factor: Column) -> Column:
    return F.transform(vector, lambda value: value * factor)


def cosine_distance(left: Column, right: Column) -> Column:
    """1 - cosine, clipped to [0, 2]; 1 when either side has no length."""
    lengths = norm(left) * norm(right)
    similarity = F.when(lengths == 0.0, F.lit(0.0)).otherwise(
        F.try_divide(dot(left, right), lengths)
    )
    distance = F.lit(1.0) - similarity
    return F.when(
        distance.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(2.0), distance))
    )


def vector_dimension(df: DataFrame, column: str) -> int:
    """Length of the first non-null vector (0 when there is none)."""
    row = df.where(F.col(column).isNotNull()).select(F.size(column).alias("n")).first()
    return int(row["n"]) if row else 0


def _per_dimension_sum(vector: Column, dimension: int) -> Column:
    return F.array(
        *[F.sum(F.get(vector, F.lit(i)).cast("double")) for i in range(dimension)]
    )


def _summarizer_sum(vector: Column, dimension: int) -> Column:
    zero = F.array_repeat(F.lit(0.0), dimension)
    filled = F.coalesce(vector.cast("array<double>"), zero)
    return vector_to_array(Summarizer.sum(array_to_vector(filled)))


def vector_sum(vector: Column, dimension: int) -> Column:
    """Element-wise sum as an aggregate with map-side partial sums."""
    if dimension <= MAX_GENERATED_DIMENSIONS:
        return _per_dimension_sum(vector, dimension)
    return _summarizer_sum(vector, dimension)


def vector_means(
    df: DataFrame, keys: Sequence[str], vectors: dict[str, Column], dimension: int
) -> DataFrame:
    """Mean of each vector per key group, with row and vector counts.

    Output: keys, ``n_rows``, ``n_vectors`` and one ``array<double>`` per entry of ``vectors``
    (NULL for a group without any vector). Only partial sums are shuffled, so a group that
    holds most of the rows costs one buffer per map task, not one huge task.
    """
    presence = next(iter(vectors.values()))
    counts = [F.count(F.lit(1)).alias("n_rows"), F.count(presence).alias("n_vectors")]
    generated = dimension * len(vectors) <= MAX_GENERATED_DIMENSIONS
    sums = [
        (_per_dimension_sum(vector, dimension) if generated else _summarizer_sum(vector, dimension))
        .alias(name)
        for name, vector in vectors.items()
    ]
    means = {
        name: F.when(
            F.col("n_vectors") > 0, F.transform(name, lambda value: value / F.col("n_vectors"))
        )
        for name in vectors
    }
    return df.groupBy(*keys).agg(*counts, *sums).withColumns(means)
