"""Numeric scores used by the change and quality operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Change classes and the symmetric delta threshold that separates them.
CHANGE_TYPES = ("new", "intensifying", "fading", "disappeared", "stable")
DELTA_THRESHOLD = 0.02
# Explanation wording thresholds.
DIRECTION_THRESHOLD = 0.05
DRIFT_LOW = 0.15
DRIFT_HIGH = 0.35
# Significance level and permutation count of the drift test.
SIGNIFICANCE_LEVEL = 0.05
PERMUTATIONS = 60


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` as double; 0 when the denominator is 0 or NULL."""
    return F.coalesce(
        F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0)
    )


def materiality(delta: Column, chunk_count: Column) -> Column:
    """Absolute intensity change weighted by the log of the evidence volume."""
    return F.abs(delta) * F.log1p(chunk_count.cast("double"))


def _absent(value: Column) -> Column:
    # isnan goes first: Spark orders NaN above every number, so a bare comparison would match.
    return value.isNull() | F.isnan(value) | (value == 0.0)


def change_type(
    previous: Column,
    current: Column,
    delta: Column,
    intensifying: float = DELTA_THRESHOLD,
    fading: float = -DELTA_THRESHOLD,
) -> Column:
    """Class of a change between two consecutive intensities (strict thresholds)."""
    known_delta = delta.isNotNull() & ~F.isnan(delta)
    return (
        F.when(_absent(previous), F.lit("new"))
        .when(_absent(current), F.lit("disappeared"))
        .when(known_delta & (delta > intensifying), F.lit("intensifying"))
        .when(known_delta & (delta < fading), F.lit("fading"))
        .otherwise(F.lit("stable"))
    )


def clip(value: Column, low: float = 0.0, high: float = 1.0) -> Column:
    """Clamp to ``[low, high]``; NULL stays NULL."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def approximate_intensity(delta: Column, sign: int) -> Column:
    """Stand-in intensity around one half when only the delta is known (sign +1 now, -1 before)."""
    return clip(F.lit(0.5) + F.lit(float(sign)) * delta / 2.0)


def kept_and_noise_counts(total: Column, noise_fraction: Column) -> tuple[Column, Column]:
    """Truncated counts of clustered and of noise chunks behind a noise share."""
    return (
        (total * (F.lit(1.0) - noise_fraction)).cast("long"),
        (total * noise_fraction).cast("long"),
    )


def per_unit(total: Column, units: Column, digits: int = 1) -> Column:
    """Rounded average, NULL when there are no units."""
    return F.round(F.try_divide(total.cast("double"), units.cast("double")), digits)
