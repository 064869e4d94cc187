"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_SALTS = 16
#: A looked-up table of at most so many rows is broadcast.
BROADCAST_ROWS = 100_000


def salted_join(
    big: DataFrame,
    small: DataFrame,
    keys: list[str],
    spread_by: str | Column,
    salts: int = DEFAULT_SALTS,
    how: str = "inner",
) -> DataFrame:
    """Equi-join on ``keys`` plus a salt.

    ``small`` (one row per key) is repeated once per salt; ``big`` is spread over the salts by
    a hash of ``spread_by``, which is stable when a task is run again. A hot key is split into
    ``salts`` parts, and a following aggregation on ``keys`` combines before it shuffles.
    """
    salted_big = big.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_big.join(repeated, [*keys, "_salt"], how).drop("_salt")


def broadcast_if_few(small: DataFrame) -> DataFrame:
    """A table such as the themes with a broadcast hint once its rows are counted and few."""
    return F.broadcast(small) if small.count() <= BROADCAST_ROWS else small


def lookup_join(
    big: DataFrame, small: DataFrame, keys: list[str], spread_by: list[str], how: str = "inner"
) -> DataFrame:
    """Join with a table of one row per key, such as themes: broadcast once its rows are counted and
    few, so that the big side is not shuffled on few values; salted otherwise.

    ``small`` should be cheap to count: a stored, checkpointed or aggregated table.
    """
    if small.count() <= BROADCAST_ROWS:
        return big.join(F.broadcast(small), keys, how)
    return salted_join(big, small, keys, spread_by[0] if len(spread_by) == 1 else F.struct(*spread_by), how=how)
