"""Year-over-year change, classification, materiality ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scoring import change_type, materiality, safe_ratio
from tidemark.schemas import assert_columns
from tidemark.session import cut_lineage

CHANGE_KEY = ("cik", "cluster_id", "fiscal_year")
DEFAULT_TOP = 500  # fixed value: how many ranked changes are explained
TIE_DIGITS = 12


def with_defaults(intensity: DataFrame) -> DataFrame:
    """Accept ``year`` for ``fiscal_year`` and derive a missing intensity from its counts."""
    frame = intensity
    if "fiscal_year" not in frame.columns and "year" in frame.columns:
        frame = frame.withColumn("fiscal_year", F.col("year"))
    if "intensity" not in frame.columns and {"chunk_count", "total_chunks"} <= set(frame.columns):
        frame = frame.withColumn(
            "intensity", safe_ratio(F.col("chunk_count"), F.col("total_chunks"))
        )
    if "chunk_count" not in frame.columns:
        frame = frame.withColumn("chunk_count", F.lit(0).cast("long"))
    return frame


def compute_yoy_changes(intensity: DataFrame) -> DataFrame:
    """Change of every intensity row against the row one year earlier.

    A gap counts as a previous intensity of 0, so a theme that returns is ``new`` again; the
    first row of a theme is always ``new``. One window over (entity, theme), whose partitions
    hold at most one row per version.
    """
    frame = with_defaults(intensity)
    assert_columns(frame, (*CHANGE_KEY, "intensity"), "compute_yoy_changes")
    history = Window.partitionBy("cik", "cluster_id").orderBy("fiscal_year")
    before = F.lag(F.struct("fiscal_year", "intensity")).over(history)
    current = F.col("intensity")
    paired = frame.select(
        F.col("cik").cast("string").alias("cik"),
        F.col("cluster_id"),
        F.col("fiscal_year"),
        current.cast("double").alias("intensity"),
        F.coalesce(F.col("chunk_count"), F.lit(0)).cast("long").alias("chunk_count"),
        before.alias("before"),
    )
    adjacent = F.col("before.fiscal_year") == F.col("fiscal_year") - 1
    scored = (
        paired.withColumn(
            "prev_intensity",
            F.when(adjacent, F.col("before.intensity")).otherwise(F.lit(0.0)),
        )
        .withColumn("intensity_delta", F.col("intensity") - F.col("prev_intensity"))
        .withColumn(
            "materiality_score", materiality(F.col("intensity_delta"), F.col("chunk_count"))
        )
    )
    first = F.col("before").isNull()
    appeared = first | ((F.col("prev_intensity") == 0.0) & (F.col("intensity") > 0.0))
    vanished = ~first & (F.col("intensity") == 0.0) & (F.col("prev_intensity") > 0.0)
    # Zero to zero after the first row is no appearance: it is compared by its delta alone.
    still_absent = ~first & (F.col("prev_intensity") == 0.0) & (F.col("intensity") == 0.0)
    return scored.select(
        "cik",
        "cluster_id",
        "fiscal_year",
        F.col("fiscal_year").alias("year"),
        "intensity",
        "prev_intensity",
        "intensity_delta",
        F.col("intensity_delta").alias("delta"),
        "chunk_count",
        "materiality_score",
        F.col("materiality_score").alias("materiality"),
        F.when(first, F.lit("new"))
        .when(still_absent, F.lit("stable"))
        .otherwise(
            change_type(F.col("prev_intensity"), F.col("intensity"), F.col("intensity_delta"))
        )
        .alias("change_type"),
        appeared.alias("first_appearance"),
        vanished.alias("disappeared"),
    )


def attach_drift(changes: DataFrame, centroid_drift: DataFrame | None) -> DataFrame:
    """Left join of centroid drift on the change key; NULL where there is none."""
    if centroid_drift is None:
        if "centroid_drift" in changes.columns:
            return changes
        return changes.withColumn("centroid_drift", F.lit(None).cast("double"))
    drift = centroid_drift.select(*CHANGE_KEY, "centroid_drift")
    return changes.drop("centroid_drift").join(drift, list(CHANGE_KEY), "left")


def _by_materiality():
    # Scores equal up to floating-point noise are ties; the key columns then make the order
    # total, so ranks are the same on every run and on every engine.
    score = F.round("materiality_score", TIE_DIGITS)
    return [score.desc_nulls_last(), *[F.col(c).asc() for c in CHANGE_KEY]]


def rank_changes(changes: DataFrame, centroid_drift: DataFrame | None = None) -> DataFrame:
    """Rank 1..N over all changes, materiality first, without a single-task window.

    The rows are range-sorted once and checkpointed together with their partition and their
    position in it; the rank is that position plus the number of rows in earlier partitions.
    Ties never pile up in one task because the key columns are part of the sort order.
    """
    ordered = cut_lineage(
        attach_drift(changes, centroid_drift)
        .orderBy(*_by_materiality())
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    partition = F.shiftright("_slot", 33)
    placed = ordered.withColumn("_part", partition)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition of the sort: small whatever the data size.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")
    )
    position = F.col("_slot") - F.shiftleft(F.col("_part"), 33)
    return (
        placed.join(offsets, "_part")
        .withColumn("rank", F.col("_offset") + position + 1)
        .drop("_part", "_slot", "_offset")
    )


def get_top_changes(ranked: DataFrame, n: int = DEFAULT_TOP) -> DataFrame:
    """The first ``n`` ranks; a filter, since the rank is already there."""
    return ranked.where(F.col("rank") <= n)


def top_changes(
    changes: DataFrame, centroid_drift: DataFrame | None = None, n: int = DEFAULT_TOP
) -> DataFrame:
    """Rank only the ``n`` most material changes.

    Top-n first (each task keeps n rows), then the offsets rank over those n rows; the drift
    join therefore sees n rows too. Prefer this to ranking everything when only the top is read.
    """
    best = changes.orderBy(*_by_materiality()).limit(n)
    ranked = rank_changes(best.drop("centroid_drift") if centroid_drift is not None else best)
    return attach_drift(ranked, centroid_drift)
