"""Theme intensity: the share of a version's clustered chunks that belong to one theme."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scoring import safe_ratio
from tidemark.schemas import INTENSITY_COLUMNS, assert_columns

NOISE_CLUSTER = -1  # fixed value: label of chunks that belong to no theme
UNLABELLED = "unknown"  # fixed value: label of a theme missing from the label table
GROUP = ("cik", "fiscal_year", "cluster_id")


def drop_noise(chunks: DataFrame) -> DataFrame:
    """Clustered chunks only; rows without a complete group key never form a group."""
    return chunks.where(F.col("cluster_id") != NOISE_CLUSTER).dropna(subset=list(GROUP))


def count_chunks(chunks: DataFrame) -> DataFrame:
    """Chunks per (entity, version, theme); only partial counts are shuffled."""
    return drop_noise(chunks).groupBy(*GROUP).agg(F.count("chunk_id").alias("chunk_count"))


def unique_labels(labels: DataFrame) -> DataFrame:
    """One label per theme; of several, the alphabetically first, on every run."""
    return labels.groupBy("cluster_id").agg(F.min("label").alias("label"))


def attach_labels(frame: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Left join of the label table (``cluster_id``, ``label``); missing labels are named."""
    if labels is None:
        return frame.withColumn("cluster_label", F.lit(UNLABELLED))
    lookup = unique_labels(labels).withColumnRenamed("label", "cluster_label")
    joined = frame.join(lookup, "cluster_id", "left")
    return joined.withColumn("cluster_label", F.coalesce("cluster_label", F.lit(UNLABELLED)))


def compute_intensity(chunks: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Intensity per (entity, version, theme).

    The denominator is a window sum over the already counted groups, so the raw chunks are
    read and shuffled once and no self join is needed.
    """
    assert_columns(
        chunks,
        ("chunk_id", "cik", "fiscal_year", "accession_number", "cluster_id"),
        "compute_intensity",
    )
    return intensity_of_counts(count_chunks(chunks), labels)


def intensity_of_counts(counts: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Intensity from chunk counts per (entity, version, theme)."""
    version = Window.partitionBy("cik", "fiscal_year")
    counted = counts.withColumn("total_chunks", F.sum("chunk_count").over(version))
    scored = counted.withColumn(
        "intensity", safe_ratio(F.col("chunk_count"), F.col("total_chunks"))
    ).withColumn("is_present", F.col("intensity") > 0.0)
    return attach_labels(scored, labels).select(*INTENSITY_COLUMNS)


def sorted_intensity(intensity: DataFrame) -> DataFrame:
    """Presentation order (a range-partitioned sort; skip it inside longer plans)."""
    return intensity.orderBy("cik", "fiscal_year", "cluster_id")


def presence_matrix(
    intensity: DataFrame, versions: list[str] | None = None
) -> DataFrame:
    """Wide theme x (entity, version) matrix of summed intensity, 0.0 where absent.

    ``versions`` are the column keys ``{cik}_{year}``. Without them the distinct keys are read
    first; past Spark's pivot limit (``spark.sql.pivotMaxValues``) use :func:`presence_long`.
    """
    assert_columns(intensity, (*GROUP, "intensity"), "presence_matrix")
    keyed = intensity.withColumn("version_key", F.concat_ws("_", "cik", "fiscal_year"))
    grouped = keyed.groupBy("cluster_id")
    pivoted = (
        grouped.pivot("version_key", versions) if versions else grouped.pivot("version_key")
    )
    return pivoted.agg(F.sum("intensity")).na.fill(0.0)


def presence_long(intensity: DataFrame) -> DataFrame:
    """The same matrix in long form, non-zero cells only; no limit on versions."""
    assert_columns(intensity, (*GROUP, "intensity"), "presence_long")
    return intensity.groupBy(*GROUP).agg(F.sum("intensity").alias("intensity"))


def densify_disappearances(intensity: DataFrame) -> DataFrame:
    """Add a zero row for the version after a theme's run ends, if the entity has that version.

    The plain computation never emits zero rows, so a vanished theme leaves no row to classify;
    with these rows it is classified as ``disappeared``.
    """
    theme = Window.partitionBy("cik", "cluster_id").orderBy("fiscal_year")
    ended = intensity.withColumn("next_year", F.lead("fiscal_year").over(theme)).where(
        F.col("next_year").isNull() | (F.col("next_year") > F.col("fiscal_year") + 1)
    )
    totals = intensity.groupBy("cik", "fiscal_year").agg(
        F.max("total_chunks").alias("total_chunks")
    )
    zeros = (
        ended.select(
            "cik",
            (F.col("fiscal_year") + 1).alias("fiscal_year"),
            "cluster_id",
            "cluster_label",
            F.lit(0).cast("long").alias("chunk_count"),
        )
        .join(totals, ["cik", "fiscal_year"])
        .withColumns({"intensity": F.lit(0.0), "is_present": F.lit(False)})
    )
    return intensity.unionByName(zeros.select(*intensity.columns))
