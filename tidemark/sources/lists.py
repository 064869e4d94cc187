"""Small inputs: entity lists, label overrides, feedback."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import SCALES
from tidemark.functions import identifiers as I
from tidemark.session import path_exists

logger = logging.getLogger(__name__)
OVERRIDE_SCHEMA = "cluster_id int, label string"
FEEDBACK_SCHEMA = "cluster_id int, verdict string, label string, given_at timestamp"


def read_cik_list(spark: SparkSession, path: str) -> DataFrame:
    """One key per line, zero-filled; blank lines and ``#`` comments are skipped."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"entity list not found: {path}")
    text = F.trim(F.regexp_replace("value", "#.*$", ""))
    lines = spark.read.text(path).select(text.alias("key"))
    return lines.where(F.col("key") != "").select(I.zero_fill(F.col("key")).alias("cik"))


def cik_list(
    spark: SparkSession, scale: str, path: str | None = None, sample_dir: str | None = None
) -> DataFrame:
    """Keys from a file, else from the scale preset, else from the sample file of the scale."""
    if path:
        return read_cik_list(spark, path)
    preset = SCALES[scale].ciks
    if preset:
        return spark.range(1).select(F.explode(F.array(*[F.lit(c) for c in preset])).alias("cik"))
    if sample_dir:
        return read_cik_list(spark, f"{sample_dir}/{scale}_ciks.txt")
    raise FileNotFoundError(f"no entity list for scale '{scale}'; pass a file")


def read_overrides(spark: SparkSession, path: str | None) -> DataFrame | None:
    """Manual labels from CSV; None (with a log line) when missing or without its columns."""
    if not path or not path_exists(spark, path):
        logger.warning("label overrides not found: %s", path)
        return None
    header = spark.read.option("header", True).csv(path)
    if not {"cluster_id", "label"} <= set(header.columns):
        logger.error("label overrides need cluster_id and label: %s", path)
        return None
    typed = header.select(F.col("cluster_id").try_cast("int").alias("cluster_id"), "label")
    return typed.where(F.col("cluster_id").isNotNull() & F.col("label").isNotNull())


def append_feedback(
    spark: SparkSession, path: str, cluster_id: int, verdict: str, label: str | None = None
) -> None:
    """Keep one review vote or suggested label."""
    row = spark.range(1).select(
        F.lit(cluster_id).alias("cluster_id"),
        F.lit(verdict).alias("verdict"),
        F.lit(label).cast("string").alias("label"),
        F.current_timestamp().alias("given_at"),
    )
    row.write.mode("append").parquet(path)


def feedback_overrides(spark: SparkSession, path: str) -> DataFrame:
    """Latest suggested label per theme, in the shape of the overrides."""
    votes = spark.read.schema(FEEDBACK_SCHEMA).parquet(path).where(F.col("label").isNotNull())
    return votes.groupBy("cluster_id").agg(F.max_by("label", "given_at").alias("label"))
