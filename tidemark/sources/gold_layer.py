"""Gold tables on disk: validated Snappy Parquet, sizes, orchestration.

A table is a folder of versions, each a Parquet folder that is never changed, and numbered pointers
that name the version to read. Publishing writes a version, then the next pointer in one step; readers
take the highest pointer and so always see one whole version.
"""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark import schemas as S
from tidemark.operators import gold as G
from tidemark.session import folder_bytes, hadoop_path, path_exists

logger = logging.getLogger(__name__)

MEGABYTE = 1024 * 1024
SIZE_WARNING_MB = 20.0  # fixed value: tables above this size are reported
#: Where a table keeps its pointers, and how many versions stay.
POINTERS = "_pointers"
KEPT_VERSIONS = 3


def table_folder(gold_dir: str, name: str) -> str:
    return f"{gold_dir.rstrip('/')}/{name}"


def _pointers(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    """Numbers and versions of the pointers of a table, oldest first: files ``<number>--<version>``."""
    target, files = hadoop_path(spark, f"{folder}/{POINTERS}")
    if not files.exists(target):
        return []
    names = [status.getPath().getName() for status in files.listStatus(target)]
    return sorted((int(n), v) for n, _, v in (x.partition("--") for x in names) if n.isdigit() and v)


def table_path(spark: SparkSession, gold_dir: str, name: str) -> str:
    """The Parquet folder of the current version; a path without files when there is none."""
    folder = table_folder(gold_dir, name)
    found = _pointers(spark, folder)
    return f"{folder}/{found[-1][1] if found else 'none'}"


def table_exists(spark: SparkSession, gold_dir: str, name: str) -> bool:
    return bool(_pointers(spark, table_folder(gold_dir, name)))


def read_table(spark: SparkSession, gold_dir: str, name: str) -> DataFrame:
    """The current version of a gold table with its declared schema, so no file is opened to infer one.
    A frame keeps the version that it began with."""
    return spark.read.schema(S.GOLD_TABLES[name].schema).parquet(table_path(spark, gold_dir, name))


def write_table(
    df: DataFrame, gold_dir: str, name: str, partition_by: list[str] | None = None
) -> str:
    """Write a version while the declared checks count violations, then publish it; returns its path.

    The plan runs once. With violations, or when the write fails, nothing is published, the version goes
    and the table stays as it was. The last ``KEPT_VERSIONS`` versions stay for readers that have begun.
    """
    spark = df.sparkSession
    frame, check = S.observed(df, S.GOLD_TABLES[name])
    folder = table_folder(gold_dir, name)
    version = f"version-{uuid.uuid4().hex}"
    target, files = hadoop_path(spark, f"{folder}/{version}")
    writer = frame.write.option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.parquet(target.toString())
        check()
    except BaseException:
        files.delete(target, True)
        raise
    _publish(spark, folder, version)
    return target.toString()


def _publish(spark: SparkSession, folder: str, version: str) -> None:
    """Create the next pointer. An empty file is created whole or not at all on every store; of two
    writers with the same number the one with the larger version name is read."""
    known = _pointers(spark, folder)
    number = known[-1][0] + 1 if known else 1
    pointer, files = hadoop_path(spark, f"{folder}/{POINTERS}/{number:010d}--{version}")
    files.create(pointer, False).close()
    for old, gone in _pointers(spark, folder)[:-KEPT_VERSIONS]:
        for path in (f"{POINTERS}/{old:010d}--{gone}", gone):
            files.delete(hadoop_path(spark, f"{folder}/{path}")[0], True)


def check_sizes(spark: SparkSession, paths: dict[str, str]) -> dict[str, float]:
    """Size in MB per table, 0.0 when missing; large tables are logged."""
    sizes: dict[str, float] = {}
    for name, path in paths.items():
        if not path_exists(spark, path):
            logger.warning("table '%s' not found at %s", name, path)
            sizes[name] = 0.0
            continue
        sizes[name] = folder_bytes(spark, path) / MEGABYTE
        if sizes[name] > SIZE_WARNING_MB:
            logger.warning("table '%s' has %.1f MB", name, sizes[name])
    return sizes


def save_labels(labels: DataFrame, path: str) -> None:
    labels.select("cluster_id", "label").orderBy("cluster_id").write.mode("overwrite").parquet(path)


def load_labels(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no labels at {path}")
    return spark.read.schema("cluster_id int, label string").parquet(path)


def build_all(
    gold_dir: str,
    *,
    ciks: DataFrame,
    metadata: DataFrame,
    intensity: DataFrame,
    labels: DataFrame,
    changes: DataFrame,
    centroid_drift: DataFrame | None,
    explanations: DataFrame,
    chunks: DataFrame,
    extractions: DataFrame,
    clustering: DataFrame | None,
    overrides: DataFrame | None = None,
    max_evidence_chunks: int | None = None,
) -> dict[str, str]:
    """Write the seven tables in dependency order; evidence has no limit unless one is given.

    Evidence reads the explanations back from disk, so they are not computed a second time.
    """
    spark = intensity.sparkSession
    paths = {
        "companies": write_table(
            G.companies_table(ciks, metadata, intensity), gold_dir, "companies"
        ),
        "themes": write_table(
            G.themes_table(labels, intensity, overrides), gold_dir, "themes"
        ),
        "theme_intensity": write_table(
            G.theme_intensity_table(intensity), gold_dir, "theme_intensity"
        ),
        "theme_changes": write_table(
            G.theme_changes_table(changes, centroid_drift), gold_dir, "theme_changes"
        ),
        "explanations": write_table(
            G.explanations_table(explanations), gold_dir, "explanations"
        ),
    }
    referenced = G.referenced_chunk_ids(read_table(spark, gold_dir, "explanations"))
    paths["evidence_chunks"] = write_table(
        G.evidence_chunks_table(chunks, referenced, max_evidence_chunks),
        gold_dir,
        "evidence_chunks",
    )
    paths["data_quality"] = write_table(
        G.data_quality_table(extractions, clustering), gold_dir, "data_quality"
    )
    return paths
