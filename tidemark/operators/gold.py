"""Builders of the seven gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions import identifiers as I
from tidemark.functions.scoring import CHANGE_TYPES, clip, safe_ratio
from tidemark.operators.changes import attach_drift
from tidemark.operators.intensity import NOISE_CLUSTER, unique_labels

# Fixed value: year used for an entity without any intensity row.
UNKNOWN_YEAR = 1993


def companies_table(ciks: DataFrame, metadata: DataFrame, intensity: DataFrame) -> DataFrame:
    """Listed entities with their metadata and first and last year.

    Keys are padded on every side, so integer keys of a ticker list join as well.
    """
    S.assert_columns(ciks, ("cik",), "companies_table:ciks")
    known = {c: F.col(c) for c in ("ticker", "name", "sector") if c in metadata.columns}
    meta = metadata.select(I.pad_cik(F.col("cik")).alias("cik"), *known.values())
    years = intensity.groupBy(I.pad_cik(F.col("cik")).alias("cik")).agg(
        F.min("fiscal_year").alias("first_year"), F.max("fiscal_year").alias("last_year")
    )
    joined = (
        ciks.select(I.pad_cik(F.col("cik")).alias("cik"))
        .join(meta, "cik", "left")
        .join(years, "cik", "left")
    )
    for column in ("ticker", "name", "sector"):
        if column not in known:
            joined = joined.withColumn(column, F.lit(None).cast("string"))
    filled = joined.withColumns(
        {
            "name": F.coalesce("name", "cik"),
            "first_year": F.coalesce("first_year", F.lit(UNKNOWN_YEAR)),
            "last_year": F.coalesce("last_year", F.lit(UNKNOWN_YEAR)),
        }
    )
    return S.coerce(filled, S.COMPANIES)


def apply_overrides(themes: DataFrame, overrides: DataFrame) -> DataFrame:
    """Replace labels that have a manual override and flag them."""
    manual = unique_labels(overrides).withColumnRenamed("label", "_manual")
    joined = themes.drop("override_flag").join(manual, "cluster_id", "left")
    return joined.withColumns(
        {
            "label": F.coalesce("_manual", "label"),
            "override_flag": F.col("_manual").isNotNull(),
        }
    ).drop("_manual")


def themes_table(
    labels: DataFrame, intensity: DataFrame, overrides: DataFrame | None = None
) -> DataFrame:
    """Reach and years of every theme with its label; ``cluster_{id}`` when unlabelled."""
    reach = intensity.groupBy("cluster_id").agg(
        F.countDistinct("cik").alias("n_companies_ever"),
        F.min("fiscal_year").alias("first_seen_year"),
        F.max("fiscal_year").alias("last_seen_year"),
    )
    named = reach.join(unique_labels(labels), "cluster_id", "left").withColumn(
        "label",
        F.coalesce("label", F.concat(F.lit("cluster_"), F.col("cluster_id").cast("string"))),
    )
    if overrides is None:
        return S.coerce(named, S.THEMES)
    return S.coerce(apply_overrides(named, overrides), S.THEMES)


def theme_intensity_table(intensity: DataFrame) -> DataFrame:
    """Intensity clipped to [0, 1]; missing counts become 0."""
    count = (
        F.coalesce("chunk_count", F.lit(0)) if "chunk_count" in intensity.columns else F.lit(0)
    )
    clipped = intensity.withColumns(
        {"intensity": clip(F.col("intensity").cast("double")), "chunk_count": count}
    )
    return S.coerce(clipped, S.THEME_INTENSITY)


def theme_changes_table(changes: DataFrame, centroid_drift: DataFrame | None = None) -> DataFrame:
    """Changes with their drift; an unknown change type becomes ``stable``."""
    joined = attach_drift(changes, centroid_drift)
    kind = F.lit("stable")
    if "change_type" in joined.columns:
        kind = F.when(F.col("change_type").isin(*CHANGE_TYPES), F.col("change_type")).otherwise(kind)
    return S.coerce(joined.withColumn("change_type", kind), S.THEME_CHANGES)


def explanations_table(explanations: DataFrame) -> DataFrame:
    """Explanations in gold shape; a missing evidence list becomes an empty one."""
    S.assert_columns(explanations, S.EXPLANATIONS.column_names, "explanations_table")
    kind = explanations.schema["evidence_chunk_ids"].dataType
    ids = F.col("evidence_chunk_ids")
    listed = ids if kind.typeName() == "array" else F.array(ids.cast("string"))
    # A missing scalar gives an empty list too, not a list that holds a NULL.
    filled = F.when(ids.isNull(), F.array().cast("array<string>")).otherwise(listed)
    return S.coerce(explanations.withColumn("evidence_chunk_ids", filled), S.EXPLANATIONS)


def referenced_chunk_ids(explanations: DataFrame) -> DataFrame:
    return explanations.select(F.explode("evidence_chunk_ids").alias("chunk_id")).distinct()


def evidence_chunks_table(
    chunks: DataFrame, referenced: DataFrame, limit: int | None = None
) -> DataFrame:
    """Chunks that some explanation refers to: a left semi join on the id."""
    S.assert_columns(
        chunks, ("chunk_id", "cik", "fiscal_year", "cluster_id", "text"), "evidence_chunks_table"
    )
    kept = chunks.join(referenced.select("chunk_id"), "chunk_id", "left_semi")
    if "char_start_note" not in kept.columns:
        kept = kept.withColumn("char_start_note", F.lit(None).cast("string"))
    shaped = S.coerce(kept, S.EVIDENCE_CHUNKS)
    return shaped.orderBy("chunk_id").limit(limit) if limit is not None else shaped


def noise_by_year(chunks: DataFrame) -> DataFrame:
    """Chunks and noise share per version year: ``fiscal_year, total_chunks, noise_fraction``."""
    return chunks.groupBy("fiscal_year").agg(
        F.count(F.lit(1)).alias("total_chunks"),
        safe_ratio(F.count_if(F.col("cluster_id") == NOISE_CLUSTER), F.count(F.lit(1))).alias(
            "noise_fraction"
        ),
    )


def data_quality_table(extractions: DataFrame, clustering: DataFrame | None = None) -> DataFrame:
    """Extraction success per year, with chunk count and noise share where known."""
    year = F.col("fiscal_year").try_cast("long").alias("fiscal_year")
    if "success" in extractions.columns:
        ok = F.count_if(F.col("success").cast("boolean"))
        total = F.count("success")
    else:
        ok = total = F.count(F.lit(1))
    rate = safe_ratio(F.col("_ok"), F.col("total_filings"))
    if "success" not in extractions.columns:
        rate = F.lit(1.0)
    table = (
        extractions.groupBy(year)
        .agg(total.alias("total_filings"), ok.alias("_ok"))
        .withColumns(
            {
                "failed_extractions": F.col("total_filings") - F.col("_ok"),
                "extraction_success_rate": rate,
            }
        )
    )
    if clustering is None:
        table = table.withColumns({"noise_fraction": F.lit(0.0), "total_chunks": F.lit(0)})
    else:
        # The year may arrive as text; one cast covers both.
        known = clustering.select(
            F.col("fiscal_year").try_cast("long").alias("fiscal_year"),
            "noise_fraction",
            "total_chunks",
        )
        table = table.join(known, "fiscal_year", "left").withColumns(
            {
                "noise_fraction": F.coalesce("noise_fraction", F.lit(0.0)),
                "total_chunks": F.coalesce("total_chunks", F.lit(0)),
            }
        )
    return S.coerce(table, S.DATA_QUALITY)

