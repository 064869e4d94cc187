"""SQL over the gold tables: view registration, free queries and the preset queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.skew import broadcast_if_few
from tidemark.schemas import GOLD_TABLES

# The preset reports; their column names, threshold, label patterns and row limit are fixed.
PRESETS = {
    "top-drift": """
        SELECT label AS theme, fiscal_year, count(DISTINCT cik) AS entities_affected,
               round(avg(materiality_score), 4) AS avg_materiality,
               round(avg(centroid_drift), 4) AS avg_centroid_drift
        FROM theme_changes INNER JOIN themes USING (cluster_id)
        GROUP BY ALL
        ORDER BY avg_materiality DESC, theme, fiscal_year
        LIMIT 12""",
    "emerging-ai": """
        SELECT ticker, name, fiscal_year, intensity_delta, materiality_score
        FROM theme_changes
        INNER JOIN themes USING (cluster_id)
        INNER JOIN companies USING (cik)
        WHERE change_type IN ('new', 'intensifying')
          AND label LIKE ANY ('%AI%', '%Foundry%', '%Packaging%')
        ORDER BY materiality_score DESC""",
    "centroid-divergence": """
        SELECT ticker, label AS theme, fiscal_year, centroid_drift, materiality_score
        FROM theme_changes
        INNER JOIN themes USING (cluster_id)
        INNER JOIN companies USING (cik)
        WHERE centroid_drift > 0.65
        ORDER BY centroid_drift DESC""",
    "sector-distribution": """
        SELECT sector, count(DISTINCT cluster_id) AS unique_themes_flagged,
               round(avg(materiality_score), 4) AS mean_sector_materiality
        FROM theme_changes INNER JOIN companies USING (cik)
        GROUP BY sector
        ORDER BY mean_sector_materiality DESC""",
}


def register_frames(**tables: DataFrame) -> None:
    """Temp views; the themes are broadcast when they are few, so that no change table is shuffled on
    their handful of keys."""
    for name, frame in tables.items():
        (broadcast_if_few(frame) if name == "themes" else frame).createOrReplaceTempView(name)


def register_gold(spark: SparkSession, gold_dir: str) -> list[str]:
    """Temp views over the gold tables that exist under ``gold_dir``; returns their names."""
    from tidemark.sources.gold_layer import read_table, table_exists

    found = [name for name in GOLD_TABLES if table_exists(spark, gold_dir, name)]
    register_frames(**{name: read_table(spark, gold_dir, name) for name in found})
    return found


def run_sql(spark: SparkSession, sql: str) -> DataFrame:
    """Any query over the registered views; errors and empty results are shown as they are."""
    return spark.sql(sql)


def run_preset(spark: SparkSession, name: str) -> DataFrame:
    return run_sql(spark, PRESETS[name])
