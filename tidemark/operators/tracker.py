"""Questions over the intensity and change tables: timelines, trajectories, prevalence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import assert_columns

# An emerging theme needs this many entities; classes of a fading theme.
MIN_EMERGING_COMPANIES = 3
FADING_TYPES = ("disappeared", "fading")


def company_timeline(intensity: DataFrame, cik: str) -> DataFrame:
    return intensity.where(F.col("cik") == cik).orderBy("fiscal_year", "cluster_id")


def theme_trajectory(intensity: DataFrame, cluster_id: int, cik: str | None = None) -> DataFrame:
    rows = intensity.where(F.col("cluster_id") == cluster_id)
    if cik is not None:
        rows = rows.where(F.col("cik") == cik)
    return rows.orderBy("cik", "fiscal_year")


def emerging_themes(
    intensity: DataFrame,
    changes: DataFrame,
    year: int,
    min_companies: int = MIN_EMERGING_COMPANIES,
) -> DataFrame:
    """Themes that first appear in ``year`` at ``min_companies`` or more entities."""
    qualifying = (
        changes.where((F.col("fiscal_year") == year) & F.col("first_appearance"))
        .groupBy("cluster_id")
        .agg(F.countDistinct("cik").alias("company_count"))
        .where(F.col("company_count") >= min_companies)
    )
    statistics = (
        intensity.where(F.col("fiscal_year") == year)
        .groupBy("cluster_id")
        .agg(
            F.avg("intensity").alias("mean_intensity"),
            F.sum("chunk_count").alias("total_chunk_count"),
            F.min("cluster_label").alias("cluster_label"),
        )
    )
    return (
        qualifying.join(statistics, "cluster_id", "left")
        .select(
            "cluster_id", "cluster_label", "company_count", "mean_intensity", "total_chunk_count"
        )
        .orderBy(F.desc("company_count"), "cluster_id")
    )


def one_label_per_theme(themes: DataFrame) -> DataFrame:
    """Keep one row per theme; with several, the alphabetically first label wins."""
    assert_columns(themes, ("cluster_id", "cluster_label"), "one_label_per_theme")
    others = [c for c in themes.columns if c not in ("cluster_id", "cluster_label")]
    first = F.min(F.struct("cluster_label", *others)).alias("row")
    return themes.groupBy("cluster_id").agg(first).select("cluster_id", "row.*")


def fading_themes(changes: DataFrame, themes: DataFrame, year: int) -> DataFrame:
    """Fading or vanished themes of a year, most material first, labelled when needed."""
    rows = changes.where(
        (F.col("fiscal_year") == year) & F.col("change_type").isin(*FADING_TYPES)
    )
    if "cluster_label" not in rows.columns:
        labels = one_label_per_theme(themes.select("cluster_id", "cluster_label"))
        rows = rows.join(labels, "cluster_id", "left")
    return rows.orderBy(F.desc_nulls_last("materiality_score"), "cik", "cluster_id")


def peak_years(intensity: DataFrame) -> DataFrame:
    """Year with the highest mean intensity per theme, the earliest on a tie."""
    yearly = (
        intensity.where("is_present")
        .groupBy("cluster_id", "fiscal_year")
        .agg(F.avg("intensity").alias("year_mean"))
    )
    best = F.max_by("fiscal_year", F.struct("year_mean", -F.col("fiscal_year")))
    return yearly.groupBy("cluster_id").agg(best.alias("peak_intensity_year"))


def theme_prevalence(intensity: DataFrame, themes: DataFrame) -> DataFrame:
    """One row per theme: reach, first and last year, peak year, mean intensity, metadata."""
    reach = (
        intensity.where("is_present")
        .groupBy("cluster_id")
        .agg(
            F.countDistinct("cik").alias("unique_companies"),
            F.min("fiscal_year").alias("first_year"),
            F.max("fiscal_year").alias("last_year"),
            F.avg("intensity").alias("mean_intensity"),
        )
    )
    joined = reach.join(peak_years(intensity), "cluster_id", "left").join(
        one_label_per_theme(themes), "cluster_id", "left"
    )
    ordered = ["cluster_id", "cluster_label"] + [
        c for c in joined.columns if c not in ("cluster_id", "cluster_label")
    ]
    return joined.select(*ordered).orderBy(F.desc("unique_companies"), "cluster_id")


def corpus_stats(intensity: DataFrame, changes: DataFrame) -> DataFrame:
    """One row of corpus figures plus a histogram of change types as a map."""
    per_version = intensity.groupBy("cik", "fiscal_year").agg(
        F.countDistinct(F.when(F.col("is_present"), F.col("cluster_id"))).alias("themes"),
        F.sum("chunk_count").alias("chunks"),
        F.sum(F.when(F.col("is_present"), F.col("intensity"))).alias("intensity_sum"),
        F.count_if("is_present").alias("present_rows"),
    )
    filings = per_version.agg(
        F.countDistinct("cik").alias("total_companies"),
        F.countDistinct("fiscal_year").alias("total_years"),
        F.count(F.lit(1)).alias("total_filings"),
        F.coalesce(F.sum("chunks"), F.lit(0)).alias("total_chunks"),
        F.round(
            F.coalesce(F.avg(F.when(F.col("themes") > 0, F.col("themes"))), F.lit(0.0)), 4
        ).alias("mean_themes_per_filing"),
        F.round(
            F.coalesce(F.try_divide(F.sum("intensity_sum"), F.sum("present_rows")), F.lit(0.0)),
            6,
        ).alias("mean_intensity_per_theme"),
    )
    theme_count = intensity.agg(F.countDistinct("cluster_id").alias("total_themes"))
    histogram = changes.groupBy("change_type").count()
    types = histogram.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("change_type", "count")))).alias(
            "change_type_counts"
        )
    )
    return filings.select(
        "*",
        theme_count.scalar().alias("total_themes"),
        types.scalar().alias("change_type_counts"),
    )


def change_type_histogram(changes: DataFrame) -> DataFrame:
    return changes.groupBy("change_type").agg(F.count(F.lit(1)).alias("n_changes"))


class ThemeTracker:
    """The same questions bound to three frames; lookups of unknown keys raise ``KeyError``."""

    def __init__(self, intensity: DataFrame, changes: DataFrame, themes: DataFrame):
        assert_columns(
            intensity,
            ("cik", "fiscal_year", "cluster_id", "cluster_label", "chunk_count", "intensity",
             "is_present"),
            "ThemeTracker:intensity",
        )
        assert_columns(
            changes,
            ("cik", "fiscal_year", "cluster_id", "change_type", "materiality_score",
             "first_appearance"),
            "ThemeTracker:changes",
        )
        assert_columns(themes, ("cluster_id", "cluster_label"), "ThemeTracker:themes")
        self.intensity, self.changes, self.themes = intensity, changes, themes

    @staticmethod
    def _known(frame: DataFrame, message: str) -> DataFrame:
        if frame.isEmpty():
            raise KeyError(message)
        return frame

    def get_company_timeline(self, cik: str) -> DataFrame:
        return self._known(company_timeline(self.intensity, cik), f"cik '{cik}' not found")

    def get_theme_trajectory(self, cluster_id: int, cik: str | None = None) -> DataFrame:
        self._known(
            self.intensity.where(F.col("cluster_id") == cluster_id),
            f"cluster_id {cluster_id} not found",
        )
        found = theme_trajectory(self.intensity, cluster_id, cik)
        return self._known(found, f"no rows for cluster_id={cluster_id} and cik='{cik}'")

    def get_emerging_themes(
        self, year: int, min_companies: int = MIN_EMERGING_COMPANIES
    ) -> DataFrame:
        return emerging_themes(self.intensity, self.changes, year, min_companies)

    def get_fading_themes(self, year: int) -> DataFrame:
        return fading_themes(self.changes, self.themes, year)

    def get_theme_prevalence(self) -> DataFrame:
        return theme_prevalence(self.intensity, self.themes)

    def get_corpus_stats(self) -> dict:
        """The single row of :func:`corpus_stats` as a dict."""
        return corpus_stats(self.intensity, self.changes).first().asDict()
