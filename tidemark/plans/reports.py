"""Report slices over the gold tables: feed, facets, company profile, quality, sector, graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.functions.skew import lookup_join
from tidemark.functions.scoring import kept_and_noise_counts, per_unit
from tidemark.operators.changes import TIE_DIGITS

# Sort choices, category names, list lengths of the report pages.
SORT_COLUMNS = {
    "materiality": "materiality_score",
    "centroid": "centroid_drift",
    "wasserstein": "wasserstein_drift",
    "delta": "intensity_delta",
}
CHUNK_CATEGORIES = {
    "clean_chunks": "Clustered Semantic Chunks",
    "noise_chunks": "Unassigned Noise Points",
}
EVENT_LIST = 25
REVIEW_LIST = 4
_KEY = ["cik", "cluster_id", "fiscal_year"]


def change_feed(
    changes: DataFrame, themes: DataFrame, companies: DataFrame, distribution: DataFrame | None = None
) -> DataFrame:
    """Changes with theme label and company metadata (left joins on unique keys), and with the figures
    of the distribution drift if it is given; they are null where a pair has none."""
    if distribution is not None:
        figures = distribution.select(*_KEY, "wasserstein_drift", "p_value", "boilerplate_index")
        changes = changes.join(figures, _KEY, "left")
    named = lookup_join(changes, themes.select("cluster_id", "label"), ["cluster_id"], _KEY, "left")
    return named.join(companies.select("cik", "ticker", "name", "sector"), "cik", "left")


def filter_feed(
    feed: DataFrame,
    search: str | None = None,
    sector: str | None = None,
    change_type: str | None = None,
    year: int | None = None,
) -> DataFrame:
    """Facets joined by AND; the search text may occur in name, label or ticker."""
    kept = feed
    if search:
        hit = F.lit(False)
        for column in ("name", "label", "ticker"):
            hit = hit | F.coalesce(X.contains_ignore_case(F.col(column), search), F.lit(False))
        kept = kept.where(hit)
    for column, wanted in (("sector", sector), ("change_type", change_type), ("fiscal_year", year)):
        if wanted is not None:
            kept = kept.where(F.col(column) == wanted)
    return kept


def sort_feed(feed: DataFrame, by: str = "materiality") -> DataFrame:
    """Descending by one of the sort choices, missing figures last; unknown column: as it is."""
    column = SORT_COLUMNS[by]
    if column not in feed.columns:
        return feed
    return feed.orderBy(F.desc_nulls_last(column), *_KEY)


def event_list(feed: DataFrame, by: str = "materiality", n: int = EVENT_LIST) -> DataFrame:
    return sort_feed(feed, by).limit(n)


def facet_values(feed: DataFrame, column: str) -> DataFrame:
    return feed.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def display_columns(feed: DataFrame) -> DataFrame:
    """Columns and headings of the change list."""
    return feed.select(
        F.col("ticker").alias("Ticker"),
        F.col("name").alias("Company"),
        F.col("label").alias("Theme Cluster"),
        F.col("fiscal_year").alias("Year"),
        F.col("change_type").alias("Change Type"),
        F.col("intensity_delta").alias("Δ Intensity"),
        F.col("centroid_drift").alias("Centroid Drift"),
        F.col("materiality_score").alias("Materiality"),
    )


def company_profile(intensity: DataFrame, themes: DataFrame, cik: str) -> DataFrame:
    """Labelled intensity rows of one entity (heat map data)."""
    rows = intensity.where(F.col("cik") == cik)
    return rows.join(themes.select("cluster_id", "label"), "cluster_id", "left")


def company_changes(changes: DataFrame, themes: DataFrame, cik: str) -> DataFrame:
    """Labelled changes of one entity, most material first."""
    rows = changes.where(F.col("cik") == cik)
    return (
        rows.join(themes.select("cluster_id", "label"), "cluster_id", "left")
        .select(
            "fiscal_year", "label", "change_type", "intensity_delta", "centroid_drift",
            "materiality_score",
        )
        .orderBy(F.desc_nulls_last("materiality_score"), "fiscal_year", "label")
    )


def company_timeline_cards(
    intensity: DataFrame, changes: DataFrame, themes: DataFrame, cik: str
) -> DataFrame:
    """One row per theme and year of an entity: intensity next to its change."""
    profile = company_profile(intensity, themes, cik)
    own = changes.where(F.col("cik") == cik).select(
        "cluster_id", "fiscal_year", "change_type", "intensity_delta", "materiality_score"
    )
    return profile.join(own, ["cluster_id", "fiscal_year"], "left").orderBy(
        "fiscal_year", "cluster_id"
    )


def headline_figures(companies: DataFrame, themes: DataFrame, quality: DataFrame) -> DataFrame:
    """Row counts and quality totals in one row."""
    totals = quality.agg(
        F.coalesce(F.sum("total_chunks"), F.lit(0)).alias("total_chunks"),
        F.coalesce(F.sum("total_filings"), F.lit(0)).alias("total_filings"),
        F.coalesce(F.sum("failed_extractions"), F.lit(0)).alias("total_failures"),
        F.avg("extraction_success_rate").alias("avg_success_rate"),
        F.avg("noise_fraction").alias("avg_noise_fraction"),
    )
    count = F.count(F.lit(1))
    return totals.select(
        "*",
        companies.agg(count).scalar().alias("n_companies"),
        themes.agg(count).scalar().alias("n_themes"),
    )


def quality_range(quality: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Quality rows of a year range with clustered and noise counts and verbosity."""
    clean, noise = kept_and_noise_counts(F.col("total_chunks"), F.col("noise_fraction"))
    return quality.where(F.col("fiscal_year").between(first_year, last_year)).withColumns(
        {
            "clean_chunks": clean,
            "noise_chunks": noise,
            "avg_paragraphs_per_filing": per_unit(F.col("total_chunks"), F.col("total_filings")),
        }
    )


def chunk_yield(quality: DataFrame) -> DataFrame:
    """Clustered and noise counts as two rows per year with readable category names."""
    long = quality.unpivot(
        ["fiscal_year"], list(CHUNK_CATEGORIES), "chunk_category", "count"
    )
    names = F.create_map(*[F.lit(v) for pair in CHUNK_CATEGORIES.items() for v in pair])
    return long.withColumn("chunk_category", F.element_at(names, F.col("chunk_category")))


def sector_summary(intensity: DataFrame, companies: DataFrame) -> DataFrame:
    """Mean and total chunks and company count per sector; rows with gaps are dropped."""
    joined = intensity.join(companies.select("cik", "sector"), "cik", "left")
    return (
        joined.groupBy("sector")
        .agg(
            F.avg("chunk_count").alias("avg_chunks"),
            F.sum("chunk_count").alias("total_chunks"),
            F.countDistinct("cik").alias("unique_companies"),
        )
        .dropna()
    )


def review_list(themes: DataFrame, n: int = REVIEW_LIST) -> DataFrame:
    return themes.orderBy("cluster_id").limit(n)


def theme_network(changes: DataFrame, themes: DataFrame, companies: DataFrame) -> DataFrame:
    """Entity-theme edges with the delta and drift of the pair's most material change."""
    figures = F.struct(
        F.col("fiscal_year"), F.col("change_type"), F.col("intensity_delta"),
        F.col("centroid_drift"), F.col("materiality_score"),
    )
    order = F.struct(F.round("materiality_score", TIE_DIGITS), -F.col("fiscal_year"))
    edges = (
        changes.groupBy("cik", "cluster_id")
        .agg(F.max_by(figures, order).alias("m"))
        .select("cik", "cluster_id", "m.*")
    )
    return change_feed(edges, themes, companies).select(
        F.col("cik").alias("from_node"),
        F.concat(F.lit("t"), F.col("cluster_id").cast("string")).alias("to_node"),
        "ticker", "label", "sector", "fiscal_year", "change_type", "intensity_delta",
        "centroid_drift", "materiality_score",
    )


def node_neighbours(edges: DataFrame, node: str) -> DataFrame:
    """Edges of a node in either direction, with the node at the other end."""
    touching = edges.where((F.col("from_node") == node) | (F.col("to_node") == node))
    other = F.when(F.col("from_node") == node, F.col("to_node")).otherwise(F.col("from_node"))
    return touching.withColumn("neighbour", other)


def _first_text(evidence: DataFrame, name: str) -> DataFrame:
    return evidence.groupBy(*_KEY).agg(F.min_by("text", "chunk_id").alias(name))


def before_and_after(feed: DataFrame, evidence: DataFrame, explanations: DataFrame) -> DataFrame:
    """Every change with one excerpt of its year, one of the year before, and its explanation.

    A new theme has no earlier and a fading or vanished theme no later excerpt to show. Missing
    evidence stays NULL. Each lookup is reduced to one row per key before the join.
    """
    now = _first_text(evidence, "_now")
    before = _first_text(evidence, "_before").withColumn("fiscal_year", F.col("fiscal_year") + 1)
    told = explanations.groupBy(*_KEY).agg(
        F.min_by("explanation_text", "change_id").alias("explanation")
    )
    joined = feed.join(now, _KEY, "left").join(before, _KEY, "left").join(told, _KEY, "left")
    kind = F.col("change_type")
    return joined.select(
        *_KEY,
        "ticker",
        "label",
        "change_type",
        F.when(kind != "new", F.col("_before")).alias("baseline_text"),
        F.when(~kind.isin("fading", "disappeared"), F.col("_now")).alias("shifted_text"),
        "explanation",
        F.concat(
            F.coalesce("ticker", F.lit("CORP")), F.lit(" FY"), F.col("fiscal_year").cast("string"),
            F.lit(" 10-K · Item 1A (Accession: CIK"), F.col("cik"), F.lit("-"),
            F.col("fiscal_year").cast("string"), F.lit(")"),
        ).alias("citation"),
    )


def first_explanation(changes: DataFrame, explanations: DataFrame) -> DataFrame:
    """Changes with the first explanation of exactly the same key, NULL when there is none."""
    first = Window.partitionBy(*_KEY).orderBy("change_id")
    told = (
        explanations.withColumn("_r", F.row_number().over(first))
        .where(F.col("_r") == 1)
        .select(*_KEY, "explanation_text")
    )
    return changes.join(told, _KEY, "left")
