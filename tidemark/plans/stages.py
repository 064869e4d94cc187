"""The six stages of a run; each reads the tables of the stage before and writes its own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import Layers, default_companies
from tidemark.functions import identifiers as I
from tidemark.operators import changes as C
from tidemark.operators import clustering as L
from tidemark.operators import drift as D
from tidemark.operators import filings as J
from tidemark.operators import gold as G
from tidemark.operators import intensity as T
from tidemark.operators import labels as B
from tidemark.operators.chunking import assert_unique_chunks, chunk_sections
from tidemark.operators.embedding import HASHING_MODEL, EmbeddingStore
from tidemark.operators.explanations import MAX_EXPLANATIONS, build_explanations
from tidemark.operators.sections import extract_sections
from tidemark.plans import reports as O
from tidemark.sources import bronze as Z
from tidemark.sources import gold_layer
from tidemark.sources.http import HttpClient
from tidemark.sources.lists import read_overrides
from tidemark.streaming.refresh import SECTION

Generate = Callable[[DataFrame], DataFrame]


def _store(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _load(spark: SparkSession, layers: Layers, table: str) -> DataFrame:
    return spark.read.parquet(layers.silver(table))


def ingest(
    spark: SparkSession,
    layers: Layers,
    submissions: DataFrame,
    ciks: DataFrame,
    years: list[int],
    make_client: Callable[[float], HttpClient],
    tasks: int = 1,
) -> dict[str, int]:
    """Annual filings of the wanted entities and years into the bronze table."""
    wanted = ciks.select("cik").distinct()
    filings = J.annual_filings(submissions, years).join(wanted, "cik", "left_semi")
    table = Z.update_bronze(spark, filings, layers.bronze, make_client, tasks)
    counts = table.agg(
        F.count(F.lit(1)).alias("artifacts"), F.count("error").alias("failed")
    ).first()
    return counts.asDict()


def parse(spark: SparkSession, layers: Layers) -> dict[str, int]:
    """Sections out of the documents; failures are kept as rows for the quality table."""
    documents = Z.latest_documents(spark.read.schema(Z.FETCHED_SCHEMA).parquet(layers.bronze))
    sections = _store(extract_sections(documents).drop("html"), layers.silver("sections"))
    counts = sections.agg(
        F.count(F.lit(1)).alias("filings"), F.count_if("success").alias("extracted")
    ).first()
    return counts.asDict()


def understand(
    spark: SparkSession,
    layers: Layers,
    clusterer: L.ThemeClusterer | None = None,
    encode: Generate | None = None,
    overrides: DataFrame | None = None,
    generate: Generate | None = None,
    model: str = HASHING_MODEL,
) -> dict[str, int]:
    """Chunks, vectors, clusters, labels and outliers; ``clusterer`` holds the number of themes and the
    rule for noise. ``model`` names the encoder: vectors of another one are never taken for its own."""
    good = _load(spark, layers, "sections").where("success")
    chunks = _store(
        chunk_sections(good.withColumn("section", F.lit(SECTION))), layers.silver("chunks")
    )
    assert_unique_chunks(chunks)
    vectors = EmbeddingStore(spark, layers.silver("embeddings"), model).get_or_compute(chunks, encode)
    placed = (clusterer or L.ThemeClusterer()).fit_predict(vectors)
    clustered = _store(placed, layers.silver("clusters"))
    centroids = _store(L.cluster_centroids(clustered), layers.silver("centroids"))
    nearest = B.representative_chunks(
        clustered.drop("embedding"), clustered.drop("cluster_id"), centroids
    )
    labels = B.label_themes(
        centroids.select("cluster_id"), nearest, chunks, overrides, generate
    )
    gold_layer.save_labels(labels, layers.silver("labels"))
    texts = chunks.select(*I.CHUNK_IDENTITY, "text")
    outliers = L.novel_outliers(clustered.join(texts, list(I.CHUNK_IDENTITY)), centroids)
    found = _store(outliers, layers.silver("outliers")).count()
    return {"chunks": chunks.count(), "themes": centroids.count(), "outliers": found}


def _clustered_chunks(spark: SparkSession, layers: Layers) -> DataFrame:
    clusters = _load(spark, layers, "clusters").select(*I.CHUNK_IDENTITY, "cluster_id", "embedding")
    return _load(spark, layers, "chunks").join(clusters, list(I.CHUNK_IDENTITY))


def drift(spark: SparkSession, layers: Layers) -> dict[str, int]:
    """Intensity, changes, centroid drift and distribution drift."""
    chunks = _clustered_chunks(spark, layers)
    labels = gold_layer.load_labels(spark, layers.silver("labels"))
    keyed = _store(T.compute_intensity(chunks, labels), layers.silver("intensity"))
    changes = _store(C.compute_yoy_changes(keyed), layers.silver("changes"))
    vectors = _load(spark, layers, "clusters").select(*I.CHUNK_IDENTITY, "embedding")
    bare = chunks.drop("embedding")
    _store(
        D.compute_centroid_drift(bare, vectors, exclude_noise=True),
        layers.silver("centroid_drift"),
    )
    _store(
        D.compute_distribution_drift(bare, vectors, exclude_noise=True),
        layers.silver("distribution_drift"),
    )
    return {"intensity_rows": keyed.count(), "changes": changes.count()}


def explain(
    spark: SparkSession,
    layers: Layers,
    max_explanations: int = MAX_EXPLANATIONS,
    generate: Generate | None = None,
    model: str = "generated",
) -> dict[str, int]:
    """Explanations of the most material changes."""
    ranked = C.top_changes(
        _load(spark, layers, "changes"), _load(spark, layers, "centroid_drift"), max_explanations
    )
    labels = gold_layer.load_labels(spark, layers.silver("labels"))
    told = build_explanations(
        ranked, _clustered_chunks(spark, layers), labels, max_explanations, generate, model
    )
    return {"explanations": _store(told, layers.silver("explanations")).count()}


def publish(
    spark: SparkSession, layers: Layers, metadata: DataFrame | None = None
) -> dict[str, float]:
    """The seven gold tables; returns their sizes in MB."""
    chunks = _clustered_chunks(spark, layers).drop("embedding")
    intensity = _load(spark, layers, "intensity")
    paths = gold_layer.build_all(
        layers.gold,
        ciks=intensity.select("cik").distinct(),
        metadata=metadata if metadata is not None else default_companies(spark),
        intensity=intensity,
        labels=gold_layer.load_labels(spark, layers.silver("labels")),
        changes=_load(spark, layers, "changes"),
        centroid_drift=_load(spark, layers, "centroid_drift"),
        explanations=_load(spark, layers, "explanations"),
        chunks=chunks,
        extractions=_load(spark, layers, "sections"),
        clustering=G.noise_by_year(chunks),
        overrides=read_overrides(spark, layers.overrides),
    )
    return gold_layer.check_sizes(spark, paths)


def feed(spark: SparkSession, layers: Layers, by: str = "materiality") -> DataFrame:
    """The change feed of the published tables, with the distribution drift of the run."""
    gold = {n: gold_layer.read_table(spark, layers.gold, n) for n in ("theme_changes", "themes", "companies")}
    changes = O.change_feed(
        gold["theme_changes"], gold["themes"], gold["companies"], _load(spark, layers, "distribution_drift")
    )
    return O.sort_feed(changes, by)
