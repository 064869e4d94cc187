"""Registered queries against their DuckDB SQL on the smallest tables.

A spread of queries over all operator families; tests/check_oracle.py runs every one of them.
"""

from __future__ import annotations

import pytest
from check_oracle import compare, connect

import __spark_entry__ as entry

WITHOUT_SQL = {"text_embeddings", "theme_clusters", "density_themes", "neighbour_graph"}
CHOSEN = [
    "intensity", "intensity_events", "presence_matrix", "yoy_changes", "yoy_with_zero_rows",
    "ranked_changes", "top_changes", "emerging_themes", "theme_prevalence", "corpus_stats",
    "cluster_centroids", "density_clusters", "nearest_vectors", "centroid_drift", "distribution_drift", "novel_outliers",
    "missing_embeddings", "cleaned_text", "prose_flags", "paragraphs", "chunks",
    "keyword_labels", "theme_label_choice", "extracted_sections", "page_text",
    "recent_annual_filings", "standard_facts", "explanations", "explanation_prompts",
    "before_and_after", "gold_companies", "gold_evidence_chunks", "gold_data_quality",
    "gold_violations", "filtered_feed", "chunk_yield", "theme_network", "preset_top_drift",
]


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


def test_every_query_has_sql_or_is_listed():
    assert set(entry.QUERIES) - set(entry.SQL) == WITHOUT_SQL
    assert set(entry.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_returns_ranked_changes(spark):
    rows = entry.entry(spark).collect()
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1)) and rows


@pytest.mark.parametrize("name", CHOSEN)
def test_query_matches_sql(spark, duck, sf, name):
    problem, *_ = compare(spark, duck, name, entry.queries()[name], entry.oracle_sql()[name], sf)
    assert problem == ""


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_query_without_sql_has_rows(spark, sf, name):
    assert entry.queries()[name](spark, sf).count() > 0
