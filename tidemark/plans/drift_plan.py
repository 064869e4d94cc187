"""The end-to-end drift plan: chunks to intensity to changes to drift to ranking to text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import changes as C
from tidemark.operators import drift as D
from tidemark.operators.explanations import MAX_EXPLANATIONS, build_explanations
from tidemark.operators.intensity import GROUP, count_chunks, drop_noise, intensity_of_counts
from tidemark.session import cut_lineage


@dataclass(frozen=True)
class DriftResult:
    """Lazy frames of one run. The ranking is checkpointed, so it is only made when it is asked for."""

    intensity: DataFrame
    changes: DataFrame
    centroid_drift: DataFrame | None
    top: int = C.DEFAULT_TOP

    @cached_property
    def ranked(self) -> DataFrame:
        return C.top_changes(self.changes, self.centroid_drift, self.top)


def drift_plan(
    chunks: DataFrame,
    labels: DataFrame | None = None,
    top: int = C.DEFAULT_TOP,
    dimension: int | None = None,
) -> DriftResult:
    """``chunks`` may carry an ``embedding``; without one the drift stays NULL.

    With vectors, counts and mean vectors come from one aggregation that is cut off, so the
    chunks are read and shuffled once although intensity and drift both build on them.
    """
    drift = None
    if "embedding" in chunks.columns:
        groups = cut_lineage(D.version_centroids(drop_noise(chunks), dimension))
        counts = groups.select(*GROUP, F.col("n_rows").alias("chunk_count"))
        drift = D.drift_of_centroids(groups)
    else:
        counts = count_chunks(chunks)
    intensity = intensity_of_counts(counts, labels)
    changes = C.compute_yoy_changes(intensity)
    return DriftResult(intensity, changes, drift, top)


def explained_changes(
    chunks: DataFrame,
    labels: DataFrame,
    max_explanations: int = MAX_EXPLANATIONS,
    generate: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Explanations of the most material changes of a corpus with texts."""
    result = drift_plan(chunks, labels, max_explanations)
    return build_explanations(result.ranked, chunks, labels, max_explanations, generate)
