"""Theme clusters: centroids, statistics, novel outliers, and a clusterer on Spark ML."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import text as X
from tidemark.functions import vectors as V
from tidemark.operators.density import density_clusters
from tidemark.operators.intensity import NOISE_CLUSTER
from tidemark.session import cut_lineage, shared_folder

# Reduced dimension, seed, outlier count, score decimals, fallback cluster limit.
REDUCED_DIMENSION = 12
SEED = 42
TOP_OUTLIERS = 50
SCORE_DIGITS = 4
FALLBACK_CLUSTERS = 3
# Density parameters by scale preset; unknown presets take the last.
DENSITY_PARAMETERS = {
    "small": {"min_cluster_size": 15, "min_samples": 5},
    "medium": {"min_cluster_size": 25, "min_samples": 5},
    "full": {"min_cluster_size": 40, "min_samples": 8},
}
# Centroids pass the points in blocks; one block is at most this many rows.
CENTROIDS_PER_BLOCK = 1024


def density_parameters(scale: str) -> dict[str, int]:
    return dict(DENSITY_PARAMETERS.get(scale, DENSITY_PARAMETERS["full"]))


def cluster_centroids(clustered: DataFrame, dimension: int | None = None) -> DataFrame:
    """Mean vector per cluster, noise excluded: ``cluster_id, n_members, centroid``."""
    size = dimension or V.vector_dimension(clustered, "embedding")
    members = clustered.where(F.col("cluster_id") != NOISE_CLUSTER)
    return V.vector_means(members, ["cluster_id"], {"centroid": F.col("embedding")}, size).select(
        "cluster_id", F.col("n_vectors").alias("n_members"), "centroid"
    )


def compute_centroid(clustered: DataFrame, cluster_id: int, dimension: int) -> DataFrame:
    """One row with the mean vector of a cluster; zeros when it has no member."""
    members = clustered.where(F.col("cluster_id") == cluster_id)
    total = V.vector_sum(F.col("embedding"), dimension)
    summed = members.agg(F.count("embedding").alias("n"), total.alias("s"))
    divisor = F.greatest(F.col("n"), F.lit(1))
    return summed.select(
        F.lit(cluster_id).alias("cluster_id"),
        F.transform("s", lambda v: F.coalesce(v, F.lit(0.0)) / divisor).alias("centroid"),
    )


def cluster_sizes(clustered: DataFrame) -> DataFrame:
    return clustered.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))


def cluster_stats(clustered: DataFrame, digits: int | None = None) -> DataFrame:
    """One row: cluster count, noise count and share, total, and sizes as a map."""
    in_cluster = F.col("cluster_id") != NOISE_CLUSTER
    noise = F.coalesce(F.sum(F.when(~in_cluster, F.col("n"))), F.lit(0))
    total = F.coalesce(F.sum("n"), F.lit(0))
    entries = F.collect_list(F.when(in_cluster, F.struct("cluster_id", "n")))
    stats = cluster_sizes(clustered).agg(
        F.count_if(in_cluster).alias("n_clusters"),
        noise.alias("noise_count"),
        total.alias("total_points"),
        F.map_from_entries(F.array_sort(entries)).alias("cluster_sizes"),
    )
    share = F.coalesce(F.try_divide(F.col("noise_count"), F.col("total_points")), F.lit(0.0))
    return stats.withColumn("noise_fraction", share if digits is None else F.round(share, digits))


def _unit_rows(matrix: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(length == 0.0, 1.0, length)


def _blocks(folder: str) -> Iterator[np.ndarray]:
    """Directions of the stored centroids, a bounded block at a time."""
    store, path = fs.FileSystem.from_uri(folder)
    for batch in ds.dataset(path, filesystem=store, format="parquet").to_batches(
        batch_size=CENTROIDS_PER_BLOCK
    ):
        if batch.num_rows:
            yield _unit_rows(np.array(batch.column("centroid").to_pylist(), dtype="float64"))


def nearest_centroid_distance(points: DataFrame, centroids: DataFrame) -> DataFrame:
    """``points`` (with ``embedding``) plus ``distance`` to the closest centroid.

    The centroids are written once to the shared folder; every task streams them past its batches
    of points in blocks and keeps the least distance. Points are neither joined nor shuffled, and
    memory does not depend on the number of centroids.
    """
    folder = f"{shared_folder(points.sparkSession)}/tidemark-centroids-{uuid.uuid4().hex}"
    table = centroids.select("centroid").dropna()
    table.write.parquet(folder)
    if points.sparkSession.read.schema(table.schema).parquet(folder).isEmpty():
        return points.withColumn("distance", F.lit(0.0)).limit(0)

    @F.pandas_udf(T.DoubleType())
    def nearest(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype="float64")
        unit = _unit_rows(np.stack(vectors.to_numpy()).astype("float64"))
        best = np.full(len(unit), 2.0)
        for block in _blocks(folder):
            best = np.minimum(best, (1.0 - unit @ block.T).min(axis=1))
        return pd.Series(np.clip(best, 0.0, 2.0))

    return points.withColumn("distance", nearest("embedding"))


def novel_outliers(
    clustered: DataFrame,
    centroids: DataFrame | None = None,
    top_k: int = TOP_OUTLIERS,
    text_col: str = "text",
    dimension: int | None = None,
) -> DataFrame:
    """Noise chunks in running prose, farthest from every theme first.

    ``clustered`` has ``chunk_id, cluster_id, embedding`` and the text column.
    """
    middle = centroids if centroids is not None else cluster_centroids(clustered, dimension)
    # One condition over cluster and text: the costly text test then runs on noise only and is
    # not pushed below the join that brought vectors and texts together.
    readable = F.when(F.col("cluster_id") == NOISE_CLUSTER, X.is_prose(F.col(text_col)))
    noise = clustered.where(readable & F.col("embedding").isNotNull())
    # Top-k per task, then of the tasks' winners; texts ride along with at most k rows each.
    measured = nearest_centroid_distance(
        noise.select("chunk_id", "embedding", F.col(text_col).alias("text")), middle
    )
    return (
        measured.orderBy(F.desc("distance"), "chunk_id")
        .limit(top_k)
        .select(
            "chunk_id",
            F.round("distance", SCORE_DIGITS).alias("anomaly_score"),
            F.lit(True).alias("is_outlier"),
            "text",
        )
    )


@dataclass
class ThemeClusterer:
    """Reduce dimensions, cluster, mark noise.

    With ``k`` unset, themes are density clusters over all points (``operators.density``): how many
    there are and what is noise come from the hierarchy, with ``min_cluster_size`` and
    ``min_samples``. Only if that finds nothing but noise, the fallback rule holds: k-means with
    members // min_cluster_size clusters, between 1 and 3.

    With ``k`` given this is k-means, and a point is noise when it is farther from its centre than
    ``noise_ratio`` times the median distance in its cluster; there may be none. ``noise_fraction``
    makes the farthest share of all points noise instead.
    """

    k: int | None = None
    min_cluster_size: int = 20
    min_samples: int = 5
    components: int = REDUCED_DIMENSION
    noise_ratio: float = 3.0
    noise_fraction: float | None = None
    seed: int = SEED

    @classmethod
    def for_scale(cls, scale: str, **given) -> ThemeClusterer:
        """A clusterer with the density parameters of a scale preset."""
        return cls(**{**density_parameters(scale), **given})

    def _centres(self, reduced: DataFrame) -> np.ndarray:
        total = reduced.count()
        k = self.k or max(1, min(FALLBACK_CLUSTERS, total // max(1, self.min_cluster_size)))
        if k == 1 or total <= 1:
            means = reduced.agg(Summarizer.mean(F.col("_r")).alias("m")).first()["m"]
            return np.array([means.toArray()]) if total else np.zeros((1, 1))
        fitted = KMeans(k=k, seed=self.seed, featuresCol="_r", predictionCol="_c").fit(reduced)
        return np.array(fitted.clusterCenters())

    def fit_predict(self, points: DataFrame) -> DataFrame:
        """``points`` (identity columns and ``embedding``) with ``cluster_id``."""
        keys = [c for c in points.columns if c != "embedding"]
        source = points.withColumn("_v", array_to_vector(F.col("embedding").cast("array<double>")))
        size = V.vector_dimension(points, "embedding")
        if size > self.components:
            reducer = PCA(k=self.components, inputCol="_v", outputCol="_r").fit(source)
            reduced = reducer.transform(source)
        else:
            reduced = source.withColumn("_r", F.col("_v"))
        if self.k is None:
            dense = reduced.select(*keys, "embedding", vector_to_array("_r").alias("_d"))
            found = cut_lineage(density_clusters(dense, "_d", self.min_cluster_size, self.min_samples))
            if not found.filter(F.col("cluster_id") != NOISE_CLUSTER).isEmpty():
                return found.select(*keys, "embedding", "cluster_id")
        cluster, distance = _nearest(self._centres(reduced))
        measured = cut_lineage(
            reduced.select(*keys, "embedding", cluster.alias("_c"), distance.alias("_d"))
        )
        if self.noise_fraction is not None:
            share = 1.0 - self.noise_fraction
            edge = measured.agg(F.percentile_approx("_d", share, 10_000).alias("t")).first()["t"]
            far = F.col("_d") > F.lit(edge if edge is not None else 0.0)
        else:
            middles = measured.groupBy("_c").agg(F.percentile_approx("_d", 0.5, 10_000).alias("t"))
            limits = {r["_c"]: r["t"] * self.noise_ratio for r in middles.collect()}
            far = F.lit(False)
            for c, limit in limits.items():
                far = far | ((F.col("_c") == c) & (F.col("_d") > F.lit(limit)))
        noise = F.when(far, F.lit(NOISE_CLUSTER)).otherwise(F.col("_c"))
        return measured.select(*keys, "embedding", noise.alias("cluster_id"))


def _nearest(centres: np.ndarray) -> tuple[Column, Column]:
    """Number of the nearest of a few centres, and the distance to it, of the vectors in ``_r``."""
    own = vector_to_array("_r")
    table = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centres])

    def gap(centre: Column) -> Column:
        squares = F.zip_with(own, centre, lambda a, b: (a - b) * (a - b))
        return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, v: acc + v))

    best = F.array_min(F.transform(table, lambda c, i: F.struct(gap(c).alias("d"), i.alias("c"))))
    return best["c"].cast("int"), best["d"]
