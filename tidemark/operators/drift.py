"""Semantic drift of a theme between versions: centroid, distribution and significance.

Pairwise distances are never formed. With m the mean of the unit vectors of a group, the mean
cosine distance of two groups is 1 - m1.m2, so the energy distance and the boilerplate index
follow from one vector mean per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import identifiers as I
from tidemark.functions import vectors as V
from tidemark.functions.scoring import PERMUTATIONS, SIGNIFICANCE_LEVEL, clip
from tidemark.functions.skew import salted_join
from tidemark.operators.intensity import drop_noise
from tidemark.schemas import assert_columns
from tidemark.session import cut_lineage

PAIR = ("cik", "cluster_id", "fiscal_year")
DRIFT_DIGITS = 4  # fixed value: decimals of published drift figures
_TIE_SLACK = 1e-12
# Hash prefixes are as long as it takes to have about so many keys in each.
_ROWS_PER_BUCKET = 1024
_MAX_PREFIX = 32  # fixed value: hexadecimal digits of the hash


def with_embeddings(
    chunks: DataFrame, embeddings: DataFrame, exclude_noise: bool = False
) -> DataFrame:
    """Chunk keys with their vector (NULL when a chunk has none).

    Where both sides name the filing, it becomes part of ``chunk_id``, so that ids stay unique.
    """
    ids = I.chunk_identity(chunks, embeddings)
    assert_columns(chunks, ("chunk_id", *PAIR), "with_embeddings:chunks")
    assert_columns(embeddings, ("chunk_id", "embedding"), "with_embeddings:embeddings")
    if not isinstance(embeddings.schema["embedding"].dataType, T.ArrayType):
        raise ValueError("embedding must be an array column, one vector per row")
    kept = drop_noise(chunks) if exclude_noise else chunks.dropna(subset=list(PAIR))
    keys = kept.select(*ids, *PAIR)
    joined = keys.join(embeddings.select(*ids, "embedding"), ids, "left")
    return joined.select(F.concat_ws("/", *ids).alias("chunk_id"), *PAIR, "embedding")


def version_centroids(
    members: DataFrame, dimension: int | None = None, unit_means: bool = False
) -> DataFrame:
    """Mean vector per (entity, theme, version); optionally the mean of unit vectors too."""
    size = dimension or V.vector_dimension(members, "embedding")
    means: dict[str, Column] = {"centroid": F.col("embedding")}
    source = members
    if unit_means:
        source = members.withColumn("_unit", V.l2_normalize(F.col("embedding")))
        means["unit_mean"] = F.col("_unit")
    return V.vector_means(source, PAIR, means, size)


def compute_centroid_drift(
    chunks: DataFrame,
    embeddings: DataFrame,
    dimension: int | None = None,
    exclude_noise: bool = False,
    digits: int | None = DRIFT_DIGITS,
) -> DataFrame:
    """Cosine distance between the mean vectors of consecutive observed versions.

    Versions need not be adjacent years. A pair is left out when either side has no vector.
    """
    size = dimension or V.vector_dimension(embeddings, "embedding")
    return drift_of_members(with_embeddings(chunks, embeddings, exclude_noise), size, digits)


def drift_of_members(
    members: DataFrame, dimension: int | None = None, digits: int | None = DRIFT_DIGITS
) -> DataFrame:
    """As :func:`compute_centroid_drift`, for chunks that already carry their vector.

    Pass the dimension when ``members`` is itself the result of a join: it is read from the
    first row otherwise.
    """
    return drift_of_centroids(version_centroids(members, dimension), digits)


def drift_of_centroids(centroids: DataFrame, digits: int | None = DRIFT_DIGITS) -> DataFrame:
    """Distance of every mean vector to the one of the version before it."""
    history = Window.partitionBy("cik", "cluster_id").orderBy("fiscal_year")
    paired = centroids.withColumn("previous", F.lag("centroid").over(history))
    distance = V.cosine_distance(F.col("centroid"), F.col("previous"))
    return paired.where(F.col("centroid").isNotNull() & F.col("previous").isNotNull()).select(
        *PAIR, _published(distance, digits).alias("centroid_drift")
    )


def _published(value: Column, digits: int | None) -> Column:
    return value if digits is None else F.round(value, digits)


def _self_distance(count: Column, mean: Column) -> Column:
    return F.when(count <= 1, F.lit(0.0)).otherwise(F.lit(1.0) - V.dot(mean, mean))


def adjacent_pairs(members: DataFrame, dimension: int | None = None) -> DataFrame:
    """One row per theme and pair of adjacent years, with both means and the drift figures."""
    history = Window.partitionBy("cik", "cluster_id").orderBy("fiscal_year")
    lagged = version_centroids(members, dimension, unit_means=True).withColumn(
        "p",
        F.lag(F.struct("fiscal_year", "n_vectors", "centroid", "unit_mean")).over(history),
    )
    pairs = lagged.where(
        (F.col("p.fiscal_year") == F.col("fiscal_year") - 1)
        & (F.col("n_vectors") > 0)
        & (F.col("p.n_vectors") > 0)
    )
    cross = F.lit(1.0) - V.dot(F.col("unit_mean"), F.col("p.unit_mean"))
    within = _self_distance(F.col("n_vectors"), F.col("unit_mean"))
    within_previous = _self_distance(F.col("p.n_vectors"), F.col("p.unit_mean"))
    scored = pairs.withColumns({"_x": cross, "_c": within, "_p": within_previous})
    return scored.select(
        *PAIR,
        F.col("n_vectors").alias("n_current"),
        F.col("p.n_vectors").alias("n_previous"),
        F.col("centroid"),
        F.col("p.centroid").alias("previous_centroid"),
        V.cosine_distance(F.col("centroid"), F.col("p.centroid")).alias("centroid_drift"),
        F.greatest(F.lit(0.0), 2.0 * F.col("_x") - F.col("_c") - F.col("_p")).alias(
            "wasserstein_drift"
        ),
        clip(F.lit(1.0) - (F.col("_c") + F.col("_p")) / 2.0).alias("boilerplate_index"),
    )


def _shuffle_key(chunk_id: Column, iteration: Column) -> Column:
    return F.md5(F.concat(chunk_id, F.lit("#"), iteration.cast("string")).cast("binary"))


def _pair_members(members: DataFrame) -> DataFrame:
    """Each vector once for the pair it ends and once for the pair it starts."""
    return members.where(F.col("embedding").isNotNull()).withColumn(
        "fiscal_year",
        F.explode(F.array(F.col("fiscal_year"), F.col("fiscal_year") + 1)),
    )


def _thresholds(sized_ids: DataFrame, iterations: int) -> DataFrame:
    """Thresholds of each pair: count keys per hash prefix, rank only inside the deciding prefix.

    The prefix grows with the pair, so the ranked rest stays near a thousand keys. Counts
    combine before the shuffle, and only rows of the deciding prefix are shuffled one by one.
    """
    total = F.col("n_current") + F.col("n_previous")
    digits = F.least(
        F.lit(_MAX_PREFIX),
        F.greatest(F.lit(0), F.ceil(F.log(16.0, total / F.lit(float(_ROWS_PER_BUCKET))))),
    ).cast("int")
    keyed = (
        sized_ids.withColumn("digits", digits)
        .withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(iterations))))
        .withColumn("h", _shuffle_key(F.col("chunk_id"), F.col("i")))
        .withColumn("prefix", F.left(F.col("h"), F.col("digits")))
    )
    counts = keyed.groupBy(*PAIR, "i", "prefix").agg(
        F.count(F.lit(1)).alias("n"), F.first("n_current").alias("n_current")
    )
    upto = Window.partitionBy(*PAIR, "i").orderBy("prefix")
    deciding = (
        counts.withColumn("upto", F.sum("n").over(upto))
        .where(
            (F.col("upto") >= F.col("n_current"))
            & (F.col("upto") - F.col("n") < F.col("n_current"))
        )
        .select(*PAIR, "i", "prefix", (F.col("n_current") - F.col("upto") + F.col("n")).alias("k"))
    )
    # Attach the deciding prefixes per pair (one bounded map each), then filter in place.
    lookup = deciding.groupBy(*PAIR).agg(
        F.map_from_entries(F.collect_list(F.struct("i", F.struct("prefix", "k")))).alias("want")
    )
    slots = sized_ids.withColumn("digits", digits).select(*PAIR, "chunk_id", "digits")
    candidates = (
        salted_join(slots, lookup, list(PAIR), "chunk_id")
        .withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(iterations))))
        .withColumn("h", _shuffle_key(F.col("chunk_id"), F.col("i")))
        .withColumn("w", F.element_at("want", F.col("i")))
        .where(F.left(F.col("h"), F.col("digits")) == F.col("w.prefix"))
        .select(*PAIR, "i", "h", F.col("w.k").alias("k"))
    )
    within = Window.partitionBy(*PAIR, "i").orderBy("h")
    nth = candidates.withColumn("r", F.row_number().over(within)).where(F.col("r") == F.col("k"))
    return (
        nth.groupBy(*PAIR)
        .agg(F.array_sort(F.collect_list(F.struct("i", "h"))).alias("t"))
        .select(*PAIR, F.col("t.h").alias("thresholds"))
    )


def permutation_p_values(
    members: DataFrame,
    pairs: DataFrame,
    dimension: int | None = None,
    iterations: int = PERMUTATIONS,
) -> DataFrame:
    """Share of random regroupings whose centroid drift reaches the observed one.

    Regrouping ``i`` orders a pair's members by md5(chunk_id#i) and takes the first n_current
    of them: reproducible, of exact size, and checkable in SQL. Only chunk ids are needed to
    find the n-th key of every regrouping; with that threshold each vector decides alone which
    regroupings it joins, so vectors are summed before they are shuffled and a pair that holds
    a large part of the data is spread over many tasks.
    """
    size = dimension or V.vector_dimension(members, "embedding")
    sizes = pairs.select(*PAIR, "n_current", "n_previous")
    ids = salted_join(
        _pair_members(members).select(*PAIR, "chunk_id"), sizes, list(PAIR), "chunk_id"
    )
    thresholds = _thresholds(ids, iterations)
    joined = salted_join(
        _pair_members(members).select(*PAIR, "chunk_id", "embedding"),
        thresholds,
        list(PAIR),
        "chunk_id",
    )
    drawn = (
        joined.select(*PAIR, "chunk_id", "embedding", F.posexplode("thresholds").alias("pos", "t"))
        .withColumn("i", F.col("pos") + 1)
        .where(_shuffle_key(F.col("chunk_id"), F.col("i")) <= F.col("t"))
    )
    sums = drawn.groupBy(*PAIR, "i").agg(V.vector_sum(F.col("embedding"), size).alias("drawn"))
    scored = sums.join(
        pairs.select(
            *PAIR, "n_current", "n_previous", "centroid", "previous_centroid",
            F.col("centroid_drift").alias("observed"),
        ),
        list(PAIR),
    )
    whole = F.zip_with(
        V.scale(F.col("centroid"), F.col("n_current")),
        V.scale(F.col("previous_centroid"), F.col("n_previous")),
        lambda a, b: a + b,
    )
    rest = F.zip_with(whole, F.col("drawn"), lambda a, b: a - b)
    # Cosine ignores length, so the two sums serve as the two means.
    regrouped = V.cosine_distance(F.col("drawn"), rest)
    reached = regrouped >= F.col("observed") - _TIE_SLACK
    return scored.groupBy(*PAIR).agg(
        (F.count_if(reached) / F.lit(float(iterations))).alias("p_value")
    )


def compute_distribution_drift(
    chunks: DataFrame,
    embeddings: DataFrame,
    dimension: int | None = None,
    exclude_noise: bool = False,
    iterations: int = PERMUTATIONS,
    digits: int | None = DRIFT_DIGITS,
) -> DataFrame:
    """Centroid drift, energy distance, p-value, boilerplate index per pair of adjacent years."""
    members = with_embeddings(chunks, embeddings, exclude_noise)
    size = dimension or V.vector_dimension(embeddings, "embedding")
    # One row per pair, read three times below: cut off so that vectors are averaged once.
    pairs = cut_lineage(adjacent_pairs(members, size))
    p_values = permutation_p_values(members, pairs, size, iterations)
    return pairs.join(p_values, list(PAIR)).select(
        *PAIR,
        _published(F.col("centroid_drift"), digits).alias("centroid_drift"),
        _published(F.col("wasserstein_drift"), digits).alias("wasserstein_drift"),
        _published(F.col("p_value"), digits).alias("p_value"),
        _published(F.col("boilerplate_index"), digits).alias("boilerplate_index"),
        (F.col("p_value") < SIGNIFICANCE_LEVEL).alias("is_statistically_significant"),
    )
