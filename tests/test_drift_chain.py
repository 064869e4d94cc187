"""Intensity, changes, drift, ranking and tracker invariants on small frames."""

from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import scoring as N
from tidemark.functions import vectors as V
from tidemark.functions.skew import salted_join
from tidemark.operators import changes as C
from tidemark.operators import clustering as L
from tidemark.operators import drift as D
from tidemark.operators import intensity as T
from tidemark.operators.tracker import ThemeTracker
from tidemark.plans import drift_plan as P

CHUNKS = "chunk_id string, cik string, fiscal_year int, accession_number string, cluster_id int"
LABELS = [(0, "Alpha"), (1, "Beta"), (2, "Gamma")]


@pytest.fixture(scope="module")
def chunks(spark):
    rows, n = [], 0
    for cik in ("0001234", "0005678"):
        for year in (2022, 2023):
            for cluster, count in ((0, 5), (1, 3), (2, 2)):
                for _ in range(count):
                    rows.append((f"c{n}", cik, year, f"a-{cik}-{year}", cluster))
                    n += 1
    rows.append((f"c{n}", "0001234", 2023, "a-noise", -1))
    return spark.createDataFrame(rows, CHUNKS)


@pytest.fixture(scope="module")
def intensity(spark, chunks):
    return T.compute_intensity(chunks, spark.createDataFrame(LABELS, "cluster_id int, label string"))


@pytest.fixture(scope="module")
def embeddings(spark, chunks):
    rng = np.random.default_rng(42)
    ids = [r[0] for r in chunks.select("chunk_id").collect()]
    vectors = rng.standard_normal((len(ids), 8)).astype("float32")
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    rows = [(i, [float(x) for x in v]) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, "chunk_id string, embedding array<float>")


def test_intensity_shares(intensity):
    rows = intensity.collect()
    assert len(rows) == 12
    assert {(r.cluster_id, r.intensity) for r in rows} == {(0, 0.5), (1, 0.3), (2, 0.2)}
    assert all(r.cluster_id != -1 and r.is_present for r in rows)
    assert {r.cluster_label for r in rows} == {"Alpha", "Beta", "Gamma"}
    sums = intensity.groupBy("cik", "fiscal_year").agg(F.sum("intensity").alias("s")).collect()
    assert all(abs(r.s - 1.0) < 1e-9 for r in sums)


def test_intensity_needs_its_columns(chunks):
    with pytest.raises(ValueError, match="cluster_id"):
        T.compute_intensity(chunks.drop("cluster_id"))


def test_null_keys_and_only_noise_give_no_rows(spark):
    rows = [("a", None, 2020, "x", 1), ("b", "1", 2020, "x", -1)]
    assert T.compute_intensity(spark.createDataFrame(rows, CHUNKS)).count() == 0


def test_unlabelled_theme_is_unknown(chunks):
    assert {r.cluster_label for r in T.compute_intensity(chunks).collect()} == {"unknown"}


def test_presence_matrix_shape_and_fill(spark, intensity):
    matrix = T.presence_matrix(intensity)
    assert matrix.count() == 3 and len(matrix.columns) == 5
    holes = T.presence_matrix(intensity.where("NOT (cluster_id = 2 AND cik = '0001234')"))
    row = holes.where("cluster_id = 2").first()
    assert row["0001234_2022"] == 0.0 and row["0005678_2022"] == 0.2


def test_first_year_new_then_stable(intensity):
    rows = C.compute_yoy_changes(intensity).collect()
    first = [r for r in rows if r.fiscal_year == 2022]
    assert all(r.change_type == "new" and r.prev_intensity == 0.0 for r in first)
    later = [r for r in rows if r.fiscal_year == 2023]
    assert all(r.change_type == "stable" and r.intensity_delta == 0.0 for r in later)


CASES = [
    ([(2020, 0.05, 5), (2021, 0.10, 9)], "intensifying", 0.05 * math.log(10)),
    ([(2020, 0.10, 5), (2021, 0.03, 3)], "fading", 0.07 * math.log(4)),
    ([(2020, 0.05, 5), (2021, 0.0, 0)], "disappeared", 0.0),
    ([(2020, 0.10, 5), (2021, 0.10, 5)], "stable", 0.0),
    ([(2020, 0.10, 5), (2022, 0.10, 5)], "new", 0.10 * math.log(6)),
    ([(2020, 0.0, 0), (2021, 0.0, 0)], "stable", 0.0),
]


@pytest.mark.parametrize("history,kind,score", CASES)
def test_change_classes(spark, history, kind, score):
    rows = [("1", 7, y, i, n) for y, i, n in history]
    frame = spark.createDataFrame(
        rows, "cik string, cluster_id int, fiscal_year int, intensity double, chunk_count int"
    )
    last = C.compute_yoy_changes(frame).orderBy(F.desc("fiscal_year")).first()
    assert last.change_type == kind
    assert last.materiality_score == pytest.approx(score)
    assert last.materiality == last.materiality_score and last.delta == last.intensity_delta


def test_year_alias_and_derived_intensity(spark):
    rows = [("1", 0, 2020, 2, 10), ("1", 0, 2021, 5, 10)]
    frame = spark.createDataFrame(
        rows, "cik string, cluster_id int, year int, chunk_count int, total_chunks int"
    )
    last = C.compute_yoy_changes(frame).orderBy("year").collect()[-1]
    assert last.prev_intensity == 0.2 and last.intensity_delta == pytest.approx(0.3)


def test_scalar_change_type_and_materiality(spark):
    cases = [
        (None, 0.5, 0.5, "new"), (float("nan"), 0.5, 0.5, "new"), (0.0, 0.5, 0.5, "new"),
        (0.5, None, -0.5, "disappeared"), (0.5, 0.0, -0.5, "disappeared"),
        (0.5, 0.52, 0.02, "stable"), (0.5, 0.53, 0.03, "intensifying"),
        (0.5, 0.47, -0.03, "fading"), (0.5, 0.5, float("nan"), "stable"),
    ]
    frame = spark.createDataFrame(
        [(p, c, d) for p, c, d, _ in cases], "p double, c double, d double"
    )
    got = frame.select(N.change_type(F.col("p"), F.col("c"), F.col("d"))).collect()
    assert [r[0] for r in got] == [k for *_, k in cases]
    pair = frame.limit(1).select(
        N.materiality(F.lit(0.2), F.lit(10)), N.materiality(F.lit(-0.2), F.lit(10))
    ).first()
    assert pair[0] == pair[1] == pytest.approx(0.2 * math.log(11))


def test_zero_rows_reach_disappeared(spark):
    rows = [("a", "1", 2020, "x", 0), ("b", "1", 2020, "x", 1), ("c", "1", 2021, "x", 1)]
    dense = T.densify_disappearances(T.compute_intensity(spark.createDataFrame(rows, CHUNKS)))
    gone = C.compute_yoy_changes(dense).where("cluster_id = 0 AND fiscal_year = 2021").first()
    assert gone.change_type == "disappeared" and gone.disappeared and gone.materiality_score == 0.0


def test_centroid_drift_range_and_gap(chunks, embeddings):
    rows = D.compute_centroid_drift(chunks, embeddings, exclude_noise=True).collect()
    assert len(rows) == 6
    assert all(0.0 <= r.centroid_drift <= 2.0 and r.fiscal_year == 2023 for r in rows)


def test_identical_vectors_do_not_drift(spark):
    rows = [("a", "1", 2020, "x", 0), ("b", "1", 2023, "x", 0)]
    vectors = spark.createDataFrame(
        [("a", [1.0, 0.0, 0.0]), ("b", [1.0, 0.0, 0.0])], "chunk_id string, embedding array<float>"
    )
    frame = spark.createDataFrame(rows, CHUNKS)
    assert [r.centroid_drift for r in D.compute_centroid_drift(frame, vectors).collect()] == [0.0]
    assert D.compute_distribution_drift(frame, vectors).count() == 0  # years are not adjacent


def test_version_without_vectors_breaks_the_pair(spark):
    rows = [("a", "1", 2020, "x", 0), ("b", "1", 2021, "x", 0), ("c", "1", 2022, "x", 0)]
    vectors = spark.createDataFrame(
        [("a", [1.0, 0.0]), ("c", [0.0, 1.0])], "chunk_id string, embedding array<float>"
    )
    assert D.compute_centroid_drift(spark.createDataFrame(rows, CHUNKS), vectors).count() == 0


def test_embedding_must_be_an_array(spark, chunks):
    flat = chunks.select("chunk_id", F.lit(1.0).alias("embedding"))
    with pytest.raises(ValueError, match="array"):
        D.with_embeddings(chunks, flat)


def test_ranking(intensity, chunks, embeddings):
    changes = C.compute_yoy_changes(intensity)
    ranked = C.rank_changes(changes).orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == list(range(1, 13))
    scores = [round(r.materiality_score, 12) for r in ranked]
    assert scores == sorted(scores, reverse=True)
    assert all(r.centroid_drift is None for r in ranked)
    top = C.top_changes(changes, D.compute_centroid_drift(chunks, embeddings), 5).orderBy("rank")
    key = ("rank", "cik", "cluster_id", "fiscal_year")
    assert [[r[k] for k in key] for r in top.collect()] == [[r[k] for k in key] for r in ranked[:5]]


def test_ranking_of_many_equal_scores(spark):
    """Most rows share one score: ranks must still be 1..N in key order."""
    frame = spark.range(5000).select(
        F.format_string("%05d", "id").alias("cik"), F.lit(1).alias("cluster_id"),
        F.lit(2020).alias("fiscal_year"),
        F.when(F.col("id") % 50 == 0, F.col("id") * 1.0).otherwise(1.0).alias("materiality_score"),
    )
    rows = C.rank_changes(frame).orderBy("rank").collect()
    want = sorted(
        ((-(float(i) if i % 50 == 0 else 1.0), f"{i:05d}") for i in range(5000))
    )
    assert [(r["rank"], r.cik) for r in rows] == [(n + 1, c) for n, (_, c) in enumerate(want)]


def _distances(a, b):
    unit = lambda m: m / np.where(np.linalg.norm(m, axis=1, keepdims=True) == 0, 1, np.linalg.norm(m, axis=1, keepdims=True))
    return 1 - unit(a) @ unit(b).T


def _hash(chunk, i):
    import hashlib

    return hashlib.md5(f"{chunk}#{i}".encode()).hexdigest()


def _brute(previous, current):
    """All pairs, full shuffles: what the closed forms and thresholds must reproduce."""
    ids = [i for i, _ in current] + [i for i, _ in previous]
    c = np.array([v for _, v in current]); p = np.array([v for _, v in previous])
    drift = lambda a, b: float(_distances(a.mean(0, keepdims=True), b.mean(0, keepdims=True))[0, 0])
    observed = drift(c, p)
    dc = _distances(c, c).mean() if len(c) > 1 else 0.0
    dp = _distances(p, p).mean() if len(p) > 1 else 0.0
    everything = np.vstack([c, p]); hits = 0
    for i in range(1, 61):
        order = np.argsort([_hash(k, i) for k in ids])
        hits += drift(everything[order[: len(c)]], everything[order[len(c):]]) >= observed - 1e-12
    return (
        observed, max(0.0, 2 * _distances(c, p).mean() - dc - dp), hits / 60,
        max(0.0, min(1.0, 1 - (dc + dp) / 2)),
    )


@pytest.mark.parametrize("per_bucket", [1024, 2])
def test_distribution_drift_equals_brute_force(spark, monkeypatch, per_bucket):
    monkeypatch.setattr(D, "_ROWS_PER_BUCKET", per_bucket)
    rng = np.random.default_rng(3)
    groups, rows, vectors = {}, [], []
    for cluster, sizes in ((0, (40, 25)), (1, (1, 1)), (2, (3, 1)), (3, (1, 60))):
        for year, size in zip((2020, 2021), sizes):
            for _ in range(size):
                name = f"c{len(rows)}"
                vector = rng.normal(size=5) + (year - 2020) * cluster * 0.3
                rows.append((name, "1", year, "x", cluster))
                vectors.append((name, [float(x) for x in vector]))
                groups.setdefault((cluster, year), []).append((name, vector))
    out = D.compute_distribution_drift(
        spark.createDataFrame(rows, CHUNKS),
        spark.createDataFrame(vectors, "chunk_id string, embedding array<double>"),
        digits=None,
    ).collect()
    assert len(out) == 4
    for r in out:
        want = _brute(groups[(r.cluster_id, 2020)], groups[(r.cluster_id, 2021)])
        got = (r.centroid_drift, r.wasserstein_drift, r.p_value, r.boilerplate_index)
        assert got == pytest.approx(want, abs=1e-9)
        assert r.is_statistically_significant == (r.p_value < 0.05)


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.lists(st.floats(-1, 1, allow_subnormal=False), min_size=3, max_size=3), min_size=2, max_size=6),
    st.lists(st.lists(st.floats(-1, 1, allow_subnormal=False), min_size=3, max_size=3), min_size=2, max_size=6),
)
def test_closed_forms_hold(a, b):
    """Mean pairwise cosine distance equals one minus the dot product of unit means."""
    a, b = np.array(a), np.array(b)
    unit = lambda m: m / np.where(np.linalg.norm(m, axis=1, keepdims=True) == 0, 1, np.linalg.norm(m, axis=1, keepdims=True))
    assert _distances(a, b).mean() == pytest.approx(1 - unit(a).mean(0) @ unit(b).mean(0), abs=1e-9)


@pytest.mark.parametrize("dimension", [3, 120])
def test_vector_means_both_strategies(spark, dimension):
    rng = np.random.default_rng(1)
    data = [(i % 3, [float(x) for x in rng.normal(size=dimension)]) for i in range(30)]
    rows = data + [(7, None), (0, None)]
    frame = spark.createDataFrame(rows, "k int, v array<float>")
    got = {r.k: r for r in V.vector_means(frame, ["k"], {"m": F.col("v")}, dimension).collect()}
    for k in range(3):
        want = np.mean([np.float32(v) for j, v in data if j == k], axis=0)
        assert np.allclose(got[k].m, want, atol=1e-6)
    assert got[7].m is None and got[7].n_vectors == 0 and got[0].n_rows == 11


def test_salted_join_keeps_every_row(spark):
    big = spark.range(3000).select(F.when(F.col("id") < 2000, 0).otherwise(F.col("id") % 5).alias("k"), "id")
    small = spark.range(4).select(F.col("id").cast("int").alias("k"), (F.col("id") * 10).alias("v"))
    plain = big.join(small, "k").orderBy("id").collect()
    assert salted_join(big, small, ["k"], "id").select("k", "id", "v").orderBy("id").collect() == plain


def test_outliers_do_not_depend_on_blocks(spark, monkeypatch):
    rng = np.random.default_rng(5)
    words = "the plan and the cost of a thing in our unit is what we see by far as said with care"
    rows = [
        (f"c{i}", -1 if i % 4 == 0 else i % 3, [float(x) for x in rng.normal(size=6)],
         words if i % 8 else "1 2 3")
        for i in range(80)
    ]
    frame = spark.createDataFrame(
        rows, "chunk_id string, cluster_id int, embedding array<float>, text string"
    )
    found = L.novel_outliers(frame, top_k=7).collect()
    assert len(found) == 7 and all(r.text == words for r in found)
    assert [r.anomaly_score for r in found] == sorted((r.anomaly_score for r in found), reverse=True)
    points = frame.where("cluster_id = -1").select("chunk_id", "embedding")
    middles = L.cluster_centroids(frame)
    small = L.nearest_centroid_distance(points, middles)
    monkeypatch.setattr(L, "CENTROIDS_PER_BLOCK", 1)
    blocks = L.nearest_centroid_distance(points, middles)
    pairs = small.select("chunk_id", F.round("distance", 9).alias("d")).orderBy("chunk_id").collect()
    assert pairs == blocks.select("chunk_id", F.round("distance", 9).alias("d")).orderBy("chunk_id").collect()
    nobody = L.nearest_centroid_distance(points, middles.where("cluster_id = 99"))
    assert nobody.count() == 0


@pytest.mark.parametrize("labels,share,clusters", [([-1] * 5, 1.0, 0), ([0, 1, 1], 0.0, 2)])
def test_cluster_stats_edges(spark, labels, share, clusters):
    stats = L.cluster_stats(spark.createDataFrame([(c,) for c in labels], "cluster_id int")).first()
    assert (stats.noise_fraction, stats.n_clusters, stats.total_points) == (share, clusters, len(labels))


def test_centroid_of_one_member_and_of_none(spark):
    rows = [(0 if i == 0 else -1, [1.0 if j == i else 0.0 for j in range(5)]) for i in range(5)]
    frame = spark.createDataFrame(rows, "cluster_id int, embedding array<float>")
    assert L.compute_centroid(frame, 0, 5).first().centroid == [1.0, 0.0, 0.0, 0.0, 0.0]
    assert L.compute_centroid(frame, 3, 5).first().centroid == [0.0] * 5


def test_clusterer_separates_and_marks_noise(spark):
    rng = np.random.default_rng(9)
    rows = [
        (f"c{i}", [float(x) for x in rng.normal(size=16) * 0.05 + (np.eye(16)[i % 3] * 5)])
        for i in range(90)
    ]
    points = spark.createDataFrame(rows, "chunk_id string, embedding array<float>")
    out = L.ThemeClusterer(k=3, noise_fraction=0.1).fit_predict(points).collect()
    assert len(out) == 90 and {r.cluster_id for r in out} == {-1, 0, 1, 2}
    kinds = {}
    for r in out:
        if r.cluster_id >= 0:
            kinds.setdefault(int(r.chunk_id[1:]) % 3, set()).add(r.cluster_id)
    assert all(len(v) == 1 for v in kinds.values())
    plain = L.ThemeClusterer(min_cluster_size=20).fit_predict(points)
    assert plain.filter("cluster_id >= 0").select("cluster_id").distinct().count() == 3


def _groups(spark, n_groups, each, far=()):
    rng = np.random.default_rng(9)
    rows = [
        ("a", f"c{i}", [float(x) for x in rng.normal(size=16) * 0.05 + np.eye(16)[i % n_groups] * 5])
        for i in range(n_groups * each)
    ]
    rows += [("a", f"far{i}", [float(x) for x in v]) for i, v in enumerate(far)]
    return spark.createDataFrame(rows, "accession_number string, chunk_id string, embedding array<float>")


def test_default_clusterer_finds_the_groups_there_are(spark):
    out = L.ThemeClusterer().fit_predict(_groups(spark, 8, 100)).collect()
    found = {}
    for r in out:
        found.setdefault(r.cluster_id, set()).add(int(r.chunk_id[1:]) % 8)
    assert len(out) == 800 and sorted(found) == list(range(8)) and all(len(v) == 1 for v in found.values())
    far = L.ThemeClusterer().fit_predict(_groups(spark, 4, 60, [np.full(16, 40.0)])).collect()
    assert {r.chunk_id for r in far if r.cluster_id == -1} == {"far0"}


def test_few_points_are_one_cluster(spark):
    rng = np.random.default_rng(2)
    rows = [(f"c{i}", [float(x) for x in rng.normal(size=4)]) for i in range(30)]
    points = spark.createDataFrame(rows, "chunk_id string, embedding array<float>")
    got = L.ThemeClusterer(min_cluster_size=40).fit_predict(points).collect()
    assert len(got) == 30 and {r.cluster_id for r in got} <= {-1, 0}
    one = L.ThemeClusterer(k=1).fit_predict(points).collect()
    assert {r.cluster_id for r in one} <= {-1, 0}


def test_density_parameters():
    assert L.density_parameters("small") == {"min_cluster_size": 15, "min_samples": 5}
    assert L.density_parameters("other") == {"min_cluster_size": 40, "min_samples": 8}


@pytest.fixture(scope="module")
def tracker(spark, intensity):
    themes = spark.createDataFrame(LABELS, "cluster_id int, cluster_label string")
    return ThemeTracker(intensity, C.compute_yoy_changes(intensity), themes)


def test_tracker_lookups(tracker):
    assert tracker.get_company_timeline("0001234").count() == 6
    assert tracker.get_theme_trajectory(0).count() == 4
    assert tracker.get_theme_trajectory(0, "0001234").count() == 2
    for call in (
        lambda: tracker.get_company_timeline("nope"),
        lambda: tracker.get_theme_trajectory(99),
        lambda: tracker.get_theme_trajectory(0, "nope"),
    ):
        with pytest.raises(KeyError):
            call()


def test_tracker_summaries(tracker):
    emerging = tracker.get_emerging_themes(2022, 2).collect()
    assert len(emerging) == 3 and all(r.company_count == 2 for r in emerging)
    assert tracker.get_emerging_themes(2022, 99).count() == 0
    assert tracker.get_fading_themes(2023).count() == 0
    prevalence = tracker.get_theme_prevalence().collect()
    assert [r.peak_intensity_year for r in prevalence] == [2022] * 3
    stats = tracker.get_corpus_stats()
    assert (stats["total_companies"], stats["total_years"], stats["total_themes"],
            stats["total_filings"], stats["total_chunks"]) == (2, 2, 3, 4, 40)
    assert stats["change_type_counts"] == {"new": 6, "stable": 6}
    assert stats["mean_themes_per_filing"] == 3.0


def test_tracker_needs_its_columns(tracker, intensity):
    with pytest.raises(ValueError, match="cluster_label"):
        ThemeTracker(intensity, tracker.changes, tracker.themes.drop("cluster_label"))


def test_ranking_is_made_only_when_asked_for(spark, monkeypatch):
    made = []
    monkeypatch.setattr(P.C, "top_changes", lambda changes, drift, top: made.append(top) or changes)
    rows = [(str(i), "a", 2020 + i % 2, "x", i % 3) for i in range(12)]
    chunks = spark.createDataFrame(rows, "chunk_id string, cik string, fiscal_year int, accession_number string, cluster_id int")
    found = P.drift_plan(chunks, top=7)
    assert found.changes.count() == 6 and made == []
    assert found.ranked is found.ranked and made == [7]
