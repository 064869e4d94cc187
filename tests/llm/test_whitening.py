from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, x int, component string"


def brute(rows, components=4):
    """Plain numpy over all rows; eigenvectors by another routine."""
    kept = []
    for i, v in rows:
        if v and all(c is not None and math.isfinite(c) and abs(c) < 2**54 for c in v):
            kept.append((i, [math.floor(256 * float(np.float32(c))) for c in v]))
    sizes = [len(x) for _, x in kept]
    size = max(set(sizes), key=lambda s: (sizes.count(s), s)) if sizes else 0
    kept = [(i, x) for i, x in kept if len(x) == size]
    fit = sorted({tuple(x) for _, x in kept})
    n = len(fit)
    if n < 2:
        return {}
    total = [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * a - s) / n for a, s in zip(x, total)] for x in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1].T
    out = []
    for i, x in kept:
        away = sum((n * a - s) ** 2 for a, s in zip(x, total))
        centre = np.array([a - s / n for a, s in zip(x, total)])
        for k in range(min(components, size)):
            if values[k] > 1e-9 * values[0]:
                out.append((i, k + 1, n, away, centre @ vectors[k] / values[k] ** 0.5, values[k] / values.sum()))
    return out


def check(spark, rows):
    df = spark.createDataFrame([(i, v, 7, "c") for i, v in rows], SCHEMA).repartition(3)
    got, want = W.whiten(df).collect(), brute(rows)
    assert len(got) == len(want)
    order = lambda r: (str(r[0]), r[1], r[3], round(abs(r[4]), 6))
    got, want = sorted(map(tuple, got), key=order), sorted(want, key=order)
    sign = {}
    for g, w in zip(got, want):
        assert g[:3] == w[:3]
        assert g[7] == str(w[3]) and g[3] == (w[3] if w[3] < 2**63 else None)
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] < 1e-9
        assert abs(g[4]) == pytest.approx(abs(w[4]), rel=1e-6, abs=1e-7)
        if abs(g[4]) > 1e-3:
            assert sign.setdefault(g[1], g[4] * w[4] > 0) == (g[4] * w[4] > 0)
    return got


def test_given_vectors_equal_plain_numpy(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r["vec_id"], list(map(float, r["embedding"]))) for r in table.collect()]
    check(spark, rows)


def test_copies_nulls_lengths_and_bad_entries(spark):
    rng = np.random.default_rng(3)
    rows = [(i, list(map(float, rng.normal(size=6) * [9, 5, 3, 2, 1, 1]))) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(40)] + [(5, rows[5][1]), (None, rows[7][1]), (None, None)]
    rows += [(200, None), (201, []), (202, [None] * 6), (203, [math.nan] + [0.0] * 5), (204, [math.inf] * 6)]
    rows += [(205, [1.0, 2.0]), (206, [-0.0] * 6), (207, [1e30] * 6)]
    check(spark, rows)


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(v) for v in rng.integers(-(2**46), 2**46, size=5)]) for i in range(50)]
    assert any(g[3] is None for g in check(spark, rows))


def test_fewer_dimensions_than_components_and_equal_eigenvalues(spark):
    check(spark, [(i, [float(i), 2.0 * i, 3.0]) for i in range(10)])
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(np.vstack([np.eye(4), -np.eye(4)]))]
    got = W.whiten(spark.createDataFrame([(i, v, 0, "") for i, v in rows], SCHEMA)).collect()
    assert len(got) == 32 and all(r["explained"] == pytest.approx(0.25) and r["identity_error"] < 1e-9 for r in got)


def test_one_vector_and_empty_table(spark):
    assert W.whiten(spark.createDataFrame([(1, [1.0, 2.0], 0, ""), (2, [1.0, 2.0], 0, "")], SCHEMA)).collect() == []
    empty = W.whiten(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and empty.columns[:2] == ["vec_id", "component"]


def test_result_does_not_depend_on_the_partitions(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    first = W.whiten(table).orderBy("vec_id", "component").drop("identity_error").collect()
    again = W.whiten(table.repartition(5, F.rand(1))).orderBy("vec_id", "component").drop("identity_error").collect()
    assert first == again


def test_factor_and_rotations():
    rng = np.random.default_rng(5)
    for size, rank in ((7, 7), (6, 3), (1, 1), (5, 0)):
        half = rng.normal(size=(size, rank)) * 10.0 ** rng.integers(-4, 4, size=rank)
        matrix = half @ half.T
        factor, order = W.pivoted_cholesky(matrix)
        assert factor.shape == (size, rank) and np.allclose(np.triu(factor[:rank], 1), 0)
        assert np.allclose(factor @ factor.T, matrix[np.ix_(order, order)], rtol=1e-9, atol=1e-9 * (np.abs(matrix).max(initial=0)))
        turned = W.orthogonal_columns(factor)
        square = turned @ turned.T
        assert np.allclose(np.sort(square.diagonal())[::-1], np.linalg.eigvalsh(matrix)[::-1][:rank])
        lengths = np.sqrt(square.diagonal())
        assert np.abs(square / np.outer(lengths, lengths) - np.eye(rank)).max(initial=0) < 1e-13 if rank else True


def test_exact_products_of_any_size():
    rng = np.random.default_rng(6)
    for bits in (5, 25, 45, 62):
        rows = rng.integers(-(2**bits), 2**bits, size=(30, 3))
        sums = W.ExactProducts(3)
        sums.add(rows[:11])
        sums.add(rows[11:])
        whole = rows.astype(object)
        assert (sums.close() == whole.T @ whole).all()
