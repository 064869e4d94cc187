"""Density clusters against plain loops over all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import clustering as L
from tidemark.operators import density as D
from tidemark.operators import neighbours as N
from tidemark.session import LARGEST_ESTIMATE, cut_lineage, estimated_bytes


def _points(spark, matrix):
    rows = [(i, None if v is None else [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, "key long, v array<double>").repartition(4)


def _groups(rng, sizes, dimension=4, spread=0.3):
    middles = rng.normal(size=(len(sizes), dimension)) * 6
    return np.vstack([rng.normal(size=(n, dimension)) * spread + m for n, m in zip(sizes, middles)])


def _reachability(vectors, weights, min_samples):
    gap = N.distances(vectors, vectors)
    core = []
    for i, row in enumerate(gap):
        others = sorted([(0.0, weights[i] - 1)] + [(d, weights[j]) for j, d in enumerate(row) if j != i])
        seen, reach = 0, 0.0
        for d, w in others:
            if seen >= min_samples:
                break
            seen, reach = seen + w, d if w else reach
        core.append(reach)
    core = np.array(core)
    return np.maximum(np.maximum(gap, core[:, None]), core[None, :]), core


def _plain_tree(reach):
    n = len(reach)
    edges = sorted((reach[i, j], i, j) for i in range(n) for j in range(i + 1, n))
    top, found = list(range(n)), []

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for w, i, j in edges:
        a, b = find(i), find(j)
        if a != b:
            top[a] = b
            found.append((i, j, w))
    return found


def _in_order(spark, matrix, min_samples):
    """The graph of the library, and its vertices as plain arrays in the order of their ids."""
    nodes, cells = D.graph(_points(spark, matrix), "v", min_samples)
    rows = nodes.orderBy("id").collect()
    return nodes, cells, rows, {r["id"]: i for i, r in enumerate(rows)}


@pytest.mark.parametrize("case", ["groups", "spread", "copies", "all on Spark"])
def test_tree_equals_the_tree_over_all_pairs(spark, case, monkeypatch):
    rng = np.random.default_rng(11)
    if case == "all on Spark":
        monkeypatch.setattr(D, "LOCAL_ROWS", 0)
    matrix = {
        "all on Spark": _groups(rng, [20, 18, 17, 3]),
        "groups": _groups(rng, [120, 90, 60, 40, 30, 8, 2]),
        "spread": rng.normal(size=(500, 5)),
        "copies": np.round(_groups(rng, [60, 50, 40], 2, 1.0), 1),
    }[case]
    nodes, cells, rows, number = _in_order(spark, matrix, 5)
    vectors = np.array([r["v"] for r in rows])
    reach, core = _reachability(vectors, [r["weight"] for r in rows], 5)
    assert np.array_equal(core, [r["core"] for r in rows])
    for i, r in enumerate(rows):
        gap = [(d, rows[j]["id"]) for j, d in enumerate(N.distances(vectors[i : i + 1], vectors)[0]) if j != i]
        assert [(x["d"], x["n"]) for x in r["near"]] == sorted(gap)[:15]
    got = sorted((number[r["lo"]], number[r["hi"]], r["w"]) for r in D.spanning_tree(nodes, cells).collect())
    assert got == sorted(_plain_tree(reach))


def _plain_clusters(reach, weights, core, least):
    """Condensed hierarchy over the sorted tree, one edge at a time."""
    n = len(reach)
    tree = sorted(((w, i, j) for i, j, w in _plain_tree(reach)))
    below, rows = [{i} for i in range(n)], list(weights)
    kids, split, top = [()] * n, list(core), list(range(n))
    dense_at = [core[i] if weights[i] >= least else math.inf for i in range(n)]

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for w, i, j in tree:
        a, b = find(i), find(j)
        for side in (a, b):
            if rows[side] < least <= rows[a] + rows[b]:
                for v in below[side]:
                    dense_at[v] = w
        node = len(below)
        below.append(below[a] | below[b])
        rows.append(rows[a] + rows[b])
        kids.append((a, b))
        split.append(w)
        top += [node]
        top[a] = top[b] = node
    inverse = lambda d: 1.0 / max(d, D.LEAST_DISTANCE)

    def condense(node, birth):
        """(stability, chosen sets) of the cluster that ``node`` starts, its own set included first."""
        # What joins only at the distance of the split itself is the parent's.
        start, own = {v for v in below[node] if inverse(dense_at[v]) > birth}, 0.0
        while True:
            if not kids[node]:
                own += rows[node] * (inverse(split[node]) - birth)
                return own, [start], own
            a, b = kids[node]
            at = inverse(split[node])
            big = [k for k in (a, b) if rows[k] >= least]
            own += sum(rows[k] for k in (a, b) if k not in big) * (at - birth)
            if len(big) == 1:
                node = big[0]
                continue
            if not big:
                return own, [start], own
            own += sum(rows[k] for k in big) * (at - birth)
            parts = [condense(k, at) for k in big]
            under = sum(p[0] for p in parts)
            chosen = [s for p in parts for s in p[1]]
            return (own, [start], own) if own >= under else (under, chosen, own)

    node = len(below) - 1
    if rows[node] < least:
        return []
    while kids[node]:
        big = [k for k in kids[node] if rows[k] >= least]
        if len(big) == 2:
            at = inverse(split[node])
            return [s for k in big for s in condense(k, at)[1]]
        if not big:
            return []
        node = big[0]
    return []


@pytest.mark.parametrize("case", ["groups", "nested", "copies", "noise"])
def test_clusters_equal_the_plain_hierarchy(spark, case):
    rng = np.random.default_rng(5)
    matrix = {
        "groups": np.vstack([_groups(rng, [60, 40, 30]), rng.normal(size=(40, 4)) * 8]),
        "nested": np.vstack([_groups(rng, [50, 50], 2, 0.2) * 0.15, _groups(rng, [60], 2, 0.3) + 9, rng.normal(size=(20, 2)) * 4]),
        "copies": np.vstack([np.round(_groups(rng, [60, 50, 40], 2, 0.8), 1), np.tile([3.0, 3.0], (25, 1))]),
        "noise": rng.random(size=(150, 6)),
    }[case]
    _, _, rows, _ = _in_order(spark, matrix, 5)
    vectors = [tuple(r["v"]) for r in rows]
    weights = [r["weight"] for r in rows]
    reach, core = _reachability(np.array(vectors), weights, 5)
    want = sorted(sorted(s) for s in _plain_clusters(reach, weights, core, 15))
    found = {}
    out = D.density_clusters(_points(spark, [*matrix, None]), "v", 15, 5).collect()
    assert len(out) == len(matrix) + 1
    for r in out:
        if r["v"] is None:
            assert r["cluster_id"] == -1
        elif r["cluster_id"] >= 0:
            found.setdefault(r["cluster_id"], set()).add(vectors.index(tuple(r["v"])))
    assert sorted(sorted(s) for s in found.values()) == want
    assert sorted(found) == list(range(len(want)))


def test_small_inputs(spark):
    assert D.density_clusters(_points(spark, []), "v", 5, 3).collect() == []
    one = D.density_clusters(_points(spark, [[1.0, 2.0]] * 3), "v", 2, 2).collect()
    assert [r["cluster_id"] for r in one] == [-1] * 3
    assert {r["cluster_id"] for r in D.density_clusters(_points(spark, np.eye(4)), "v", 5, 3).collect()} == {-1}


def test_neighbour_graph_recall(spark):
    """Over all given vectors, against the exact lists; and lists are lists: in order, without repeats."""
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    placed, cells = N.dealt_to_cells(D.vertices(table, "embedding"), 64)
    graph, rounds = N.neighbour_graph(placed, 15)
    exact = N.nearest_neighbours(placed, cells, 15)
    assert N.recall(graph, exact) >= 0.9 and 1 < rounds <= 12
    for r in graph.collect():
        ids = [x["n"] for x in r["near"]]
        assert len(set(ids)) == len(ids) == 15 and r["id"] not in ids
        assert [(x["d"], x["n"]) for x in r["near"]] == sorted((x["d"], x["n"]) for x in r["near"])


def test_estimated_size_does_not_grow_in_loops_of_joins(spark):
    """A join multiplies the estimates of its sides: digits doubled with every round."""
    state = cut_lineage(spark.range(20).select("id", (F.col("id") + 1).alias("root")))
    for _ in range(8):
        ahead = state.select(F.col("id").alias("root"), F.col("root").alias("next"))
        state = cut_lineage(state.join(ahead, "root", "left").select("id", F.coalesce("next", "root").alias("root")))
        assert estimated_bytes(state) <= LARGEST_ESTIMATE
    assert sorted((r["id"], r["root"]) for r in state.collect()) == [(i, 20) for i in range(20)]


def test_no_row_per_query_and_cell(spark, monkeypatch):
    """Lists with cells, blocks and ties: whole, though queries and vectors cross block borders."""
    monkeypatch.setattr(N, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(3)
    matrix = np.vstack([np.round(_groups(rng, [50, 40], 3, 1.0), 1) + 1e4, np.zeros((1, 3))])
    placed, cells = N.dealt_to_cells(D.vertices(_points(spark, matrix), "v"), 3)
    assert not hasattr(N, "visiting")
    rows = placed.orderBy("id").collect()
    vectors, ids = np.array([r["v"] for r in rows]), [r["id"] for r in rows]
    got = {r["id"]: [(x["d"], x["n"]) for x in r["near"]] for r in N.nearest_neighbours(placed, cells, 5).collect()}
    away = N.distances(vectors, vectors)
    assert got == {ids[i]: sorted((away[i, j], n) for j, n in enumerate(ids) if j != i)[:5] for i in range(len(ids))}


def test_chains_of_small_groups_are_contracted_together(spark, monkeypatch):
    """A chain that ends at a dense group needs few rounds, and the groups are those of one process."""
    rounds = []
    monkeypatch.setattr(D, "_roots", lambda pointers, real=D._roots: rounds.append(1) or real(pointers))
    edges = [(i, i + 1, 1.0 + i / 100) for i in range(40)] + [(40, 50, 9.0)] + [(i, i + 1, 2.0 + i / 100) for i in range(50, 60)]
    nodes = spark.createDataFrame([(i, 1, 0.5) for i in [*range(41), *range(50, 61)]], "id bigint, weight bigint, core double")
    tree = spark.createDataFrame(edges, "lo bigint, hi bigint, w double")

    def found():
        members, joins = D.dense_groups(nodes, tree, 5)
        groups = {}
        for r in members.collect():
            groups.setdefault(r["comp"], set()).add((r["id"], r["left_at"]))
        return sorted(sorted(g) for g in groups.values()), sorted(r["w"] for r in joins.collect())

    want = found()
    monkeypatch.setattr(D, "LOCAL_ROWS", 0)
    assert found() == want and len(want[0]) == 2 and 0 < len(rounds) <= 6
    # The last rounds in one process.
    monkeypatch.setattr(D, "LOCAL_ROWS", 49)
    assert found() == want
