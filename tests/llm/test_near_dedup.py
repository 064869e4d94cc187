from __future__ import annotations

import random

import numpy as np
import pytest

from tidemark.llm import near_dedup as N
from tidemark.llm.graph import components

SCHEMA = "doc_id long, text string, component long, bands string"


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def closure(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    return {n: root(n) for n in nodes}


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {(a, b) for ids in holders.values() for k, a in enumerate(ids) for b in ids[:k]}
    links = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    found = closure(sets, links)
    return sorted((i, len(sets[i]), found[i], found[i] == i) for i in sets)


def run(spark, rows):
    return sorted(map(tuple, N.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)


def corpus(seed, n_base=12, copies=14):
    """Groups whose copies drift away step by step, so that links form chains."""
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(4000)}"
    out = []
    for _ in range(n_base):
        words = [word() for _ in range(rnd.choice([4, 7, 30, 120, 400]))]
        for _ in range(copies):
            out.append(" ".join(words))
            for _ in range(rnd.randrange(0, 1 + len(words) // 30)):
                words[rnd.randrange(len(words))] = word()
    rnd.shuffle(out)
    return list(enumerate(out))


def test_chains_against_brute_force(spark):
    rows = corpus(1)
    assert run(spark, [(i, t, 1, "x") for i, t in rows]) == sorted(brute(rows), key=str)


def test_hot_copies_and_outsiders_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 8)
    base = [f"b{i}" for i in range(60)]
    rows = [(i, " ".join(base)) for i in range(150)]
    rnd = random.Random(3)
    for i in range(150, 330):
        words = list(base)
        for _ in range(rnd.randrange(1, 4)):
            words[rnd.randrange(60)] = f"x{rnd.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    rnd.shuffle(rows)
    rows = [(k, t) for k, (_, t) in enumerate(rows)]
    assert run(spark, [(i, t, 1, "x") for i, t in rows]) == sorted(brute(rows), key=str)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, N.near_duplicates(docs).collect())) == brute(rows)


def test_edge_rows(spark):
    rows = [
        (1, None, 1, "x"), (2, "", 1, "x"), (3, " \n\t", 1, "x"), (4, "One two", 1, "x"), (5, "one\x0btwo", 1, "x"),
        (6, "one two É", 1, "x"), (7, "one two é", 1, "x"), (8, "y " * 100_000, 1, "x"), (9, "Y " * 90_000, 1, "x"),
        (None, "one two", 1, "x"), (None, "alone here", 1, "x"), (None, None, 1, "x"), (9, "y " * 4, 1, "x"),
    ]
    got = run(spark, rows)
    want = [
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True),
        (7, 1, 7, True), (8, 1, 8, True), (9, 1, 8, False), (None, 1, 4, False), (None, 1, None, True),
        (None, 0, None, True), (9, 1, 9, True),
    ]
    assert got == sorted(want, key=str)
    assert run(spark, []) == []


@pytest.mark.parametrize("n", [1, 3, 40, 900])
def test_sketch_fills_and_estimates(n):
    rng = np.random.default_rng(n)
    pool = rng.integers(1, 2**63, 2 * n, dtype=np.uint64)
    a, b = np.unique(pool[: int(1.5 * n)]), np.unique(pool[int(0.2 * n) :])
    x, y = N.sketch(a), N.sketch(b)
    assert x.max() < np.iinfo(np.uint64).max and (N.sketch(a) == x).all()
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((x == y).mean() - true) < 0.2
    assert (N.sketch(a) == N.sketch(a[::-1])).all()


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(70)] + [(1000, i) for i in range(2000, 2300)] + [(5, 5)]
    random.Random(1).shuffle(edges)
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = closure({x for e in edges for x in e}, edges)
    assert {r.node: r.component for r in got} == want and len(got) == len(want)
