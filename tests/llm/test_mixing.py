from __future__ import annotations

import itertools
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing as M

SCHEMA = "doc_id long, text string, source string, size string, key int, taken int"


def targets(sizes):
    """Water filling by hand: stop what is above its limit, share the rest again."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    budget, stopped = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in stopped]
        if not free:
            return stopped
        level = (budget - sum(stopped.values())) / sum(weight[s] for s in free)
        above = [s for s in free if level * weight[s] > 2 * sizes[s]]
        if not above:
            return stopped | {s: level * weight[s] for s in free}
        stopped |= {s: 2.0 * sizes[s] for s in above}


def check(spark, rows, parts=4, near=0.5):
    df = spark.createDataFrame([(*r, "s", 1, 2) for r in rows], SCHEMA).repartition(parts)
    got = M.mix(df)
    assert got.dtypes == [("doc_id", "bigint"), ("size", "bigint"), ("source_size", "bigint"), ("target", "double"), ("taken", "bigint")]
    found = got.collect()
    words = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    sizes = defaultdict(int)
    for (_, _, s), n in zip(rows, words):
        sizes[s] += n
    want = targets(sizes)
    key = lambda r: tuple(map(str, r))
    assert sorted(((r[0], r[1], r[2], round(r[3], 6)) for r in found), key=key) == sorted(
        ((i, n, sizes[s], round(want[s], 6)) for (i, _, s), n in zip(rows, words)), key=key
    )
    assert all(r["taken"] in {0, r["size"], 2 * r["size"]} for r in found)
    mixed = defaultdict(int)
    for r in found:
        mixed[r["source_size"], round(r["target"], 6)] += r["taken"]
    if len({(n, round(want[s], 6)) for s, n in sizes.items()}) == len(sizes):
        for s, n in sizes.items():
            assert abs(mixed[n, round(want[s], 6)] - want[s]) <= near, s
    again = M.mix(df.repartition(parts + 2, F.rand(3)))
    assert sorted(map(tuple, again.collect()), key=key) == sorted(map(tuple, found), key=key)
    return found


def some_rows(rng, n, sources, least=1, most=40):
    return [(i, " ".join(["w"] * rng.randrange(least, most)), rng.choice(sources)) for i in range(n)]


def test_given_documents_come_to_their_targets(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in table.select("doc_id", "text", "source").collect()]
    # A target a few words below the limit can only be met as far as there are texts of a few words.
    check(spark, rows, near=2)


def test_hot_source_hot_length_nulls_and_repeats(spark):
    rng = random.Random(1)
    rows = some_rows(rng, 300, ["a", "b", "ä", "z", None, ""])
    rows += [(1000 + i, "seven words are in this text here", "hot") for i in range(400)]
    rows += [(7, "same id", "b")] * 30 + [(None, "x y", "a")] * 20 + [(8, None, None), (9, "", "b"), (None, None, None)]
    rows += [(5000, "long " * 100_000, "ä"), (5001, "word\x0bword word", "z")]
    # Nothing between 102,072 and 200,000 words can be made of the source with the long text.
    check(spark, rows, near=46_000)
    # All texts of the hot source have seven words.
    check(spark, [r for r in rows if r[0] != 5000], near=3.5)


def test_sources_at_their_limit(spark):
    rows = some_rows(random.Random(2), 200, ["d"]) + [(1000 + i, "a b c", s) for i, s in enumerate("abc")]
    found = check(spark, rows)
    assert [r["taken"] for r in found if r["source_size"] == 3] == [6, 6, 6]


def test_no_words_and_empty_table(spark):
    assert all(r["taken"] == 0 and r["target"] == 0.0 for r in check(spark, [(1, None, "a"), (2, " \t", None)]))
    assert check(spark, []) == []


def test_knapsack_equals_all_subsets():
    rng = random.Random(3)
    for _ in range(200):
        lengths = rng.sample(range(1, 30), rng.randrange(1, 5))
        counts = [rng.randrange(0, 4) for _ in lengths]
        budget = rng.random() * 60
        got = M.knapsack(lengths, counts, budget)
        assert all(0 <= g <= c for g, c in zip(got, counts))
        sums = {sum(a * b for a, b in zip(lengths, pick)) for pick in itertools.product(*[range(c + 1) for c in counts])}
        best = min(abs(s - budget) for s in sums)
        assert abs(sum(a * b for a, b in zip(lengths, got)) - budget) == pytest.approx(best)


def test_large_counts_keep_the_share_of_every_length():
    lengths = [*range(1, 3000), 50_000, 400_000]
    counts = [10**9 + 7 * n for n in lengths]
    words = sum(a * b for a, b in zip(lengths, counts))
    budget = 0.37 * words
    got = M.fitted(lengths, counts, budget)
    assert all(abs(g / c - 0.37) < 1e-4 for g, c in zip(got, counts))
    assert abs(sum(a * b for a, b in zip(lengths, got)) - int(budget)) <= 1
    assert M.fitted([5], [3], 15.0) == [3] and M.fitted([], [], 0.0) == []
