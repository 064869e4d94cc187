from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontaminate as D

DOCS = "doc_id long, text string, w string, item_id int, start int"
ITEMS = "item_id long, text string, g string, n int"


def split(text):
    return (text or "").encode().lower().decode().replace("\x0b", " ").split() if text else []


def grams(words):
    k = min(5, len(words))
    return [tuple(words[i : i + k]) for i in range(len(words) - k + 1)] if words else []


def brute(docs, items):
    best = {}
    for doc_id, text in docs:
        w = split(text)
        for item_id, item in items:
            v = split(item)
            if not v or not w:
                continue
            k, g = min(5, len(v)), grams(v)
            starts = {
                max(0, min(i - o, len(w) - len(v)))
                for i in range(len(w) - k + 1) for o, x in enumerate(g) if tuple(w[i : i + k]) == x
            }
            for s in starts:
                a, b = Counter(grams(w[s : s + len(v)])), Counter(g)
                both = sum((a & b).values())
                total = sum((a | b).values())
                if 100 * both >= 75 * total:
                    key = (doc_id, item_id)
                    best[key] = max(best.get(key, (0, -(10**9))), (both / total, -s))
    return sorted(((d, i, -s, sim) for (d, i), (sim, s) in best.items()), key=str)


def run(spark, docs, items):
    left = spark.createDataFrame([(*d, "x", 1, 2) for d in docs], DOCS)
    right = spark.createDataFrame([(*i, "x", 1) for i in items], ITEMS)
    return sorted(map(tuple, D.contaminated(left, right).collect()), key=str)


def example():
    rnd = random.Random(5)
    word = lambda: f"W{rnd.randrange(900)}é"
    items = [(i, " ".join(word() for _ in range(rnd.choice([3, 5, 8, 20, 45])))) for i in range(25)]
    items += [(100, None), (101, ""), (102, "the the the the the the the the"), (None, items[4][1]), (3, items[3][1])]
    docs = []
    for i in range(160):
        body = [word() for _ in range(rnd.randrange(0, 120))]
        for _ in range(rnd.randrange(3)):
            part = split(rnd.choice(items)[1])
            for _ in range(rnd.randrange(4)):
                kind = rnd.randrange(3)
                at = rnd.randrange(len(part)) if part else 0
                part = part[:at] + ([word()] if kind < 2 else []) + part[at + (kind != 1) :]
            at = rnd.randrange(len(body) + 1)
            body[at:at] = part
        docs.append((i, "\t".join(body).upper() if i % 7 == 0 else " \n".join(body)))
    docs += [(500, None), (501, " "), (None, items[7][1]), (502, items[6][1] + " z" * 150_000), (7, docs[7][1])]
    docs += [(503, "the " * 400), (504, " ".join(split(items[8][1])[1:]))]
    return docs, items


def test_against_brute_force(spark):
    docs, items = example()
    want = brute(docs, items)
    assert len(want) > 40 and run(spark, docs, items) == want


def test_large_benchmarks_are_met_in_slices(spark, monkeypatch):
    monkeypatch.setattr(D, "BROADCAST_ROWS", 150)
    docs, items = example()
    assert run(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = example()
    assert run(spark, [], items) == [] and run(spark, docs, []) == [] and run(spark, [], []) == []


def test_documents_go_as_a_whole(spark):
    docs, items = example()
    left = spark.createDataFrame([(*d, "x", 1, 2) for d in docs], DOCS)
    right = spark.createDataFrame([(*i, "x", 1) for i in items], ITEMS)
    gone = {d for d, *_ in brute(docs, items)}
    got = D.decontaminate(left, right)
    assert got.columns == left.columns
    assert sorted((r.doc_id for r in got.collect()), key=str) == sorted((d for d, _ in docs if d not in gone), key=str)


def test_index_holds_every_print_within_the_radius(spark):
    rnd = random.Random(2)
    prints = [rnd.getrandbits(64) - 2**63 for _ in range(20)]
    items = spark.createDataFrame([(i, i, p) for i, p in enumerate(prints)], "item_id long, item long, item_print long")
    index = {(r.item_id, r.block, r.key) for r in D._index(items).collect()}
    for i, p in enumerate(prints):
        for _ in range(50):
            q = (p & (2**64 - 1)) ^ sum(1 << b for b in rnd.sample(range(64), D.RADIUS))
            assert any((i, k, q >> 8 * k & 255) in index for k in range(D.BLOCKS))


@pytest.mark.parametrize("n", [1, 7, 60])
def test_simhash(spark, n):
    rnd = random.Random(n)
    h = [rnd.getrandbits(64) - 2**63 for _ in range(n)] * 2
    want = sum(1 << b for b in range(64) if sum((x >> b & 1) * 2 - 1 for x in h) > 0)
    got = spark.createDataFrame([(h,)], "h array<long>").select(D.simhash("h").alias("p")).first().p
    assert got & (2**64 - 1) == want


def test_windows_of_every_start(spark):
    """Edits at both ends and an insertion between: no shared shingle keeps its place in the best window."""
    item = [f"i{k}" for k in range(80)]
    cut = ["x0", "x1", *item[2:40], "new", *item[40:78], "y0", "y1"]
    rnd = random.Random(8)
    docs, items = [(1, " ".join(cut)), (2, " ".join(item[:60]))], [(7, " ".join(item))]
    for i in range(3, 60):
        part = list(item)
        for _ in range(rnd.randrange(1, 4)):
            at = rnd.randrange(len(part))
            part[at : at + rnd.randrange(2)] = ["z"] * rnd.randrange(3)
        docs.append((i, " ".join(["a"] * rnd.randrange(4) + part + ["b"] * rnd.randrange(4))))
    best = {}
    for doc_id, text in docs:
        w, own = split(text), Counter(grams(item))
        for s in range(max(0, len(w) - len(item)) + 1):
            a = Counter(grams(w[s : s + len(item)]))
            similarity = sum((a & own).values()) / sum((a | own).values())
            if similarity >= 0.75:
                best[doc_id] = max(best.get(doc_id, 0), similarity)
    assert {d: similarity for d, _, _, similarity in run(spark, docs, items)} == best and len(best) > 20


def test_copy_that_no_placed_window_holds(spark):
    """Every window in which a shared shingle has its place is below the threshold, one between is above."""
    item = [f"i{k}" for k in range(50)]
    text = ["p", "q", *item[1:25], "new", "new2", *item[25:49], "r", "s"]
    docs, items = [(1, " ".join(text))], [(7, " ".join(item))]
    assert brute(docs, items) == []
    ((doc_id, item_id, start, similarity),) = run(spark, docs, items)
    a, b = Counter(grams(text[start : start + 50])), Counter(grams(item))
    assert (doc_id, item_id) == (1, 7) and similarity == sum((a & b).values()) / sum((a | b).values()) >= 0.75
