from __future__ import annotations

import random

import pytest

from tidemark.llm import line_dedup as L

SCHEMA = "doc_id long, text string, doc long, kept string, n_lines string"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def unlike(a, b, edits):
    """Necessary for a small distance: few edits leave all but a few characters in both."""
    common = sum(min(a.count(c), b.count(c)) for c in set(a))
    return common >= max(len(a), len(b)) - edits


def brute(rows, edits):
    """Every pair of lines, in order of id (null first) and line number; ids are unique here."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    earlier, out = [], {}
    for doc_id, text in order:
        left = []
        for line in (text or "").split("\n"):
            long = len(line) >= L.LEAST_LINE
            if not long or not any(abs(len(x) - len(line)) <= edits and (x == line or unlike(x, line, edits) and distance(x, line) <= edits) for x in earlier):
                left.append(line)
            if long and line not in earlier:
                earlier.append(line)
        out[doc_id] = ("\n".join(left) if text is not None else None, len(left))
    return out


def mutated(rnd, line):
    chars = list(line)
    for _ in range(rnd.randrange(4)):
        at = rnd.randrange(max(1, len(chars)))
        kind = rnd.randrange(3) if chars else 1
        if kind == 0:
            chars[at] = rnd.choice("abé漢")
        elif kind == 1:
            chars.insert(at, rnd.choice("abé漢"))
        elif len(chars) > 1:
            del chars[at]
    return "".join(chars)


@pytest.mark.parametrize("k", [1, 2, 3, 5])
def test_banded_distance(k):
    rnd = random.Random(k)
    for _ in range(4000):
        a = "".join(rnd.choice("ab") for _ in range(rnd.randrange(0, 24)))
        b = mutated(rnd, mutated(rnd, a)) if a and rnd.random() < 0.7 else "".join(rnd.choice("ab") for _ in range(rnd.randrange(0, 24)))
        assert L.within(a, b, k) == (distance(a, b) <= k), (a, b)
        if k < len(a) and len(a) - k <= len(b) <= len(a):
            got = L._banded(a, b, k)
            assert (got == distance(a, b)) if distance(a, b) <= k else got > k


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_segments_cover_and_probes_complete(edits):
    """Of two lines within the distance, one probe of the longer meets a segment of the shorter."""
    rnd = random.Random(edits)
    for _ in range(3000):
        a = "".join(rnd.choice("abc") for _ in range(rnd.randrange(edits + 1, 30)))
        cuts = [L.segment(len(a), i, edits) for i in range(edits + 1)]
        assert sum(w for _, w in cuts) == len(a) and all(s + w == t for (s, w), (t, _) in zip(cuts, cuts[1:]))
        b = mutated(rnd, a)
        if len(b) < len(a) or distance(a, b) > edits:
            continue
        delta = len(b) - len(a)
        assert any(
            0 <= s + d and a[s : s + w] == b[s + d : s + d + w]
            for i, (s, w) in enumerate(cuts)
            for d in L.shifts(i, delta, edits)
        ), (a, b)


@pytest.mark.parametrize("edits,block", [(1, 512), (2, 512), (2, 5)])
def test_documents_against_brute_force(spark, monkeypatch, edits, block):
    monkeypatch.setattr(L, "BLOCK", block)
    rnd = random.Random(9)
    base = ["".join(rnd.choice("abcdé ") for _ in range(rnd.choice([5, 19, 20, 21, 40]))) for _ in range(14)]
    rows = [(i, "\n".join(mutated(rnd, rnd.choice(base)) for _ in range(rnd.randrange(1, 7)))) for i in range(70)]
    rows += [(None, base[4] + "\n" + base[5]), (100, None), (101, ""), (102, "z" * 300 + "\n" + "z" * 299 + "\n" + base[3] * 3)]
    df = spark.createDataFrame([(*r, 5, "x", "clash") for r in rows], SCHEMA)
    got = L.dedup_lines(df, edits=edits)
    assert got.columns == [*df.columns, "n_removed"]
    want = brute(rows, edits)
    for r in got.collect():
        assert (r.text, r.n_lines - r.n_removed if r.text is not None else 1) == want[r.doc_id], r.doc_id


def test_repeated_rows_are_one_document(spark):
    line = "a line that is long enough"
    rows = [(1, line, 0, "", ""), (1, line, 0, "", ""), (1, line + "\nother", 0, "", ""), (2, line, 0, "", "")]
    got = sorted((r.doc_id, r.text) for r in L.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect())
    assert sorted(t for i, t in got if i == 2) == [""]
    assert sum(line in t for _, t in got) in (1, 2)
    assert L.dedup_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_lines(spark):
    rows = [(1, "z" * 200_000 + "\n" + "y" * 100_000, 0, "", ""), (2, "z" * 199_999 + "\n" + "y" * 99_000 + "x" * 1000, 0, "", "")]
    got = {r.doc_id: r.text for r in L.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: rows[0][1], 2: rows[1][1].split("\n")[1]}


def test_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], L.EDITS)
    for r in L.dedup_lines(docs).collect():
        assert r.text == want[r.doc_id][0]


def test_registered_threshold_is_verified_by_the_banded_distance(spark, monkeypatch):
    called = []
    banded = L._banded
    monkeypatch.setattr(L, "_banded", lambda *a: called.append(a) or banded(*a))
    line = "Copyright %s The Authors. All rights reserved. Item %02d of the list."
    texts = [line % (2019, 10), line % (2021, 10), line % (2019, 47), line % (2021, 47)]
    assert L.repeats(texts, [0] * 4, L.EDITS) == [1, 2, 3] and called
    df = spark.createDataFrame([(i, x, 0, "", "") for i, x in enumerate(texts)], SCHEMA)
    assert {r.doc_id for r in L.dedup_lines(df).collect() if r.text} == {0}
