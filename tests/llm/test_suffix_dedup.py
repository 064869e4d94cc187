from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import suffix_dedup as S

SCHEMA = "doc_id long, text string, raw string, kept int, start int"


def brute(rows):
    """Every window of every document in order, looked up among all windows so far."""
    order = sorted({(r[0] if r[0] is not None else -(2**63), r[1] or "") for r in rows})
    seen, out = set(), {}
    for doc, text in order:
        raw = text.encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - S.LENGTH + 1):
            window = raw[i : i + S.LENGTH]
            if window in seen:
                gone[i : i + S.LENGTH] = True
            seen.add(window)
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out[doc, text] = (len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return sorted(((r[0], *out[r[0] if r[0] is not None else -(2**63), r[1] or ""]) for r in rows), key=str)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r)[:5] for r in S.remove_repeats(df).collect()), key=str)


def corpus(seed, n=90, letters="abcd é\n"):
    rnd = random.Random(seed)
    text = lambda k: "".join(rnd.choice(letters) for _ in range(k))
    shared = [text(rnd.choice([90, 99, 100, 101, 150, 400, 900])) for _ in range(12)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rnd.randrange(5)):
            piece = rnd.choice(shared)
            at, to = sorted(rnd.choices(range(len(piece) + 1), k=2)) if rnd.random() < 0.4 else (0, len(piece))
            parts += [text(rnd.randrange(150)), piece[at:to]]
        rows.append((i, "".join(parts)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = corpus(seed)
    assert run(spark, rows) == brute(rows)


def test_hot_passages_and_small_sorts(spark, monkeypatch):
    monkeypatch.setattr(S, "SORT_SYMBOLS", 500)
    base = corpus(3, 1)[0][1]
    rnd = random.Random(4)
    line = "a line that many documents share with each other, long enough to hold an anchor of its own "
    rows = [(i, base + str(i) + line + "".join(rnd.choice("xyz") for _ in range(60))) for i in range(120)]
    rows += [(1000 + i, line * 3) for i in range(60)]
    assert run(spark, rows) == brute(rows)


def test_periodic_repeated_and_edge_rows(spark):
    rows = [
        (1, None), (2, ""), (3, "x" * 99), (4, "x" * 100), (5, "x" * 101), (6, "ab" * 400), (7, "ab" * 300 + "c"),
        (8, "é" * 51), (9, "É" + "é" * 51), (None, "q" * 50 + "r" * 70), (10, "q" * 50 + "r" * 70), (3, "x" * 99),
        (6, "ab" * 400), (11, "".join(map(str, range(400)))), (12, "".join(map(str, range(150, 500)))),
    ]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_long_text_is_scanned_in_steps(spark, monkeypatch):
    rnd = random.Random(7)
    body = "".join(rnd.choice("abcdefgh") for _ in range(S.STEP + 5000))
    rows = [(1, body[: S.STEP + 50] + "zz"), (2, "!!" + body[1000:]), (3, body[-4000:] * 2)]
    assert run(spark, rows) == brute(rows)


def test_sorted_collection_is_the_suffix_array():
    rnd = random.Random(1)
    for _ in range(60):
        texts = [bytes(rnd.choice(b"ab\x00\xff") for _ in range(rnd.randrange(0, 14))) for _ in range(rnd.randrange(1, 12))]
        who, start, common = S.sort_collection(texts)
        key = lambda w, s: [(c + 1, 0) for c in texts[w][s:]] + [(0, w)]
        want = sorted(((i, s) for i, t in enumerate(texts) for s in range(len(t) + 1)), key=lambda x: key(*x))
        got = list(zip(who.tolist(), start.tolist()))
        assert got == want
        for (a, b), (c, d), k in zip(got, got[1:], common[1:].tolist()):
            x, y = texts[a][b:], texts[c][d:]
            assert k == next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))


def test_passages_hold_each_window_once_with_equal_anchors():
    rnd = random.Random(2)
    raw = bytes(rnd.choice(b"abc") for _ in range(3000))
    h, _, start, size = S.passages(raw)
    windows = [s + i for s, n in zip(start, size) for i in range(n - S.LENGTH + 1)]
    assert windows == list(range(len(raw) - S.LENGTH + 1)) and size.max() <= 2 * S.LENGTH
    again = S.passages(b"zz" + raw[500:900] + b"y")
    assert set(again[0]) & set(h)
