from __future__ import annotations

import hashlib

from tidemark.llm.exact_dedup import exact_dedup

SCHEMA = "doc_id long, text string, _norm string, kept int"


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        norm = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        groups.setdefault(norm, []).append(doc_id)
    out = []
    for norm, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        sha = hashlib.sha256(norm.encode()).hexdigest()
        seen = False
        for i in ids:
            out.append((i, keep, len(ids), i == keep and not seen, sha))
            seen |= i == keep
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    return sorted(map(tuple, exact_dedup(df).collect()), key=str)


def test_copies_ties_nulls_and_case(spark):
    rows = [(1, "Ab É"), (2, "aB É"), (3, "ab é"), (4, None), (5, ""), (None, "z"), (None, None)]
    rows += [(7, "same"), (7, "same"), (8, "x" * 300_000), (9, "X" * 300_000), (None, "q"), (None, "q")]
    assert run(spark, rows) == brute(rows)


def test_hot_group_is_split_and_merged(spark):
    rows = [(i, "hot text") for i in range(600)] + [(1000 + i, f"t{i % 300}") for i in range(600)]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []
