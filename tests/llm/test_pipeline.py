from __future__ import annotations

import test_decontaminate
import test_line_dedup
import test_near_dedup
from pyspark.sql import functions as F

import corpus_pipeline as C
from tidemark.llm import bpe, line_dedup
from tidemark.llm.language import identify

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def stage(name):
    return dict(C.STAGES)[name]


def test_stages_against_brute_force(spark, sf):
    """Each stage gets what its predecessor kept; its rows are those of the brute-force versions."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    first = stage("language_id")(spark, docs, sf)
    rows = [(r.doc_id, r.text) for r in first.collect()]
    assert first.columns == docs.columns and 0.95 * docs.count() < len(rows)
    want = test_line_dedup.brute(rows, line_dedup.EDITS)
    second = stage("line_dedup")(spark, first, sf)
    got = second.collect()
    assert second.columns == docs.columns and {r.doc_id: r.text for r in got} == {k: v[0] for k, v in want.items()}
    assert all(r.n_chars == len(r.text) for r in got)
    rows = [(r.doc_id, r.text) for r in got]
    kept = {r[0] for r in test_near_dedup.brute(rows) if r[3]}
    third = stage("near_dedup")(spark, spark.createDataFrame(got, docs.schema), sf)
    got = third.collect()
    assert third.columns == docs.columns and sorted(r.doc_id for r in got) == sorted(kept)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    held = {r[0] for r in test_decontaminate.brute([(r.doc_id, r.text) for r in got], items)}
    fourth = stage("benchmark_decontamination")(spark, spark.createDataFrame(got, docs.schema), sf)
    got = fourth.collect()
    assert fourth.columns == docs.columns and sorted(r.doc_id for r in got) == sorted(kept - held)
    last = {r.doc_id: r for r in C.run(spark, sf).collect()}
    assert sorted(last) == sorted(r.doc_id for r in got)
    ranks, pattern = str(C.public_tokenizers.path("byte_bpe_50k.tiktoken")), C.public_tokenizers.PATTERN
    for r in got:
        assert last[r.doc_id].ids == bpe.encode(r.text, ranks, pattern) and last[r.doc_id].n_tokens == len(last[r.doc_id].ids)


def test_language_decisions_take_effect(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(80)
    docs = docs.unionByName(spark.createDataFrame([(9001, "1234 5678 !!", "en", "src1", 12), (9002, None, "de", None, 0)], DOCUMENTS))
    rejected = {r.doc_id for r in identify(docs, F.col("text"), F.col("lang"), F.col("source"), F.col("source"), key=F.col("doc_id")).filter("not accepted").collect()}
    assert {9001, 9002} <= rejected
    left = {r.doc_id for r in stage("language_id")(spark, docs, sf).collect()}
    assert left == {r.doc_id for r in docs.collect()} - rejected


def test_edge_rows_pass_every_stage(spark, sf):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [
        (1, text, "en", "a", 1), (1, text, "en", "a", 1), (None, text, "en", None, None), (2, text + " more", None, "b", 1),
        (3, None, None, None, None), (4, "", "en", "a", 0), (5, "x" * 200_000, "en", "a", 1), (6, text.upper(), "fr", "b", 2),
    ] + [(10 + i, text + f" tail{i}", "en", "a", 1) for i in range(20)]
    extra = "component string, _text int, kept string, __gone long"
    full = spark.createDataFrame([(*r, "c", 1, "k", 1) for r in rows], f"{DOCUMENTS}, {extra}")
    for docs in (full, full.limit(0)):
        for name, fn in C.STAGES:
            out = fn(spark, docs, sf)
            assert name == "byte_bpe" or out.columns == docs.columns
            assert out.count() <= docs.count()
            if name != "byte_bpe" and docs is full:
                assert out.select("component", "_text", "kept", "__gone").distinct().collect() == [("c", 1, "k", 1)]
    assert stage("near_dedup")(spark, full, sf).filter("doc_id >= 10").count() == 0
