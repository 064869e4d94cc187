"""The corpus pipeline: each stage gets the documents its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import digest_documents
from tidemark.llm.common import drop_ids, prepare, saved
from tidemark.llm.decontaminate import decontaminate
from tidemark.llm.language import identify
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.near_dedup import near_duplicates


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language stay; ``lang`` is their declaration, ``source`` their host."""
    prepare(spark)
    host = F.col("source").cast("string")
    found = identify(docs, F.col("text"), F.col("lang"), host, host, key=F.col("doc_id"))
    return found.filter("accepted").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line go; every document stays, with its new length."""
    prepare(spark)
    cut = dedup_lines(docs)
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays. Rows that share an id are
    one document and stay or go together: it goes when all of them have a better copy."""
    prepare(spark)
    decided = near_duplicates(docs).groupBy("doc_id").agg(F.max("kept").alias("kept"))
    gone = saved(decided.filter(~F.col("kept")).select("doc_id"), "near-copies")
    return drop_ids(docs, gone, "doc_id")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    prepare(spark)
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document, with digests of the tokens and of what they decode to."""
    prepare(spark)
    ranks = str(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return digest_documents(docs, ranks, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_bpe", byte_bpe),
]

#: SQL can't express the stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's documents are written before the next reads them."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
