"""The registered queries of this package, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import sql
from tidemark.llm.bpe import digest_documents
from tidemark.llm.common import prepare
from tidemark.llm.conversation_trie import conversation_trie
from tidemark.llm.decontaminate import contaminated
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.language import address, identify, markup_language, visible_text
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.mixing import mix
from tidemark.llm.near_dedup import near_duplicates
from tidemark.llm.quality import quality_scores
from tidemark.llm.secrets import scan_secrets
from tidemark.llm.suffix_dedup import remove_repeats
from tidemark.llm.warc import archive
from tidemark.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = sql.SQL


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark items that documents hold."""
    return contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op2_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Secrets in every document, nested encodings unwrapped."""
    return scan_secrets(table(spark, sf, "documents"))


@query
def op3_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that repeat an earlier line up to a few edits, removed from every document."""
    cut = dedup_lines(table(spark, sf, "documents"))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op4_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Token and round-trip digests of every document."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return digest_documents(table(spark, sf, "documents"), str(ranks), public_tokenizers.PATTERN)


@query
def op5_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes of every document that an earlier string covers, removed."""
    return remove_repeats(table(spark, sf, "documents")).drop("kept")


@query
def op6_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Language of every document and page: documents come with a declared language and a source,
    pages with markup and an address."""
    docs = table(spark, sf, "documents")
    null = F.lit(None).cast("string")
    number = F.lit(None).cast("long")
    source = docs["source"]
    parts = address(F.col("url"))
    html = F.coalesce("html", F.lit(""))
    rows = docs.select(
        "doc_id", number.alias("page_id"), F.col("lang").alias("declared"), "text",
        source.alias("host"), source.alias("domain"), null.alias("suffix"),
    ).unionByName(
        table(spark, sf, "pages").select(
            number.alias("doc_id"), "page_id", markup_language(html).alias("declared"),
            visible_text(html).alias("text"), *[v.alias(k) for k, v in parts.items()],
        )
    )
    key = F.concat_ws("/", F.col("doc_id").cast("string"), F.lit("page"), F.col("page_id").cast("string"))
    found = identify(
        rows, F.col("text"), F.col("declared"), F.col("host"), F.col("domain"), F.col("suffix"), key
    )
    return found.select("doc_id", "page_id", "language", "confidence", "accepted")


@query
def op7_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Quality score of every document."""
    return quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op8_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Groups of near copies among all documents."""
    return near_duplicates(table(spark, sf, "documents"))


@query
def op9_warc(spark: SparkSession, sf: str) -> DataFrame:
    """Every page written to WARC bundles and read back."""
    _, read = archive(table(spark, sf, "pages"))
    return read.drop("record_id")


@query
def op10_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Copies among all documents."""
    return exact_dedup(table(spark, sf, "documents"))


@query
def op11_whitening(spark: SparkSession, sf: str) -> DataFrame:
    """Whitened leading coordinates of every embedding."""
    return whiten(table(spark, sf, "embeddings"))


@query
def op12_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes of the tree of shared conversation starts."""
    return conversation_trie(table(spark, sf, "conversations"))


@query
def op13_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """How often the mix takes every document."""
    return mix(table(spark, sf, "documents"))
