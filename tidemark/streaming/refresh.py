"""Incremental refresh: new filings on disk become chunks and vectors, once each.

The periodic refresh runs as a Structured Streaming query over the bronze folder with
``availableNow``: it takes the files that arrived since the last run, remembers them in its
checkpoint, and stops. A batch that is repeated after a failure appends nothing twice, because
chunks that are already stored are removed by an anti join on filing, id and text. A corrected text
is new; two filings of one year keep their own chunks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import identifiers as I
from tidemark.operators.chunking import MAX_WORDS, MIN_WORDS, chunk_sections
from tidemark.operators.embedding import EmbeddingStore
from tidemark.operators.sections import extract_sections
from tidemark.session import path_exists

SECTION = "item_1a"  # fixed value: name of the extracted section
FILING_SCHEMA = "cik string, accession_number string, fiscal_year int, html string"


def filings_to_chunks(
    filings: DataFrame, min_words: int = MIN_WORDS, max_words: int = MAX_WORDS
) -> DataFrame:
    """Chunks of every filing whose section could be extracted; works on streams as well."""
    extracted = extract_sections(filings).where("success")
    sections = extracted.select(
        "cik", "fiscal_year", "accession_number", F.lit(SECTION).alias("section"), "text"
    )
    return chunk_sections(sections, min_words, max_words)


def append_new_chunks(batch: DataFrame, chunk_path: str) -> None:
    """Append the chunks of a batch that are not stored yet."""
    spark = batch.sparkSession
    fresh = batch.dropDuplicates([*I.CHUNK_IDENTITY, "text"])
    if path_exists(spark, chunk_path):
        stored = spark.read.schema(batch.schema).parquet(chunk_path)
        known = stored.select(*I.CHUNK_IDENTITY, F.xxhash64("text").alias("_text"))
        keys = [*I.CHUNK_IDENTITY, "_text"]
        fresh = fresh.withColumn("_text", F.xxhash64("text")).join(known, keys, "left_anti")
        fresh = fresh.select(*batch.columns)
    fresh.write.mode("append").parquet(chunk_path)


def refresh(
    spark: SparkSession,
    filing_path: str,
    chunk_path: str,
    checkpoint: str,
    embedding_path: str | None = None,
    max_files_per_batch: int | None = None,
) -> StreamingQuery:
    """Process the filing files that are new since the last call; returns the started query."""
    reader = spark.readStream.schema(FILING_SCHEMA)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    chunks = filings_to_chunks(reader.parquet(filing_path))

    def store(batch: DataFrame, _: int) -> None:
        append_new_chunks(batch, chunk_path)
        if embedding_path:
            EmbeddingStore(batch.sparkSession, embedding_path).get_or_compute(batch)

    return (
        chunks.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
