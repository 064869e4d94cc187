"""Split section texts into word-bounded chunks; a pure projection, no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import identifiers as I
from tidemark.functions import text as X
from tidemark.schemas import CHUNK_COLUMNS, assert_columns

# Default word bounds of a chunk.
MIN_WORDS = 40
MAX_WORDS = 300


def chunk_sections(
    sections: DataFrame, min_words: int = MIN_WORDS, max_words: int = MAX_WORDS
) -> DataFrame:
    """Chunks of every section row (``cik, fiscal_year, accession_number, section, text``).

    Short paragraphs are dropped, long ones are packed from sentences, and short leftovers of
    the packing are dropped after numbering, so numbers may skip.
    """
    if min_words < 1:
        raise ValueError("min_words must be >= 1")
    if max_words <= min_words:
        raise ValueError("max_words must be > min_words")
    assert_columns(
        sections, ("cik", "fiscal_year", "accession_number", "section", "text"), "chunk_sections"
    )
    sized = F.filter(
        F.transform(
            X.paragraphs(F.col("text")),
            lambda p: F.struct(p.alias("p"), X.word_count(p).alias("n")),
        ),
        lambda item: item["n"] >= min_words,
    )
    pieces = F.flatten(
        F.transform(
            sized,
            lambda item: F.when(
                item["n"] > max_words, X.pack_sentences(item["p"], max_words)
            ).otherwise(F.array(item["p"])),
        )
    )
    exploded = sections.select(
        F.col("cik").cast("string").alias("cik"),
        F.col("fiscal_year").cast("int").alias("fiscal_year"),
        F.col("accession_number").cast("string").alias("accession_number"),
        F.col("section").cast("string").alias("section"),
        F.posexplode(pieces).alias("chunk_index", "text"),
    )
    counted = exploded.withColumn("token_count", X.word_count(F.col("text"))).where(
        F.col("token_count") >= min_words
    )
    return counted.withColumn(
        "chunk_id",
        I.chunk_id(
            F.col("cik"), F.col("fiscal_year"), F.col("section"), F.col("chunk_index")
        ),
    ).select(*CHUNK_COLUMNS)


def duplicate_chunk_ids(chunks: DataFrame, keys: Sequence[str] = ("chunk_id",)) -> DataFrame:
    """Ids used more than once (an original and its amendment in one year share ids)."""
    return chunks.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def assert_unique_chunks(chunks: DataFrame) -> DataFrame:
    """``chunks``, or an error when filing and id do not tell them apart."""
    found = duplicate_chunk_ids(chunks, I.chunk_identity(chunks)).take(3)
    if found:
        raise ValueError(f"chunks are not unique: {[r.asDict() for r in found]}")
    return chunks
