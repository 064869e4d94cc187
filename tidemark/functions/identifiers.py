"""Identifiers: padded entity keys, accession numbers, chunk and change ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CIK_WIDTH = 10  # fixed value: width of a padded entity key


def zero_fill(value: Column, width: int = CIK_WIDTH) -> Column:
    """Left-pad with zeros without ever truncating (``lpad`` alone cuts longer input)."""
    text = value.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def pad_cik(value: Column) -> Column:
    """Normalised entity key: blanks and leading zeros removed, then padded to ten digits."""
    return zero_fill(F.regexp_replace(F.trim(value.cast("string")), "^0+", ""))


def pad_numeric_cik(value: Column) -> Column:
    """As :func:`pad_cik`, but non-numeric input gives NULL instead of a padded word."""
    number = F.trim(value.cast("string")).try_cast("long")
    return zero_fill(number)


def strip_dashes(accession: Column) -> Column:
    return F.replace(accession, F.lit("-"), F.lit(""))


def add_dashes(accession: Column) -> Column:
    """10-2-6 form of an eighteen character accession; any other length is left as it is."""
    bare = strip_dashes(accession)
    return F.when(
        F.length(bare) == 18, F.regexp_replace(bare, r"^(.{10})(.{2})(.{6})$", "$1-$2-$3")
    ).otherwise(accession)


def chunk_id(cik: Column, fiscal_year: Column, section: Column, index: Column) -> Column:
    """``{cik}_{year}_{section}_{index:04d}``"""
    return F.format_string(
        "%s_%d_%s_%04d", cik, fiscal_year.cast("int"), section, index.cast("int")
    )


#: A chunk is told apart by its filing and its id: an original and its amendment share ids.
CHUNK_IDENTITY = ("accession_number", "chunk_id")


def chunk_identity(*frames: DataFrame) -> list[str]:
    """The identity columns that all frames have; frames without filings go by the chunk id."""
    shared = set.intersection(*[set(f.columns) for f in frames])
    return [c for c in CHUNK_IDENTITY if c in shared]


def change_id(cik: Column, cluster_id: Column, fiscal_year: Column) -> Column:
    """``{cik}_{cluster}_{year}``"""
    return F.concat_ws(
        "_", cik, cluster_id.cast("string"), fiscal_year.cast("int").cast("string")
    )


def bronze_path(root: str, cik: Column, accession: Column, filename: Column) -> Column:
    """Where one fetched artefact of a filing lives: ``root/cik/accession/file``."""
    return F.concat_ws("/", F.lit(root), pad_numeric_cik(cik), strip_dashes(accession), filename)
