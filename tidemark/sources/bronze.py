"""Bronze layer: which filing artefacts are wanted, which are missing, and fetching them.

A bronze table has one row per artefact with its content and origin, in place of one file and
one side file each: two writes per artefact cannot come apart and listing stays cheap.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import identifiers as I
from tidemark.schemas import assert_columns
from tidemark.session import path_exists
from tidemark.sources.http import ARCHIVE_URL, MIN_INTERVAL_SECONDS, HttpClient

INDEX_FILE = "filing-index.json"  # fixed value: stored name of a filing's index
FETCHED_SCHEMA = (
    "artifact string, cik string, accession_number string, fiscal_year int, kind string, "
    "url string, filing_date string, report_date string, status_code int, error string, "
    "user_agent string, fetched_at string, content binary"
)
_CARRIED = (
    "artifact", "cik", "accession_number", "fiscal_year", "kind", "url", "filing_date",
    "report_date",
)


def wanted_artifacts(filings: DataFrame, root: str = "bronze") -> DataFrame:
    """Index and primary document of every filing; filings without a document are left out."""
    assert_columns(
        filings, ("cik", "accession_number", "primary_document", "fiscal_year"), "wanted_artifacts"
    )
    usable = filings.where(F.coalesce(F.trim("primary_document"), F.lit("")) != "")
    bare = I.strip_dashes(F.col("accession_number"))
    number = F.regexp_replace(F.col("cik"), "^0+", "")
    files = F.array(
        F.struct(
            F.lit("index").alias("kind"),
            F.lit(INDEX_FILE).alias("name"),
            F.lit("index.json").alias("remote"),
        ),
        F.struct(
            F.lit("document").alias("kind"),
            F.col("primary_document").alias("name"),
            F.col("primary_document").alias("remote"),
        ),
    )
    listed = usable.select("*", F.inline(files))
    prefix, rest = ARCHIVE_URL.split("{cik_number}")
    url = F.concat(F.lit(prefix), number, F.lit("/"), bare, F.lit("/"), F.col("remote"))
    optional = [
        (F.col(c) if c in filings.columns else F.lit(None).cast("string")).alias(c)
        for c in ("filing_date", "report_date")
    ]
    return listed.select(
        I.bronze_path(root, F.col("cik"), F.col("accession_number"), F.col("name")).alias(
            "artifact"
        ),
        "cik", "accession_number", F.col("fiscal_year").cast("int").alias("fiscal_year"),
        "kind", url.alias("url"), *optional,
    )


def pending_artifacts(wanted: DataFrame, bronze: DataFrame | None) -> DataFrame:
    """Wanted artefacts that were not fetched with success before."""
    if bronze is None:
        return wanted
    present = bronze.where(F.col("error").isNull()).select("artifact")
    return wanted.join(present, "artifact", "left_anti")


def fetch_artifacts(
    pending: DataFrame,
    make_client: Callable[[float], HttpClient],
    tasks: int = 1,
    min_interval: float = MIN_INTERVAL_SECONDS,
) -> DataFrame:
    """Fetch every artefact; a failure becomes an ``error`` text and stops nothing.

    The rate limit holds for all tasks together: each of the ``tasks`` waits ``tasks`` times
    the interval. More tasks give no more speed, only smaller pieces to repeat after a loss.
    """

    def fetch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client(min_interval * tasks)
        for frame in frames:
            for start in range(0, len(frame), 16):
                part = frame.iloc[start : start + 16]
                yield part.assign(**_outcomes(client, part["url"].tolist()))

    return pending.select(*_CARRIED).repartition(tasks, "artifact").mapInPandas(
        fetch, FETCHED_SCHEMA
    )


def _outcomes(client: HttpClient, urls: list[str]) -> dict[str, list]:
    out: dict[str, list] = {
        "status_code": [], "error": [], "user_agent": [], "fetched_at": [], "content": []
    }
    for url in urls:
        status, body, error = None, None, None
        try:
            status, body = client.get(url)
        except Exception as problem:  # one bad artefact must not end the batch
            status, error = getattr(problem, "status", None), str(problem)
        out["status_code"].append(status)
        out["error"].append(error)
        out["user_agent"].append(client.user_agent)
        out["fetched_at"].append(datetime.now(timezone.utc).isoformat())
        out["content"].append(body)
    return out


def read_bronze(spark: SparkSession, path: str) -> DataFrame | None:
    if not path_exists(spark, path):
        return None
    return spark.read.schema(FETCHED_SCHEMA).parquet(path)


def update_bronze(
    spark: SparkSession,
    filings: DataFrame,
    path: str,
    make_client: Callable[[float], HttpClient],
    tasks: int = 1,
    force: bool = False,
) -> DataFrame:
    """Fetch what is missing (everything when forced) and append it; returns the bronze table."""
    wanted = wanted_artifacts(filings)
    pending = wanted if force else pending_artifacts(wanted, read_bronze(spark, path))
    fetched = fetch_artifacts(pending, make_client, tasks)
    fetched.write.mode("append").partitionBy("fiscal_year").parquet(path)
    return read_bronze(spark, path)


def latest_documents(bronze: DataFrame) -> DataFrame:
    """Last successful copy of every primary document as text (invalid bytes replaced).

    Copies are compared without their contents; only the keys of superseded ones, of which
    there are few, meet the contents in an anti join.
    """
    good = bronze.where(F.col("error").isNull() & (F.col("kind") == "document"))
    stamps = good.select("artifact", "fetched_at")
    last = stamps.groupBy("artifact").agg(F.max("fetched_at").alias("last"))
    old = stamps.join(last, "artifact").where(F.col("fetched_at") < F.col("last"))
    kept = good.join(
        old.select("artifact", "fetched_at"), ["artifact", "fetched_at"], "left_anti"
    )
    return kept.select(
        "cik", "accession_number", "fiscal_year", F.decode("content", "UTF-8").alias("html")
    )
