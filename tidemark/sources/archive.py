"""Spark data source over the JSON members of ZIP archives, and a file-based vector import.

``spark.read.format("zipjson").load(path)`` gives ``member, cik, json``. The member list is
read once on the driver; each task opens the archive and reads its own range of members. A
filter on ``cik`` skips members before they are read.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
)

from tidemark.functions.identifiers import pad_cik

# Fixed value: members are named by the padded entity key.
MEMBER_PATTERN = re.compile(r"CIK(\d{10})\.json$")
MEMBERS_PER_TASK = 2000
FORMAT = "zipjson"


@dataclass
class MemberRange(InputPartition):
    path: str
    members: list[str]


def _member_key(name: str) -> str | None:
    match = MEMBER_PATTERN.search(name)
    return match.group(1) if match else None


class ZipJsonReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.per_task = int(options.get("membersPerTask", MEMBERS_PER_TASK))
        self.keys: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for item in filters:
            if isinstance(item, EqualTo) and item.attribute == ("cik",):
                self._keep({item.value})
            elif isinstance(item, In) and item.attribute == ("cik",):
                self._keep(set(item.value))
            else:
                yield item

    def _keep(self, keys: set[str]) -> None:
        self.keys = keys if self.keys is None else self.keys & keys

    def partitions(self) -> list[MemberRange]:
        with zipfile.ZipFile(self.path) as archive:
            names = [n for n in archive.namelist() if _member_key(n)]
        if self.keys is not None:
            names = [n for n in names if _member_key(n) in self.keys]
        starts = range(0, len(names), self.per_task)
        return [MemberRange(self.path, names[s : s + self.per_task]) for s in starts]

    def read(self, partition: MemberRange) -> Iterator[tuple]:
        with zipfile.ZipFile(partition.path) as archive:
            for name in partition.members:
                text = archive.read(name).decode("utf-8", errors="replace")
                yield name, _member_key(name), text


class ZipJsonSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "member string, cik string, json string"

    def reader(self, schema) -> ZipJsonReader:
        return ZipJsonReader(self.options)


def read_zip_json(
    spark: SparkSession, path: str, members_per_task: int = MEMBERS_PER_TASK
) -> DataFrame:
    """All JSON members of an archive that every executor can open by this path."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ZipJsonSource)
    return spark.read.format(FORMAT).option("membersPerTask", members_per_task).load(path)


def entity_documents(documents: DataFrame, ciks: DataFrame) -> DataFrame:
    """Documents of the wanted entities; a missing one simply gives no row."""
    wanted = ciks.select(pad_cik(F.col("cik")).alias("cik")).distinct()
    return documents.join(wanted, "cik", "left_semi")


def missing_entities(documents: DataFrame, ciks: DataFrame) -> DataFrame:
    """Wanted entities without a document in the archive."""
    wanted = ciks.select(pad_cik(F.col("cik")).alias("cik")).distinct()
    return wanted.join(documents.select("cik"), "cik", "left_anti")


def import_npz(spark: SparkSession, path: str) -> DataFrame:
    """``chunk_id, embedding`` from NumPy archives with ``embeddings`` and ``chunk_ids``.

    One archive is one record; any number of archives is read in parallel.
    """

    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for content in frame["content"]:
                with np.load(io.BytesIO(content), allow_pickle=False) as data:
                    ids, vectors = data["chunk_ids"], data["embeddings"].astype("float32")
                if len(ids) != len(vectors):
                    raise ValueError(f"chunk_ids length {len(ids)} != {len(vectors)} embeddings")
                for start in range(0, len(ids), 1024):
                    yield pd.DataFrame(
                        {
                            "chunk_id": ids[start : start + 1024].astype(str),
                            "embedding": list(vectors[start : start + 1024]),
                        }
                    )

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(unpack, "chunk_id string, embedding array<float>")
