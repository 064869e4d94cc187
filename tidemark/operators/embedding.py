"""Text to vectors: a pluggable encoder, a hashing default and an incremental store."""

from __future__ import annotations

import importlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import identifiers as I
from tidemark.functions import text as X
from tidemark.functions import vectors as V
from tidemark.schemas import assert_columns
from tidemark.session import path_exists

# Default vector size and texts per encoder call.
DIMENSION = 384
BATCH = 64
HASHING_MODEL = "hashing-tf"


def hashing_embeddings(df: DataFrame, text_col: str = "text", dimension: int = DIMENSION) -> DataFrame:
    """Unit-length hashed term counts in ``embedding``; deterministic, JVM only, no model."""
    assert_columns(df, (text_col,), "hashing_embeddings")
    listed = df.withColumn("_terms", X.tokens(F.coalesce(F.col(text_col), F.lit(""))))
    counted = HashingTF(numFeatures=dimension, inputCol="_terms", outputCol="_tf").transform(listed)
    unit = V.l2_normalize(vector_to_array("_tf"))
    return counted.withColumn("embedding", unit.cast("array<float>")).drop("_terms", "_tf")


def model_embeddings(
    df: DataFrame,
    load_model: Callable[[], Callable[[list[str]], np.ndarray]],
    id_col: str = "chunk_id",
    text_col: str = "text",
    batch: int = BATCH,
) -> DataFrame:
    """``id_col, embedding`` from an encoder that is loaded once per Python worker.

    ``load_model`` returns a function from a list of texts to a 2-D array. An encoder that
    fails or returns another shape fails the task; there is no silent replacement.
    """
    assert_columns(df, (id_col, text_col), "model_embeddings")

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load_model()
        for frame in frames:
            for start in range(0, len(frame), batch):
                part = frame.iloc[start : start + batch]
                raw = np.asarray(model(part["_t"].tolist()), dtype="float32")
                if raw.ndim != 2 or len(raw) != len(part):
                    raise ValueError("embeddings must be a 2-D array with one row per text")
                length = np.linalg.norm(raw, axis=1, keepdims=True)
                unit = raw / np.where(length == 0.0, 1.0, length)
                yield pd.DataFrame({id_col: part[id_col], "embedding": list(unit)})

    kind = df.schema[id_col].dataType.simpleString()
    slim = df.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    return slim.mapInPandas(encode, f"{id_col} {kind}, embedding array<float>")


def local_encoder(name: str, folder: str | None = None) -> Callable[[DataFrame], DataFrame]:
    """An encoder for :class:`EmbeddingStore` from ``module:function``, for instance of a file that lies in a
    shared folder. Each Python worker imports the module once and calls the function, with ``folder``
    (such as where the weights lie) if one is given; it returns a function from texts to a 2-D array.
    """
    module, _, function = name.partition(":")
    if not module or not function:
        raise ValueError(f"an encoder is given as module:function, not {name!r}")

    def load() -> Callable[[list[str]], np.ndarray]:
        make = getattr(importlib.import_module(module), function)
        return make(folder) if folder is not None else make()

    return lambda texts: model_embeddings(texts, load)


def content_key(text: F.Column, model: str) -> F.Column:
    """Store key of a text under a model, so changed texts or models are encoded again."""
    return F.sha2(F.concat_ws("\n", F.lit(model), text), 256)


def missing_embeddings(
    chunks: DataFrame, store: DataFrame, model: str = HASHING_MODEL, text_col: str = "text"
) -> DataFrame:
    """Chunks whose (id, content) is not in the store: a left anti join on both."""
    keyed = chunks.withColumn("content_key", content_key(F.col(text_col), model))
    return keyed.join(
        store.select("chunk_id", "content_key"), ["chunk_id", "content_key"], "left_anti"
    )


class EmbeddingStore:
    """Parquet folder of ``content_key, embedding``: one vector per distinct text and model, encoded
    once, whatever the ids of the chunks that have it."""

    def __init__(self, spark: SparkSession, path: str, model: str = HASHING_MODEL):
        self.spark, self.path, self.model = spark, path, model

    def _exists(self) -> bool:
        return path_exists(self.spark, self.path)

    def load(self) -> DataFrame:
        if not self._exists():
            raise FileNotFoundError(f"no embedding store at {self.path}")
        return self.spark.read.parquet(self.path)

    def get_or_compute(
        self,
        chunks: DataFrame,
        encode: Callable[[DataFrame], DataFrame] | None = None,
        text_col: str = "text",
    ) -> DataFrame:
        """Encode what is missing, append it, return identity and ``embedding`` of all chunks.

        The encoder gets distinct texts, with the content key as ``chunk_id``.
        """
        assert_columns(chunks, ("chunk_id", text_col), "get_or_compute")
        text = F.coalesce(F.col(text_col), F.lit(""))
        keyed = chunks.withColumn("content_key", content_key(text, self.model))
        texts = keyed.select(F.col("content_key").alias("chunk_id"), text.alias(text_col))
        missing = texts.dropDuplicates(["chunk_id"])
        if self._exists():
            known = self.load().select(F.col("content_key").alias("chunk_id"))
            missing = missing.join(known, "chunk_id", "left_anti")
        encoder = encode or (lambda df: hashing_embeddings(df, text_col))
        fresh = encoder(missing).select(F.col("chunk_id").alias("content_key"), "embedding")
        fresh.write.mode("append").parquet(self.path)
        wanted = keyed.select(*I.chunk_identity(chunks), "content_key")
        # Two runs may both have appended a text; keep one row per key.
        stored = self.load().dropDuplicates(["content_key"])
        return wanted.join(stored, "content_key").drop("content_key")
