"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import session

# The letters that normalisation lower-cases.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: A key is hot when it holds more than 1 / (HOT_SHARE x shuffle partitions) of the rows, so there
#: are fewer than HOT_SHARE x shuffle partitions hot keys, however many rows there are.
HOT_SHARE = 8


def prepare(spark: SparkSession) -> None:
    """What the operators need of a session: this package in Python workers, and small batches."""
    session.ship_package(spark)


def column(name: str) -> Column:
    return F.col(f"`{name}`")


def whole_text(name: str) -> Column:
    """The text, null as empty."""
    return F.coalesce(column(name).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; pure ASCII texts take the quicker built-in."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def whole_rows(df: DataFrame, **more: Column) -> DataFrame:
    """The rows of ``df`` as one column ``_row``, with further columns; so no name can clash."""
    row = F.struct(*[column(c) for c in df.columns]).alias("_row")
    return df.select(row, *[value.alias(name) for name, value in more.items()])


def own_columns(df: DataFrame, like: DataFrame) -> list[Column]:
    """The columns of ``like`` out of ``_row``."""
    return [F.col("_row").getField(c).alias(c) for c in like.columns]


def drop_ids(df: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """``df`` without the rows whose id is in the single column of ``ids``; null is an id too."""
    gone = ids.toDF("_gone")
    rows = whole_rows(df, _id=column(id_col).cast("long"))
    left = rows.join(gone, F.col("_id").eqNullSafe(F.col("_gone")), "left_anti")
    return left.select(*own_columns(left, df))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only local sessions without it get one of their own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    session._checkpoint_folder(spark)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: computed once, and what
    follows survives the loss of executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tidemark-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hot_keys(df: DataFrame, key: str, total: int) -> DataFrame:
    """``key, _salts``: keys with more than their share of the ``total`` rows and into how many parts
    they are to be split. Fewer than ``HOT_SHARE * partitions`` rows by construction, so it may be
    broadcast. Counting combines in the map tasks."""
    share = max(1.0, total / (HOT_SHARE * partitions(df.sparkSession)))
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    found = counts.filter(F.col("_n") > share)
    return found.select(key, F.ceil(F.col("_n") / F.lit(share)).cast("int").alias("_salts"))
