"""Exact dedup by a content sort.

Normalised texts are range-partitioned by splitters that Spark samples, sorted externally within
the ranges, and neighbours are compared in full: a run of equal texts is one group. Only built-in
functions run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, column, hot_keys, saved, whole_text

#: Characters of a text that splitters look at. Splitters travel through the driver, so they must
#: not hold whole texts; texts that agree in so many characters are ordered by their hash.
HEAD = 48


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``, one row per input row.

    Texts are equal when identical after lower-casing A-Z. Of equal texts the row with the largest
    id stays. A null text counts as empty, and empty texts are one group like any other. A null id
    is smaller than any id; a group with null ids only has a null ``keep_id``. Of rows that repeat
    both id and text exactly one is kept. Other columns are not read.

    The text is shuffled once. Texts whose hash is hot (see ``hot_keys``) are spread over several
    ranges by id; each part finds its own largest id and size, and one text per part is compared
    in a second, small sort.
    """
    rows = docs.select(
        column(id_col).cast("long").alias("_id"), ascii_lower(whole_text(text_col)).alias("_norm")
    ).withColumn("_hash", F.xxhash64("_norm"))
    hot = saved(hot_keys(rows, "_hash", docs.count()), "hot-texts")
    salted = rows.join(F.broadcast(hot), "_hash", "left").select(
        "_id",
        "_norm",
        "_hash",
        F.substring("_norm", 1, HEAD).alias("_head"),
        F.pmod(F.xxhash64("_id"), F.coalesce("_salts", F.lit(1))).cast("int").alias("_salt"),
        F.col("_salts").isNotNull().alias("_split"),
    )
    place = ["_head", "_hash", "_salt"]
    ranges = salted.repartitionByRange(*place)
    # The windows need no further shuffle: rows of one run lie in one range, next to each other.
    run = W.partitionBy(*place, "_norm")
    by_id = run.orderBy(F.col("_id").desc_nulls_last())
    runs = ranges.select(
        "_id",
        "_salt",
        "_norm",
        "_split",
        F.first("_id").over(by_id).alias("_keep"),
        F.row_number().over(by_id).alias("_at"),
        F.count(F.lit(1)).over(run).alias("_size"),
    )
    compact = saved(
        runs.select(
            "_id",
            "_salt",
            "_keep",
            "_at",
            "_size",
            F.sha2("_norm", 256).alias("_sha"),
            F.when(F.col("_split") & (F.col("_at") == 1), F.col("_norm")).alias("_part_text"),
        ),
        "runs",
    )
    # One row per part of a split text, so fewer than twice HOT_SHARE x partitions rows.
    same = W.partitionBy("_part_text")
    parts = compact.filter(F.col("_part_text").isNotNull()).select(
        "_sha",
        "_salt",
        F.max("_keep").over(same).alias("_all_keep"),
        F.sum("_size").over(same).alias("_all_size"),
    )
    keep = F.when(F.col("_all_size").isNotNull(), F.col("_all_keep")).otherwise(F.col("_keep"))
    return compact.join(F.broadcast(parts), ["_sha", "_salt"], "left").select(
        F.col("_id").alias("doc_id"),
        keep.alias("keep_id"),
        F.coalesce("_all_size", "_size").alias("group_size"),
        ((F.col("_at") == 1) & F.col("_id").eqNullSafe(keep)).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )
