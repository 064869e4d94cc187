from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import quality as Q


def area(score, good):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    n1, n0 = good.sum(), (1 - good).sum()
    return (rank[good == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)


def test_held_out_labels_of_given_documents(spark):
    at = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet")
    got = Q.quality_scores(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == docs.count()
    rows = got.filter("held_out").join(labels, "doc_id").toPandas()
    assert area(rows["score"].to_numpy(), rows["quality"].to_numpy()) > 0.9
    assert (rows["predicted"] == rows["quality"]).mean() > 0.93
    ids = got.toPandas()
    assert (ids["held_out"] == ids["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    assert ids["score"].between(0, 1).all()


def test_held_out_labels_are_not_read(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    hidden = Q.fold(F.col("doc_id")) == 0
    flipped = labels.withColumn("quality", F.when(hidden, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (Q.quality_scores(docs, x).orderBy("doc_id").toPandas() for x in (labels, flipped))
    assert np.allclose(a["score"], b["score"])


def test_negative_risk_is_kept_from_falling():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(2, 1, (800, 4)), rng.normal(-2, 1, (800, 4))
    mixed = np.vstack([good[400:], bad[:400]])
    model = Q.fit_nnpu(good[:400], mixed, 0.5)
    right = np.concatenate([model.score(good[:400]) > 0.5, model.score(bad[400:]) < 0.5])
    assert right.mean() > 0.97
    assert Q.nn_risk(model.margin(good[:400]), model.margin(mixed), 0.5)[1] > -0.05


def test_edge_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, 1), (2, "", 1), (None, "words here", 1), (4, "a b c", 1), (4, "a b c", 1), (5, "z " * 200_000, 1), (6, "x", 1)],
        "doc_id long, text string, score int",
    )
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (4, 1, 0), (6, 1, 0), (None, 1, 1), (5, None, 0)], "doc_id long, quality int, toxic int")
    got = Q.quality_scores(docs, labels).collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    none = Q.quality_scores(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert Q.quality_scores(docs.limit(0), labels).count() == 0
