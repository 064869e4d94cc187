"""Language identification by fusing evidence.

The posterior of a language combines the likelihood of the text with the language the markup
declares, the suffix of the address, and a prior of the host. All but the text likelihood come from
counts over all rows: the host's counts are smoothed towards those of its domain, and these towards
the counts of the whole corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import own_columns, saved, whole_rows

UNKNOWN = "und"
#: Text likelihoods are learned from at most so many rows of each declared language.
ROWS_PER_LANGUAGE = 1000
#: Declared languages with fewer rows get no model.
LEAST_ROWS = 5
#: Buckets that byte trigrams are hashed into.
BUCKETS = 1 << 15
#: Trigrams of a text overlap and repeat, so that a long text counts as so many independent ones.
EFFECTIVE_TRIGRAMS = 60
#: Weight of the wider group in a smoothed prior, in rows.
PRIOR_ROWS = 20.0
#: Prior share of texts in no known language, and the confidence below which a text is rejected.
UNKNOWN_SHARE, LEAST_CONFIDENCE = 0.01, 0.5

_KEEP = np.full(256, 32, np.uint8)
for _byte in [*range(ord("a"), ord("z") + 1), *range(128, 256)]:
    _KEEP[_byte] = _byte


def trigrams(text: str) -> np.ndarray:
    """Buckets of the byte trigrams of the letters of a text, words parted by single blanks."""
    raw = _KEEP[np.frombuffer(f" {text.lower()} ".encode(), np.uint8)]
    blank = raw == 32
    raw = raw[~(blank & np.concatenate(([False], blank[:-1])))].astype(np.uint32)
    if len(raw) < 3:
        return np.empty(0, np.int64)
    code = raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)


@dataclass(frozen=True)
class TextModel:
    languages: tuple[str, ...]
    #: Log probability of a bucket by language; the last column is text of no known language.
    weights: np.ndarray

    def score(self, text: str) -> list[float]:
        """Log likelihood of the text by language, unknown last, and the number of trigrams."""
        codes = trigrams(text)
        if not len(codes):
            return [0.0] * (len(self.languages) + 1) + [0.0]
        mean = self.weights[codes].mean(axis=0, dtype=np.float64)
        return [*(mean * min(len(codes), EFFECTIVE_TRIGRAMS)).tolist(), float(len(codes))]


def primary(declared: Column) -> Column:
    """The primary tag of a declared language (``en`` of ``en-US``), null if there is none."""
    tag = F.regexp_extract(F.lower(declared), r"^\s*([a-z]{2,3})(?![a-z])", 1)
    return F.when(tag != "", tag)


def address(url: Column) -> dict[str, Column]:
    """Host, domain and suffix of an address; null where the address has none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1))
    host = F.when(host != "", host)
    labels = F.split(host, r"\.")
    return {
        "host": host,
        "domain": F.array_join(F.slice(labels, -F.least(F.size(labels), F.lit(2)), 2), "."),
        "suffix": F.when(F.size(labels) > 1, F.element_at(labels, -1)),
    }


def visible_text(html: Column) -> Column:
    """Text of a page without scripts, styles, comments and tags."""
    return F.regexp_replace(
        html, r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<[^>]*>", " "
    )


def markup_language(html: Column) -> Column:
    return F.regexp_extract(html, r"""(?i)<html\b[^>]*?\slang\s*=\s*["']?([A-Za-z-]+)""", 1)


def fit(rows: DataFrame, key: str = "_key") -> TextModel:
    """The text model of all languages that ``LEAST_ROWS`` rows declare, from a bounded sample of rows.
    A language costs 128 KB of weights.

    The sample are the rows with the smallest hashes of ``key``; counts are aggregated by Spark, and
    only one count per bucket and language reaches the driver.
    """
    labelled = rows.filter(F.col("_declared").isNotNull())
    support = (
        labelled.groupBy("_declared").agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= LEAST_ROWS)
        .collect()
    )
    languages = tuple(sorted(r["_declared"] for r in support))
    if not languages:
        return TextModel((), np.zeros((BUCKETS, 1), np.float32))
    hashed = labelled.filter(F.col("_declared").isin(*languages)).withColumn("_h", F.xxhash64(key))
    first = W.partitionBy("_declared").orderBy("_h")
    limits = (
        hashed.select("_declared", "_h").withColumn("_at", F.row_number().over(first))
        .filter(F.col("_at") <= ROWS_PER_LANGUAGE)
        .groupBy("_declared").agg(F.max("_h").alias("_limit")).collect()
    )
    last = F.create_map(*[F.lit(x) for r in limits for x in (r["_declared"], r["_limit"])])
    chosen = F.col("_h") <= F.element_at(last, F.col("_declared"))
    place = {name: i for i, name in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[str, np.ndarray] = {}
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = sums.setdefault(name, np.zeros(BUCKETS, np.int64))
                own += np.bincount(trigrams(text.as_py()), minlength=BUCKETS)
            for name, own in sums.items():
                bucket = np.flatnonzero(own)
                where = np.full(len(bucket), place[name])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(where, pa.int32()), pa.array(bucket, pa.int32()), pa.array(own[bucket])],
                    names=["language", "bucket", "n"],
                )

    counted = (
        hashed.filter(chosen).select("_declared", "_text")
        .mapInArrow(count, "language int, bucket int, n long")
        .groupBy("language", "bucket").agg(F.sum("n").alias("n"))
        .toPandas()
    )
    sums = np.zeros((BUCKETS, len(languages)))
    sums[counted["bucket"], counted["language"]] = counted["n"]
    known = np.log((sums + 0.5) / (sums.sum(axis=0) + 0.5 * BUCKETS))
    unknown = np.full((BUCKETS, 1), -math.log(BUCKETS))
    return TextModel(languages, np.hstack([known, unknown]).astype(np.float32))


def _scorer(model: TextModel):
    @F.pandas_udf("array<double>")
    def score(texts: pd.Series) -> pd.Series:
        return texts.map(model.score)

    return score


def _smoothed(counts: Column, parent: Column) -> Column:
    """Shares of the languages in a group, smoothed towards those of its parent group."""
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(counts, parent, lambda n, p: (n + PRIOR_ROWS * p) / (total + PRIOR_ROWS))


def _summed(size: int) -> Column:
    return F.array(*[F.sum(F.col("_counts")[i]).cast("double") for i in range(size)])


def _log(values: Column) -> Column:
    return F.transform(values, lambda x: F.log(x))


def _add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def evidence(rows: DataFrame, model: TextModel) -> DataFrame:
    """``_host, _suffix, _declared, _evidence``: for each combination that occurs, the log prior of
    every language (unknown last) with the evidence of the declaration and the suffix.

    Rows are counted by the language their text alone suggests; null parts give no evidence.
    """
    names = [*model.languages, UNKNOWN]
    size = len(names)
    scores = F.slice("_scores", 1, size)
    best = F.when(F.element_at("_scores", -1) > 0, F.array_position(scores, F.array_max(scores)) - 1)
    keys = ["_host", "_domain", "_suffix", "_declared"]
    counted = saved(
        rows.withColumn("_scores", _scorer(model)("_text"))
        .select(*keys, best.alias("_best"))
        .groupBy(*keys)
        .agg(F.array(*[F.count_if(F.col("_best") == i).cast("double") for i in range(size)]).alias("_counts")),
        "language-counts",
    )
    totals = counted.agg(*[F.sum(F.col("_counts")[i]).alias(f"n{i}") for i in range(size)]).first()
    sums = [float(totals[i] or 0) + 1.0 for i in range(size)]
    known = sum(sums[:-1])
    shares = [(1 - UNKNOWN_SHARE) * x / known for x in sums[:-1]] + [UNKNOWN_SHARE] if known else [1.0]
    whole = F.array(*[F.lit(x) for x in shares])

    def likelihood(key: str) -> DataFrame:
        """P(value of key | language) up to a factor, smoothed by the value's overall share."""
        table = counted.filter(F.col(key).isNotNull()).groupBy(key).agg(_summed(size).alias("_c"))
        value_share = F.aggregate("_c", F.lit(0.0), lambda a, x: a + x) / F.lit(sum(sums))
        by_language = F.zip_with(
            "_c",
            F.array(*[F.lit(x) for x in sums]),
            lambda n, total: F.log((n + PRIOR_ROWS * (value_share + 1e-6)) / (total + PRIOR_ROWS)),
        )
        return table.select(key, by_language.alias(f"{key}_evidence"))

    domains = counted.filter(F.col("_domain").isNotNull()).groupBy("_domain").agg(_summed(size).alias("_c"))
    domains = domains.select("_domain", _smoothed(F.col("_c"), whole).alias("_parent"))
    hosts = counted.filter(F.col("_host").isNotNull()).groupBy("_host").agg(_summed(size).alias("_c"), F.first("_domain", True).alias("_domain"))
    hosts = hosts.join(domains, "_domain", "left").select(
        "_host", _smoothed(F.col("_c"), F.coalesce("_parent", whole)).alias("_prior")
    )
    none = F.array(*[F.lit(0.0)] * size)
    return (
        counted.select("_host", "_suffix", "_declared").distinct()
        .join(hosts, "_host", "left")
        .join(likelihood("_suffix"), "_suffix", "left")
        .join(likelihood("_declared"), "_declared", "left")
        .select(
            "_host", "_suffix", "_declared",
            _add(
                _log(F.coalesce("_prior", whole)),
                _add(F.coalesce("_suffix_evidence", none), F.coalesce("_declared_evidence", none)),
            ).alias("_evidence"),
        )
    )


def identify(
    df: DataFrame,
    text: Column,
    declared: Column | None = None,
    host: Column | None = None,
    domain: Column | None = None,
    suffix: Column | None = None,
    key: Column | None = None,
) -> DataFrame:
    """``df`` with ``language, confidence, accepted``; one row per input row.

    ``language`` is the most probable one, ``und`` for texts without letters or best explained by no
    known language; ``accepted`` is false for ``und`` and for a confidence below
    ``LEAST_CONFIDENCE``. Null texts count as empty, null evidence is left out. Languages are those
    that at least ``LEAST_ROWS`` rows of ``df`` declare, however many; with none, all rows are ``und``. Columns of ``df`` named as the three
    results are replaced. ``key`` orders the training sample and should identify rows.

    The texts stay where they are when Spark measures the table of evidence (one row per host,
    suffix and declaration) as small; otherwise adaptive execution splits hot hosts in the join.
    """
    null = F.lit(None).cast("string")
    text = F.coalesce(text, F.lit(""))
    rows = whole_rows(
        df,
        _text=text,
        _declared=primary(declared) if declared is not None else null,
        _host=host if host is not None else null,
        _domain=domain if domain is not None else null,
        _suffix=suffix if suffix is not None else null,
        _key=(key if key is not None else text).cast("string"),
    )
    internal = ["_text", "_declared", "_host", "_domain", "_suffix", "_key"]
    model = fit(rows.select(*internal))
    size = len(model.languages) + 1
    found = saved(evidence(rows.select(*internal), model), "language-evidence").select(
        F.col("_host").alias("_h"), F.col("_suffix").alias("_s"), F.col("_declared").alias("_d"), "_evidence"
    )
    same = F.col("_host").eqNullSafe(F.col("_h")) & F.col("_suffix").eqNullSafe(F.col("_s")) & F.col("_declared").eqNullSafe(F.col("_d"))
    joined = rows.join(found, same, "left").withColumn("_scores", _scorer(model)("_text"))
    total = _add(F.slice("_scores", 1, size), F.col("_evidence"))
    top = F.array_max("_total")
    names = F.array(*[F.lit(x) for x in (*model.languages, UNKNOWN)])
    mass = F.aggregate("_total", F.lit(0.0), lambda a, x: a + F.exp(x - top))
    fused = joined.withColumn("_total", total).withColumns(
        {
            "_letters": F.element_at("_scores", -1) > 0,
            "_best": F.element_at(names, F.array_position("_total", top).cast("int")),
            "_confidence": 1 / mass,
        }
    )
    language = F.when(F.col("_letters"), F.col("_best")).otherwise(F.lit(UNKNOWN))
    accepted = (language != UNKNOWN) & (F.col("_confidence") >= LEAST_CONFIDENCE)
    results = ("language", "confidence", "accepted")
    kept = [c for c, name in zip(own_columns(fused, df), df.columns) if name not in results]
    return fused.select(
        *kept,
        language.alias("language"),
        F.when(F.col("_letters"), F.col("_confidence")).otherwise(0.0).alias("confidence"),
        accepted.alias("accepted"),
    )
