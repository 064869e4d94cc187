"""Theme labels: overrides first, then a text generator if given, then frequent terms."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import identifiers as I
from tidemark.functions import text as X
from tidemark.functions import vectors as V
from tidemark.functions.skew import lookup_join
from tidemark.functions.stopwords import english_stop_words
from tidemark.operators.intensity import NOISE_CLUSTER, unique_labels
from tidemark.schemas import assert_columns
from tidemark.session import cut_lineage

# Terms per label, excerpts per prompt, characters per excerpt.
TERMS_PER_LABEL = 3
REPRESENTATIVES = 5
EXCERPT_CHARS = 500
#: Leading words of all themes that pairs of words are looked up in.
LEADING_WORDS = 1000


def term_counts(
    texts: DataFrame, text_col: str = "text", stop_words: Iterable[str] | None = None
) -> DataFrame:
    """Occurrences of one- and two-word terms per theme, combined before the shuffle."""
    # Two projections: the token array is used several times and must be computed once.
    skipped = english_stop_words() if stop_words is None else stop_words
    tokenized = texts.select("cluster_id", X.tokens(F.col(text_col), skipped).alias("tokens"))
    listed = tokenized.select("cluster_id", F.explode(X.terms(F.col("tokens"))).alias("term"))
    return listed.groupBy("cluster_id", "term").agg(F.count(F.lit(1)).alias("n"))


def keyword_labels(
    texts: DataFrame,
    text_col: str = "text",
    top: int = TERMS_PER_LABEL,
    stop_words: Iterable[str] | None = None,
) -> DataFrame:
    """The most frequent terms of each theme as its label; later terms win ties.

    A pair of words is at most as frequent as each of them. So single words are counted first, and
    pairs only of words that are as frequent as the theme's ``top``-th: all others are behind. Where
    so many words are as frequent that their list is long, all pairs are counted. The rank filter is
    pushed below the shuffle, so each task sends at most ``top`` terms per theme.
    """
    skipped = english_stop_words() if stop_words is None else stop_words
    tokenized = texts.select("cluster_id", X.tokens(F.col(text_col), skipped).alias("tokens"))
    singles = tokenized.select("cluster_id", F.explode("tokens").alias("term"))
    singles = singles.groupBy("cluster_id", "term").agg(F.count(F.lit(1)).alias("n"))
    by_count = Window.partitionBy("cluster_id").orderBy(F.desc("n"))
    leading = singles.withColumn("_r", F.rank().over(by_count)).where(F.col("_r") <= top).drop("_r")
    leading = cut_lineage(leading)
    if leading.count() <= LEADING_WORDS:
        listed = leading.groupBy("cluster_id").agg(F.collect_list("term").alias("leading"))
        # At most LEADING_WORDS words in all.
        names = F.broadcast(listed.withColumnRenamed("cluster_id", "_c"))
        known = tokenized.join(names, F.col("cluster_id").eqNullSafe(F.col("_c")))
        pairs = F.transform(
            X.neighbours(F.col("tokens")),
            lambda p: F.when(F.array_contains("leading", p["a"]) & F.array_contains("leading", p["b"]), p),
        )
        kept = known.select("cluster_id", F.explode(F.array_compact(pairs)).alias("p"))
        kept = kept.select("cluster_id", F.concat("p.a", F.lit(" "), "p.b").alias("term"))
        counted = kept.groupBy("cluster_id", "term").agg(F.count(F.lit(1)).alias("n")).unionByName(leading)
    else:
        counted = term_counts(texts, text_col, skipped)
    order = Window.partitionBy("cluster_id").orderBy(F.desc("n"), F.desc("term"))
    ranked = counted.withColumn("place", F.row_number().over(order))
    best = (
        ranked.where(F.col("place") <= top)
        .groupBy("cluster_id")
        .agg(F.array_sort(F.collect_list(F.struct("place", "term"))).alias("best"))
    )
    joined = F.array_join(F.transform("best", lambda b: X.title_case(b["term"])), " / ")
    return best.select("cluster_id", F.left(joined, F.lit(X.LABEL_LENGTH)).alias("label"))


def representative_chunks(
    chunks: DataFrame, embeddings: DataFrame, centroids: DataFrame, top: int = REPRESENTATIVES
) -> DataFrame:
    """The members of each theme closest to its centroid: ``cluster_id``, identity, ``place``."""
    assert_columns(chunks, ("chunk_id", "cluster_id"), "representative_chunks")
    ids = I.chunk_identity(chunks, embeddings)
    members = (
        chunks.where(F.col("cluster_id") != NOISE_CLUSTER)
        .select(*ids, "cluster_id")
        .join(embeddings.select(*ids, "embedding"), ids)
    )
    near = lookup_join(members, centroids.select("cluster_id", "centroid"), ["cluster_id"], ids).select(
        "cluster_id",
        *ids,
        V.cosine_distance(F.col("embedding"), F.col("centroid")).alias("distance"),
    )
    order = Window.partitionBy("cluster_id").orderBy("distance", *reversed(ids))
    return (
        near.withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= top)
        .select("cluster_id", *ids, "place")
    )


def label_prompts(representatives: DataFrame, chunks: DataFrame, text_col: str = "text") -> DataFrame:
    """One naming prompt per theme from its (few) representative excerpts."""
    assert_columns(chunks, ("chunk_id", text_col), "label_prompts")
    ids = I.chunk_identity(representatives, chunks)
    found = representatives.join(chunks.select(*ids, F.col(text_col).alias("t")), ids)
    gathered = found.groupBy("cluster_id").agg(
        F.array_sort(F.collect_list(F.struct("place", "t"))).alias("r")
    )
    numbered = F.transform(
        "r",
        lambda r, i: F.concat(
            F.lit("["), (i + 1).cast("string"), F.lit("] "), F.left(r["t"], F.lit(EXCERPT_CHARS))
        ),
    )
    return gathered.select(
        "cluster_id",
        F.concat(
            F.lit("Below are "),
            F.size("r").cast("string"),
            F.lit(
                " excerpts from company risk disclosures. Name the risk theme they share in "
                "three to six words. Answer with the label only.\n\n"
            ),
            F.array_join(numbered, "\n\n"),
        ).alias("prompt"),
    )


def label_themes(
    themes: DataFrame,
    representatives: DataFrame,
    chunks: DataFrame,
    overrides: DataFrame | None = None,
    generate: Callable[[DataFrame], DataFrame] | None = None,
    text_col: str = "text",
    stop_words: Iterable[str] | None = None,
) -> DataFrame:
    """``cluster_id, label`` for every theme: override > generated > keywords > unknown.

    ``generate`` maps prompts (``cluster_id, prompt``) to ``cluster_id, raw_label``.
    """
    ids = I.chunk_identity(representatives, chunks)
    texts = representatives.join(chunks.select(*ids, F.col(text_col).alias("text")), ids)
    keywords = keyword_labels(texts, stop_words=stop_words).withColumnRenamed("label", "keyword")
    labelled = themes.select("cluster_id").distinct().join(keywords, "cluster_id", "left")
    choices = [F.col("keyword"), F.lit(X.UNKNOWN_LABEL)]
    if generate is not None:
        raw = generate(label_prompts(representatives, chunks, text_col))
        cleaned = raw.select("cluster_id", X.clean_label(F.col("raw_label")).alias("generated"))
        labelled = labelled.join(cleaned, "cluster_id", "left")
        choices.insert(0, F.when(F.col("generated") != "", F.col("generated")))
    if overrides is not None:
        manual = unique_labels(overrides).select(
            "cluster_id", X.clean_label(F.col("label")).alias("manual")
        )
        labelled = labelled.join(manual, "cluster_id", "left")
        choices.insert(0, F.col("manual"))
    return labelled.select("cluster_id", F.coalesce(*choices).alias("label"))
