"""Evidence selection and explanation texts for material changes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import identifiers as I
from tidemark.functions import text as X
from tidemark.functions.scoring import (
    DIRECTION_THRESHOLD,
    DRIFT_HIGH,
    DRIFT_LOW,
    approximate_intensity,
)
from tidemark.operators.intensity import unique_labels
from tidemark.schemas import assert_columns

# Evidence rows per version, cap on explanations, prompt excerpt length.
EVIDENCE_PER_VERSION = 2
MAX_EXPLANATIONS = 500
EXCERPT_CHARS = 600
TEMPLATE_MODEL = "fallback_template"
SYSTEM_PROMPT = (
    "You explain changes in company disclosures to financial analysts. Be concise, rely only "
    "on the excerpts you are given and do not speculate."
)
# The sentences of the template.
RISE, FALL, SHIFT = "significant increase", "significant decrease", "moderate shift"
SAME_WORDING = "language used remained largely consistent"
OTHER_WORDING = "language evolved noticeably across years"
NEW_WORDING = "language changed substantially, suggesting a reframing of the topic"
NO_DRIFT = "The centroid drift is not measurable for this pair of years."
_KEY = ("cik", "cluster_id", "fiscal_year")
# Below this many changes the wanted keys are a proven small table and may be broadcast.
BROADCAST_ROWS = 10_000


def first_evidence(
    chunks: DataFrame, n: int = EVIDENCE_PER_VERSION, text_col: str = "text"
) -> DataFrame:
    """The first ``n`` chunks of every (entity, theme, version) in document order.

    The row filter is pushed below the shuffle, so a hot group sends ``n`` rows per task.
    """
    assert_columns(chunks, ("chunk_id", *_KEY, text_col), "first_evidence")
    order = [F.col("chunk_index")] if "chunk_index" in chunks.columns else []
    within = Window.partitionBy(*_KEY).orderBy(*order, "chunk_id")
    return (
        chunks.select(*_KEY, *order, "chunk_id", F.col(text_col).alias("text"))
        .withColumn("place", F.row_number().over(within))
        .where(F.col("place") <= n)
        .select(*_KEY, "place", "chunk_id", "text")
    )


def _gathered(evidence: DataFrame, name: str) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct("place", "chunk_id", "text")))
    return evidence.groupBy(*_KEY).agg(ordered.alias(name))


def attach_evidence(
    changes: DataFrame,
    chunks: DataFrame,
    n: int = EVIDENCE_PER_VERSION,
    text_col: str = "text",
    max_changes: int | None = None,
) -> DataFrame:
    """Adds ``evidence_current`` and ``evidence_previous`` (arrays, empty when none).

    With a known cap on the changes their keys are a proven small table: they are broadcast and
    reduce the chunks before anything is shuffled. Without a cap nearly every version is asked
    for, so the first rows of all of them are taken, which also combines before the shuffle.
    """
    relevant = chunks
    if max_changes is not None and max_changes <= BROADCAST_ROWS:
        keys = changes.select(*_KEY)
        before = keys.withColumn("fiscal_year", F.col("fiscal_year") - 1)
        wanted = keys.unionByName(before).distinct()
        relevant = chunks.join(F.broadcast(wanted), list(_KEY), "left_semi")
    evidence = first_evidence(relevant, n, text_col)
    current = _gathered(evidence, "evidence_current")
    previous = _gathered(evidence, "evidence_previous").withColumn(
        "fiscal_year", F.col("fiscal_year") + 1
    )
    joined = changes.join(current, list(_KEY), "left").join(previous, list(_KEY), "left")
    none = F.array().cast("array<struct<place:int,chunk_id:string,text:string>>")
    return joined.withColumns(
        {c: F.coalesce(c, none) for c in ("evidence_current", "evidence_previous")}
    )


def _intensities(frame: DataFrame) -> tuple[Column, Column]:
    """Current and previous intensity; stand-ins around one half if only the delta is known."""
    if {"intensity", "prev_intensity"} <= set(frame.columns):
        return F.col("intensity"), F.col("prev_intensity")
    delta = F.coalesce(F.col("intensity_delta"), F.lit(0.0))
    return approximate_intensity(delta, +1), approximate_intensity(delta, -1)


def template_text(frame: DataFrame, label: Column) -> Column:
    """Sentence template for one change; needs no generator."""
    current, previous = _intensities(frame)
    delta = F.col("intensity_delta")
    drift = F.col("centroid_drift")
    direction = (
        F.when(delta > DIRECTION_THRESHOLD, F.lit(RISE))
        .when(delta < -DIRECTION_THRESHOLD, F.lit(FALL))
        .otherwise(F.lit(SHIFT))
    )
    wording = (
        F.when(drift < DRIFT_LOW, F.lit(SAME_WORDING))
        .when(drift < DRIFT_HIGH, F.lit(OTHER_WORDING))
        .otherwise(F.lit(NEW_WORDING))
    )
    drift_sentence = F.when(
        drift.isNull(), F.lit(NO_DRIFT)
    ).otherwise(
        F.concat(
            F.lit("The centroid drift of "),
            X.fixed_point(drift, 3),
            F.lit(" suggests the "),
            wording,
            F.lit("."),
        )
    )
    return F.concat(
        F.lit('The theme "'), label, F.lit('" showed a '), direction, F.lit(" in FY"),
        F.col("fiscal_year").cast("string"),
        F.lit(" (intensity: "), X.percent(previous), F.lit(" → "), X.percent(current),
        F.lit(", change: "), X.signed_percent(delta), F.lit("). "),
        drift_sentence,
    )


def _excerpts(evidence: Column, offset: Column) -> Column:
    """Numbered, flattened, shortened excerpts, one per line."""

    def line(item: Column, index: Column) -> Column:
        flat = X.strip(F.replace(item["text"], F.lit("\n"), F.lit(" ")))
        short = F.when(
            F.length(flat) > EXCERPT_CHARS,
            F.concat(F.left(flat, F.lit(EXCERPT_CHARS - 3)), F.lit("...")),
        ).otherwise(flat)
        number = (offset + index + 1).cast("string")
        return F.concat(F.lit("["), number, F.lit('] "'), short, F.lit('"'))

    return F.when(
        F.size(evidence) > 0, F.array_join(F.transform(evidence, line), "\n")
    ).otherwise(F.lit("[No excerpts available]"))


def explanation_prompt(frame: DataFrame, label: Column) -> Column:
    """Prompt for a text generator: figures and numbered excerpts of both versions."""
    current, previous = _intensities(frame)
    year = F.col("fiscal_year").cast("int")
    shown_drift = F.coalesce(X.fixed_point(F.col("centroid_drift"), 4), F.lit("n/a"))
    return F.concat(
        F.lit("Theme: "), label, F.lit("\nIntensity change: "),
        X.fixed_point(previous, 3), F.lit(" -> "), X.fixed_point(current, 3),
        F.lit(" (delta="), X.signed_fixed_point(F.col("intensity_delta"), 3), F.lit(")\n"),
        F.lit("Materiality score: "), X.fixed_point(F.col("materiality_score"), 4),
        F.lit("\nCentroid drift: "), shown_drift, F.lit(" (0 = same wording)\n"),
        F.lit("\nExcerpts from FY"), year.cast("string"), F.lit(" 10-K:\n"),
        _excerpts(F.col("evidence_current"), F.lit(0)),
        F.lit("\n\nExcerpts from FY"), (year - 1).cast("string"), F.lit(" 10-K:\n"),
        _excerpts(F.col("evidence_previous"), F.size("evidence_current")),
        F.lit(
            "\n\nExplain in two or three sentences what changed and why it may matter. Use only "
            "the figures and excerpts above and name the year of the excerpt behind each claim."
        ),
    )


def build_explanations(
    ranked: DataFrame,
    chunks: DataFrame,
    labels: DataFrame,
    max_explanations: int = MAX_EXPLANATIONS,
    generate: Callable[[DataFrame], DataFrame] | None = None,
    model: str = TEMPLATE_MODEL,
    text_col: str = "text",
) -> DataFrame:
    """Explanation rows of the ``max_explanations`` best ranked changes.

    ``ranked`` has a ``rank`` column; ``labels`` is ``cluster_id, label``. ``generate`` maps
    ``change_id, prompt`` to ``change_id, generated`` and may leave rows out; those, and all
    rows without a generator, get the template text.
    """
    assert_columns(ranked, (*_KEY, "rank", "intensity_delta", "materiality_score"), "explain")
    chosen = ranked.where(F.col("rank") <= max_explanations)
    if "centroid_drift" not in chosen.columns:
        chosen = chosen.withColumn("centroid_drift", F.lit(None).cast("double"))
    names = unique_labels(labels).withColumnRenamed("label", "theme_label")
    label = F.coalesce(
        F.col("theme_label"), F.concat(F.lit("cluster_"), F.col("cluster_id").cast("string"))
    )
    grounded = attach_evidence(
        chosen, chunks, text_col=text_col, max_changes=max_explanations
    ).join(names, "cluster_id", "left")
    ids = F.concat(F.col("evidence_current.chunk_id"), F.col("evidence_previous.chunk_id"))
    described = grounded.select(
        "rank",
        I.change_id(F.col("cik"), F.col("cluster_id"), F.col("fiscal_year")).alias("change_id"),
        *_KEY,
        template_text(grounded, label).alias("_template"),
        explanation_prompt(grounded, label).alias("_prompt"),
        ids.alias("evidence_chunk_ids"),
    )
    if generate is None:
        text, used = F.col("_template"), F.lit(TEMPLATE_MODEL)
    else:
        produced = generate(described.select("change_id", F.col("_prompt").alias("prompt")))
        described = described.join(
            produced.select("change_id", F.col("generated").alias("_g")), "change_id", "left"
        )
        text = F.coalesce("_g", "_template")
        used = F.when(F.col("_g").isNotNull(), F.lit(model)).otherwise(F.lit(TEMPLATE_MODEL))
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    return described.select(
        "rank",
        "change_id",
        *_KEY,
        text.alias("explanation_text"),
        "evidence_chunk_ids",
        used.alias("model_used"),
        stamp.alias("generated_at"),
    )
