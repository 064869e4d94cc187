"""Declared table schemas of the gold star and the checks each table must pass."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scoring import CHANGE_TYPES

STRING = T.StringType()
LONG = T.LongType()
DOUBLE = T.DoubleType()
BOOLEAN = T.BooleanType()

CHUNK_COLUMNS = (
    "chunk_id", "cik", "fiscal_year", "accession_number", "section", "chunk_index", "text",
    "token_count",
)
INTENSITY_COLUMNS = (
    "cik", "fiscal_year", "cluster_id", "cluster_label", "chunk_count", "total_chunks",
    "intensity", "is_present",
)


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: T.DataType
    nullable: bool = False
    minimum: float | None = None
    maximum: float | None = None
    allowed: tuple[str, ...] | None = None
    default: object | None = None


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[ColumnSpec, ...] = field(default_factory=tuple)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type, True) for c in self.columns])

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]


COMPANIES = TableSpec(
    "companies",
    (
        ColumnSpec("cik", STRING),
        ColumnSpec("ticker", STRING, nullable=True),
        ColumnSpec("name", STRING),
        ColumnSpec("sector", STRING, nullable=True),
        ColumnSpec("first_year", LONG),
        ColumnSpec("last_year", LONG),
    ),
)
THEMES = TableSpec(
    "themes",
    (
        ColumnSpec("cluster_id", LONG),
        ColumnSpec("label", STRING),
        ColumnSpec("n_companies_ever", LONG),
        ColumnSpec("first_seen_year", LONG),
        ColumnSpec("last_seen_year", LONG),
        ColumnSpec("override_flag", BOOLEAN, default=False),
    ),
)
THEME_INTENSITY = TableSpec(
    "theme_intensity",
    (
        ColumnSpec("cik", STRING),
        ColumnSpec("fiscal_year", LONG),
        ColumnSpec("cluster_id", LONG),
        ColumnSpec("intensity", DOUBLE, minimum=0.0, maximum=1.0),
        ColumnSpec("chunk_count", LONG, minimum=0),
    ),
)
THEME_CHANGES = TableSpec(
    "theme_changes",
    (
        ColumnSpec("cik", STRING),
        ColumnSpec("cluster_id", LONG),
        ColumnSpec("fiscal_year", LONG),
        ColumnSpec("intensity_delta", DOUBLE),
        ColumnSpec("centroid_drift", DOUBLE, nullable=True),
        ColumnSpec("materiality_score", DOUBLE, minimum=0.0),
        ColumnSpec("change_type", STRING, allowed=CHANGE_TYPES),
    ),
)
EXPLANATIONS = TableSpec(
    "explanations",
    (
        ColumnSpec("change_id", STRING),
        ColumnSpec("cik", STRING),
        ColumnSpec("cluster_id", LONG),
        ColumnSpec("fiscal_year", LONG),
        ColumnSpec("explanation_text", STRING),
        ColumnSpec("evidence_chunk_ids", T.ArrayType(STRING), nullable=True),
        ColumnSpec("model_used", STRING),
        ColumnSpec("generated_at", STRING),
    ),
)
EVIDENCE_CHUNKS = TableSpec(
    "evidence_chunks",
    (
        ColumnSpec("chunk_id", STRING),
        ColumnSpec("cik", STRING),
        ColumnSpec("fiscal_year", LONG),
        ColumnSpec("cluster_id", LONG),
        ColumnSpec("text", STRING),
        ColumnSpec("char_start_note", STRING, nullable=True),
    ),
)
DATA_QUALITY = TableSpec(
    "data_quality",
    (
        ColumnSpec("fiscal_year", LONG),
        ColumnSpec("extraction_success_rate", DOUBLE, minimum=0.0, maximum=1.0),
        ColumnSpec("noise_fraction", DOUBLE, minimum=0.0, maximum=1.0),
        ColumnSpec("total_chunks", LONG, minimum=0),
        ColumnSpec("total_filings", LONG, minimum=0),
        ColumnSpec("failed_extractions", LONG, minimum=0),
    ),
)
GOLD_TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        COMPANIES,
        THEMES,
        THEME_INTENSITY,
        THEME_CHANGES,
        EXPLANATIONS,
        EVIDENCE_CHUNKS,
        DATA_QUALITY,
    )
}


def assert_columns(df: DataFrame, required: Iterable[str], context: str = "") -> None:
    """Analysis-time guard: raise ``ValueError`` naming every missing column."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(
            f"[{context}] missing required columns: {missing}; available: {sorted(df.columns)}"
        )


class SchemaViolation(ValueError):
    """Raised with the count of failing rows per rule."""

    def __init__(self, table: str, failures: dict[str, int]):
        self.table = table
        self.failures = failures
        super().__init__(f"table '{table}' fails its checks: {failures}")


def coerce(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Select and cast to the declared types; a value that cannot be cast becomes NULL."""
    assert_columns(
        df, [c.name for c in spec.columns if c.default is None], f"coerce:{spec.name}"
    )

    def typed(column: ColumnSpec) -> Column:
        if column.name not in df.columns:
            return F.lit(column.default).cast(column.type).alias(column.name)
        return F.col(column.name).try_cast(column.type).alias(column.name)

    return df.select(*[typed(c) for c in spec.columns])


def _rules(spec: TableSpec) -> dict[str, Column]:
    rules: dict[str, Column] = {}
    for column in spec.columns:
        value = F.col(column.name)
        if not column.nullable:
            rules[f"{column.name}:not_null"] = value.isNull()
        if column.minimum is not None:
            rules[f"{column.name}:minimum"] = value < column.minimum
        if column.maximum is not None:
            rules[f"{column.name}:maximum"] = value > column.maximum
        if column.allowed is not None:
            rules[f"{column.name}:allowed"] = ~value.isin(*column.allowed)
    return rules


def count_violations(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row with one count per rule, from a single pass over the coerced data."""
    rules = _rules(spec)
    return coerce(df, spec).agg(
        *[F.count_if(bad).alias(name) for name, bad in rules.items()]
    )


def violations(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Long form of :func:`count_violations`: ``rule``, ``failures`` (all rules, also zeros)."""
    counts = count_violations(df, spec)
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("rule"), F.col(f"`{name}`").alias("failures"))
            for name in _rules(spec)
        ]
    )
    return counts.select(F.inline(pairs))


def validate(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Coerced frame, or :class:`SchemaViolation` listing every failing rule at once."""
    counts = count_violations(df, spec).first().asDict()
    failures = {rule: n for rule, n in counts.items() if n}
    if failures:
        raise SchemaViolation(spec.name, failures)
    return coerce(df, spec)


def observed(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, Callable[[], None]]:
    """Coerced frame whose violations are counted while it is written, and a check to call after the
    write, which raises :class:`SchemaViolation`."""
    seen = Observation()
    rules = _rules(spec)
    counts = [F.count_if(bad).alias(name) for name, bad in rules.items()]
    frame = coerce(df, spec).observe(seen, F.count(F.lit(1)).alias("_rows"), *counts)

    def check() -> None:
        failures = {rule: n for rule, n in seen.get.items() if n and rule != "_rows"}
        if failures:
            raise SchemaViolation(spec.name, failures)

    return frame, check


def empty_frame(spark, spec: TableSpec) -> DataFrame:
    return spark.createDataFrame([], spec.schema)
