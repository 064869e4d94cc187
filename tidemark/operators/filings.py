"""Filing lists and financial facts from submission and company-facts JSON documents."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import identifiers as I
from tidemark.schemas import assert_columns

# Form types, default look-back, and the parallel arrays of a submissions page.
ANNUAL_FORM = "10-K"
ANNUAL_WITH_AMENDMENTS = ("10-K", "10-K/A")
LOOK_BACK_YEARS = 5
SUBMISSIONS_SCHEMA = (
    "struct<cik:string, name:string, filings:struct<recent:struct<"
    "accessionNumber:array<string>, form:array<string>, filingDate:array<string>, "
    "reportDate:array<string>, primaryDocument:array<string>>>>"
)
# Annual forms, units and concepts (with their fallback) of the standard facts.
FACT_FORMS = ("10-K", "10-K/A", "10-KT", "10-KT/A")
FACT_UNITS = ("USD", "shares", "USD/shares")
FACT_PERIOD = "FY"
TAXONOMIES = ("us-gaap", "dei")
STANDARD_CONCEPTS = (
    ("Revenues", "RevenueFromContractWithCustomerExcludingAssessedTax"),
    ("NetIncomeLoss", None),
    ("Assets", None),
    ("Liabilities", None),
    ("StockholdersEquity", "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest"),
    ("EarningsPerShareBasic", None),
)
FACTS_SCHEMA = (
    "struct<cik:string, facts:map<string, map<string, struct<units:map<string, array<struct<"
    "`end`:string, val:string, accn:string, fy:int, fp:string, form:string, filed:string>>>>>>>"
)


def parse_submissions(documents: DataFrame, json_col: str = "json") -> DataFrame:
    """One row per listed filing: the parallel arrays are zipped up to the shortest one."""
    assert_columns(documents, (json_col,), "parse_submissions")
    page = documents.withColumn("_s", F.from_json(F.col(json_col), SUBMISSIONS_SCHEMA))
    recent = F.col("_s.filings.recent")
    names = ("accessionNumber", "form", "filingDate", "reportDate", "primaryDocument")
    arrays = [recent[n] for n in names]
    shortest = F.least(*[F.coalesce(F.size(a), F.lit(0)) for a in arrays])
    zipped = F.slice(F.arrays_zip(*[a.alias(n) for a, n in zip(arrays, names)]), F.lit(1), shortest)
    rows = page.select(
        *[F.col(c) for c in documents.columns if c not in (json_col, "cik")],
        I.pad_cik(F.col("_s.cik")).alias("cik"),
        F.inline(zipped).alias(*names),
    )
    return rows.withColumnsRenamed(
        {
            "accessionNumber": "accession_number",
            "filingDate": "filing_date",
            "reportDate": "report_date",
            "primaryDocument": "primary_document",
        }
    )


def annual_filings(
    documents: DataFrame,
    years: Iterable[int] | None = None,
    include_amendments: bool = False,
    json_col: str = "json",
) -> DataFrame:
    """Annual filings; the fiscal year is the year of the filing date (0 without a date)."""
    forms = ANNUAL_WITH_AMENDMENTS if include_amendments else (ANNUAL_FORM,)
    date_text = F.coalesce(F.col("filing_date"), F.lit(""))
    year = F.coalesce(F.left(date_text, F.lit(4)).try_cast("int"), F.lit(0))
    kept = (
        parse_submissions(documents, json_col)
        .where(F.col("form").isin(*forms))
        .withColumn("fiscal_year", year)
    )
    wanted = sorted(set(years)) if years else []
    return kept.where(F.col("fiscal_year").isin(*wanted)) if wanted else kept


def recent_annual_filings(
    documents: DataFrame,
    look_back_years: int = LOOK_BACK_YEARS,
    as_of: Column | None = None,
    json_col: str = "json",
) -> DataFrame:
    """Annual filings and amendments filed in the last years, newest fiscal year first.

    Filings whose date cannot be read are left out.
    """
    today = as_of if as_of is not None else F.current_date()
    cutoff = F.add_months(today, -12 * look_back_years)
    filed = F.try_to_date("filing_date", "yyyy-MM-dd")
    dated = parse_submissions(documents, json_col).withColumn("_d", filed)
    kept = dated.where(
        F.col("form").isin(*ANNUAL_WITH_AMENDMENTS)
        & F.col("_d").isNotNull()
        & (F.col("_d") >= cutoff)
    )
    return (
        kept.withColumn("fiscal_year", F.year("_d"))
        .drop("_d")
        .orderBy(F.desc("fiscal_year"), "cik", "accession_number")
    )


def fact_entries(documents: DataFrame, json_col: str = "json") -> DataFrame:
    """Annual entries of every taxonomy and concept, one row each.

    Unreadable documents give no rows. ``unit_pos`` and ``entry_pos`` keep the document order,
    which decides ties later on.
    """
    assert_columns(documents, (json_col,), "fact_entries")
    keep = [F.col(c) for c in documents.columns if c not in (json_col, "cik")]
    parsed = documents.select(*keep, F.from_json(F.col(json_col), FACTS_SCHEMA).alias("_d"))
    kept = [F.col(c) for c in documents.columns if c not in (json_col, "cik")]
    by_taxonomy = parsed.select(
        *kept, I.pad_cik(F.col("_d.cik")).alias("cik"), F.explode("_d.facts").alias("taxonomy", "_c")
    ).where(F.col("taxonomy").isin(*TAXONOMIES))
    by_concept = by_taxonomy.select(*kept, "cik", "taxonomy", F.explode("_c").alias("concept", "_b"))
    by_unit = by_concept.select(
        *kept, "cik", "taxonomy", "concept",
        F.posexplode("_b.units").alias("unit_pos", "unit", "_e"),
    ).where(F.col("unit").isin(*FACT_UNITS))
    entries = by_unit.select(
        *kept, "cik", "taxonomy", "concept", "unit", "unit_pos",
        F.posexplode("_e").alias("entry_pos", "e"),
    )
    return entries.where(
        F.col("e.form").isin(*FACT_FORMS) & (F.col("e.fp") == FACT_PERIOD)
    ).select(
        *kept, "cik", "taxonomy", "concept", "unit", "unit_pos", "entry_pos",
        F.col("e.fy").alias("fiscal_year"),
        F.col("e.val").alias("raw_value"),
        F.coalesce("e.filed", F.lit("")).alias("filed"),
        F.coalesce("e.accn", F.lit("")).alias("accn"),
        F.col("e.filed").alias("filed_date"),
        F.col("e.end").alias("period_end"),
    )


def _recency(prefer_latest_period: bool) -> list[Column]:
    """Latest filing first; document order breaks ties, or the later period when asked for."""
    period = [F.coalesce("period_end", F.lit(""))] if prefer_latest_period else []
    return [F.col("filed"), F.col("accn"), *period, -F.col("unit_pos"), -F.col("entry_pos")]


def _search_order(concepts: Iterable[tuple[str, str | None]]) -> Column:
    """Map from ``taxonomy/concept`` to (primary name, rank in the search)."""
    pairs: list[Column] = []
    for primary, fallback in concepts:
        rank = 0
        for name in (primary, fallback):
            for taxonomy in TAXONOMIES:
                if name:
                    pairs.append(F.lit(f"{taxonomy}/{name}"))
                    pairs.append(
                        F.struct(F.lit(primary).alias("primary"), F.lit(rank).alias("rank"))
                    )
                rank += 1
    return F.create_map(*pairs)


def standard_facts(
    documents: DataFrame,
    fiscal_years: Iterable[int] | None = None,
    json_col: str = "json",
    prefer_latest_period: bool = False,
) -> DataFrame:
    """One value per (entity, year, concept) from the first place in the search that has any.

    A single aggregation with map-side combine: of all candidate entries the one with the
    lowest search rank and then the latest filing wins. A winner without a number is left out.
    """
    place = F.try_element_at(
        _search_order(STANDARD_CONCEPTS), F.concat_ws("/", "taxonomy", "concept")
    )
    entries = fact_entries(documents, json_col).withColumn("_s", place)
    entries = entries.where(F.col("_s").isNotNull())
    years = sorted(set(fiscal_years)) if fiscal_years is not None else None
    if years is not None:
        entries = entries.where(F.col("fiscal_year").isin(*years))
    order = F.struct(-F.col("_s.rank"), *_recency(prefer_latest_period))
    chosen = F.max_by(F.struct("concept", "raw_value", "unit", "filed_date"), order)
    best = entries.groupBy("cik", "fiscal_year", F.col("_s.primary").alias("primary")).agg(
        chosen.alias("w")
    )
    return best.select(
        "cik",
        "fiscal_year",
        F.col("primary").alias("concept"),
        F.col("w.concept").alias("reported_as"),
        F.col("w.raw_value").try_cast("double").alias("value"),
        F.col("w.unit").alias("unit"),
        F.col("w.filed_date").alias("filed_date"),
    ).where(F.col("value").isNotNull())


def fiscal_year_values(documents: DataFrame, concept: str, json_col: str = "json") -> DataFrame:
    """Value of one concept per (entity, year); an empty value falls through to the next taxonomy."""
    entries = fact_entries(documents, json_col).where(F.col("concept") == concept)
    latest = entries.groupBy("cik", "fiscal_year", "taxonomy").agg(
        F.max_by("raw_value", F.struct(*_recency(False))).alias("raw_value")
    )
    rank = F.array_position(F.array(*[F.lit(t) for t in TAXONOMIES]), F.col("taxonomy"))
    first = F.min_by("raw_value", F.when(F.col("raw_value").isNotNull(), rank))
    return (
        latest.groupBy("cik", "fiscal_year")
        .agg(first.alias("raw_value"))
        .select("cik", "fiscal_year", F.col("raw_value").try_cast("double").alias("value"))
    )


def ticker_map(documents: DataFrame, json_col: str = "json") -> DataFrame:
    """Ticker document (object of objects) to ``cik, ticker, name`` rows, sorted by key.

    The key is padded, so that it joins with every other table.
    """
    schema = "map<string, struct<cik_str:string, ticker:string, title:string>>"
    entries = documents.select(
        F.inline(F.map_values(F.from_json(F.col(json_col), schema))).alias(
            "cik_str", "ticker", "name"
        )
    )
    return entries.select(I.pad_cik(F.col("cik_str")).alias("cik"), "ticker", "name").orderBy(
        "cik", "ticker"
    )


def with_fallback(primary: DataFrame, fallback: DataFrame, key: str = "cik") -> DataFrame:
    """Rows of ``primary`` plus the rows of ``fallback`` whose key it lacks."""
    return primary.unionByName(fallback.join(primary.select(key).distinct(), key, "left_anti"))
