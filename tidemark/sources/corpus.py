"""Adapters from the supplied star-schema tables to the chunk model.

Each adapter is a lazy projection or join over whole tables; which columns are read is decided
by what the caller uses.

* ``region_chunks``   line items, entity = nation of the customer (few entities, dense)
* ``account_chunks``  line items, entity = customer (many entities, gaps between versions)
* ``vector_chunks``   the embeddings table
* ``text_chunks``     the documents table
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import identifiers as I
from tidemark.functions.vectors import vector_dimension

THEME_COUNT = 12
LINE_DIMENSION = 4
# Labels for the first themes; the others stay unlabelled on purpose.
THEME_NAMES = {
    0: "AI Tooling",
    1: "Foundry Supply",
    2: "Packaging Costs",
    3: "Data Privacy",
    4: "Export Rules",
    5: "Climate Reporting",
    6: "Credit Conditions",
    7: "Software Outage",
}
MANUAL_LABELS = {1: "Foundry Supply (Reviewed)", 9: "Labour Market"}
# Order of the event types; the position is the theme.
EVENT_THEMES = ("click", "error", "purchase", "signup", "view")


# Declared schemas: no job has to open files to infer them.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(table_path(sf_dir, name))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def _theme(size: Column) -> Column:
    """Theme -1 (noise) to 10 from the part size."""
    return (F.pmod(size, F.lit(THEME_COUNT)) - 1).cast("int")


def _line_vector() -> Column:
    """Four centred figures of a line item as its vector."""
    return F.array(
        (F.col("l_quantity") - 25.0) / 25.0,
        (F.col("l_extendedprice") - 37500.0) / 37500.0,
        (F.col("l_discount") - 0.05) * 20.0,
        (F.col("l_tax") - 0.04) * 25.0,
    )


def _line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        "o_custkey",
        F.year("o_orderdate").alias("fiscal_year"),
    )
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), _theme(F.col("p_size")).alias("cluster_id")
    )
    return lines(spark, sf_dir).join(dated, "l_orderkey").join(parts, "l_partkey")


def _line_columns(cik: Column) -> list[Column]:
    ids = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return [
        F.concat_ws("-", *[F.col(c).cast("string") for c in ids]).alias("chunk_id"),
        I.zero_fill(cik).alias("cik"),
        F.col("fiscal_year"),
        F.col("l_orderkey").cast("string").alias("accession_number"),
        F.lit("item_1a").alias("section"),
        F.col("l_linenumber").alias("chunk_index"),
        F.col("cluster_id"),
        _line_vector().alias("embedding"),
    ]


def region_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey"
    )
    joined = _line_chunks(spark, sf_dir).join(customers, "o_custkey")
    return joined.select(*_line_columns(F.col("c_nationkey")))


def account_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_chunks(spark, sf_dir).select(*_line_columns(F.col("o_custkey")))


def vector_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedding rows as chunks; four entities, three versions, label 0 is the noise bucket."""
    key = F.col("vec_id")
    return table(spark, sf_dir, "embeddings").select(
        key.cast("string").alias("chunk_id"),
        I.zero_fill(F.pmod(key, F.lit(4))).alias("cik"),
        (F.lit(2020) + F.pmod(F.floor(key / 4), F.lit(3))).cast("int").alias("fiscal_year"),
        key.cast("string").alias("accession_number"),
        (F.col("label") - 1).alias("cluster_id"),
        "embedding",
    )


def text_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as chunks; the source is the entity, the length decides the theme."""
    key = F.col("doc_id")
    return documents(spark, sf_dir).select(
        key.cast("string").alias("chunk_id"),
        I.zero_fill(F.regexp_extract("source", r"(\d+)", 1)).alias("cik"),
        (F.lit(2016) + F.pmod(key, F.lit(8))).cast("int").alias("fiscal_year"),
        key.cast("string").alias("accession_number"),
        F.lit("item_1a").alias("section"),
        key.alias("chunk_index"),
        (F.pmod(F.col("n_chars"), F.lit(7)) - 1).cast("int").alias("cluster_id"),
        "text",
    )


def document_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as section rows, one filing each; the language is the section name."""
    key = F.col("doc_id")
    return documents(spark, sf_dir).select(
        I.zero_fill(key).alias("cik"),
        (F.lit(2016) + F.pmod(key, F.lit(8))).cast("int").alias("fiscal_year"),
        key.cast("string").alias("accession_number"),
        F.col("lang").alias("section"),
        "text",
    )


def text_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with a vector: that of its number, counted round the embedding rows."""
    vectors = table(spark, sf_dir, "embeddings")
    number = F.pmod(F.col("doc_id"), F.lit(max(1, vectors.count())))
    texts = documents(spark, sf_dir).select("doc_id", number.alias("vec_id"), "text")
    return (
        vectors.join(texts, "vec_id")
        .select(
            F.col("doc_id").cast("string").alias("chunk_id"),
            (F.col("label") - 1).alias("cluster_id"),
            "embedding",
            "text",
        )
    )


def _label_frame(spark: SparkSession, labels: dict[int, str]) -> DataFrame:
    rows = F.array(
        *[F.struct(F.lit(k).alias("cluster_id"), F.lit(v).alias("label")) for k, v in labels.items()]
    )
    return spark.range(1).select(F.inline(rows))


def theme_labels(spark: SparkSession) -> DataFrame:
    return _label_frame(spark, THEME_NAMES)


def manual_labels(spark: SparkSession) -> DataFrame:
    return _label_frame(spark, MANUAL_LABELS)


def embedding_dimension(spark: SparkSession, sf_dir: str) -> int:
    """Vector length, from one row of the stored table."""
    return vector_dimension(table(spark, sf_dir, "embeddings"), "embedding")


def nation_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company metadata of the nation entities; the region is the sector."""
    regions = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("sector")
    )
    return (
        table(spark, sf_dir, "nation")
        .join(regions, "n_regionkey")
        .select(
            I.zero_fill(F.col("n_nationkey")).alias("cik"),
            F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("ticker"),
            F.col("n_name").alias("name"),
            "sector",
        )
    )


def customer_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company metadata of the customer entities; the market segment is the sector."""
    return table(spark, sf_dir, "customer").select(
        I.zero_fill(F.col("c_custkey")).alias("cik"),
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("ticker"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("sector"),
    )


def extraction_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One success flag per judged document, with the year of its text chunk."""
    return table(spark, sf_dir, "labels").select(
        (F.lit(2016) + F.pmod(F.col("doc_id"), F.lit(8))).cast("int").alias("fiscal_year"),
        (F.col("quality") == 1).alias("success"),
    )


def event_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as chunks: user = entity, ISO week = version, event type = theme."""
    kinds = F.array(*[F.lit(k) for k in EVENT_THEMES])
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("chunk_id"),
        I.zero_fill(F.col("user_id")).alias("cik"),
        F.weekofyear("ts").alias("fiscal_year"),
        F.col("event_id").cast("string").alias("accession_number"),
        F.array_position(kinds, F.col("event_type")).cast("int").alias("cluster_id"),
    )


def order_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One submissions document per order: four filings, one of them without a usable date."""
    day = F.to_date("o_orderdate")
    key = F.lpad(F.col("o_orderkey").cast("string"), 10, "0")

    def accession(tail: str) -> Column:
        return F.concat(key, F.lit(f"-24-{tail}"))

    def text(value: Column) -> Column:
        return F.date_format(value, "yyyy-MM-dd")

    first_form = F.when(F.col("o_orderstatus") == "F", F.lit("10-K")).otherwise(F.lit("10-Q"))
    recent = F.struct(
        F.array(*[accession(f"00000{n}") for n in (1, 2, 3, 4)]).alias("accessionNumber"),
        F.array(first_form, F.lit("10-K"), F.lit("10-K/A"), F.lit("10-K/A")).alias("form"),
        F.array(
            text(day), text(F.add_months(day, 12)), text(F.add_months(day, 14)), F.lit("unknown")
        ).alias("filingDate"),
        F.array(*[text(F.date_sub(day, 60))] * 4).alias("reportDate"),
        F.array(*[F.concat(F.col("o_orderpriority"), F.lit(".htm"))] * 4).alias("primaryDocument"),
    )
    document = F.struct(
        F.col("o_custkey").cast("string").alias("cik"),
        F.struct(recent.alias("recent")).alias("filings"),
    )
    return orders(spark, sf_dir).select(F.to_json(document).alias("json"))


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One company-facts document per order: originals, an amendment, a quarter, a text value."""
    year = F.year("o_orderdate")
    price = F.col("o_totalprice")

    def entry(value: Column, fy: Column, filed: str, accn: str, form: str, fp: str) -> Column:
        return F.struct(
            F.concat(fy.cast("string"), F.lit("-12-31")).alias("end"),
            value.cast("string").alias("val"),
            F.lit(accn).alias("accn"),
            fy.alias("fy"),
            F.lit(fp).alias("fp"),
            F.lit(form).alias("form"),
            F.concat(fy.cast("string"), F.lit(filed)).alias("filed"),
        )

    def units(name: str, *entries: Column) -> Column:
        return F.struct(F.create_map(F.lit(name), F.array(*entries)).alias("units"))

    urgent = F.col("o_orderpriority") == "1-URGENT"
    revenue = F.when(urgent, F.lit("Revenues")).otherwise(
        F.lit("RevenueFromContractWithCustomerExcludingAssessedTax")
    )
    open_value = F.when(F.col("o_orderstatus") == "O", F.lit("n/a")).otherwise(
        price.cast("string")
    )
    gaap = F.create_map(
        revenue,
        units(
            "USD",
            entry(price, year, "-02-01", "a-1", "10-K", "FY"),
            entry(price * 2, year, "-06-01", "a-2", "10-K/A", "FY"),
            entry(price * 3, year, "-09-01", "a-3", "10-Q", "Q2"),
            entry(price * 4, year + 1, "-02-01", "b-1", "10-K", "FY"),
        ),
        F.lit("Assets"),
        units("USD", entry(open_value, year, "-02-01", "a-1", "10-K", "FY")),
        F.lit("EarningsPerShareBasic"),
        units("EUR", entry(price, year, "-02-01", "a-1", "10-K", "FY")),
    )
    dei = F.create_map(
        F.lit("Liabilities"),
        units("USD", entry(-price, year, "-02-01", "a-1", "10-K", "FY")),
        F.lit("Assets"),
        units("USD", entry(price * 5, year, "-12-01", "a-9", "10-K", "FY")),
    )
    document = F.struct(
        F.col("o_orderkey").cast("string").alias("cik"),
        F.create_map(F.lit("us-gaap"), gaap, F.lit("dei"), dei).alias("facts"),
    )
    return orders(spark, sf_dir).select(F.to_json(document).alias("json"))


def _escaped(text: Column) -> Column:
    return F.replace(
        F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
        F.lit(">"),
        F.lit("&gt;"),
    )


def document_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents wrapped as filing HTML with a linked contents list, items 1A and 1B.

    English documents carry inline XBRL; French ones lack the item 1A heading.
    """
    head = F.when(F.col("lang") == "en", F.lit("<ix:header>tagged</ix:header>")).otherwise(
        F.lit("")
    )
    heading = F.when(F.col("lang") == "fr", F.lit("<h2>Discussion</h2>")).otherwise(
        F.lit("<h2>Item&nbsp;1A. Risk Factors</h2>")
    )
    html = F.concat(
        F.lit("<html><body>"), head,
        F.lit('<p><a href="#i1a">Item 1A</a><a href="#i1b">Contents</a></p>'),
        F.lit("<header>Item 1A. Risk Factors running head</header>"),
        heading, F.lit("<p>"), _escaped(F.col("text")),
        F.lit("</p><h2>Item 1B. Unresolved Staff Comments</h2><p>None.</p></body></html>"),
    )
    return documents(spark, sf_dir).select("doc_id", "lang", html.alias("html"))
