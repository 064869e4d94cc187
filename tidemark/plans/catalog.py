"""Every registered query: a function of (spark, sf_dir) over whole tables.

``QUERIES`` maps the query name to its function; the comment above each group names the
inventory ids it covers. Floating-point results are rounded so that they can be compared with
another engine's results.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import identifiers as I
from tidemark.functions import scoring as N
from tidemark.functions import text as X
from tidemark.functions import vectors as V
from tidemark.operators import changes as C
from tidemark.operators import chunking as K
from tidemark.operators import clustering as L
from tidemark.operators import drift as D
from tidemark.operators import embedding as E
from tidemark.operators import explanations as P
from tidemark.operators import filings as J
from tidemark.operators import gold as G
from tidemark.operators import intensity as T
from tidemark.operators import labels as B
from tidemark.operators import neighbours as M
from tidemark.operators import sections as H
from tidemark.operators import tracker as R
from tidemark.operators.density import density_components
from tidemark import schemas as S
from tidemark.plans import reports as O
from tidemark.plans import sql_console as Q
from tidemark.plans.drift_plan import DriftResult, drift_plan
from tidemark.session import cut_lineage, shared_folder
from tidemark.sources import corpus as A

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DIGITS = 6
EMERGING_YEAR = 1998
ONE_COMPANY = "0000000007"
FACT_YEARS = list(range(1995, 2002))


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.round(F.col(f"`{c}`").cast("double"), digits) for c in doubles})


def components(df: DataFrame, column: str) -> DataFrame:
    """One row per vector component."""
    keys = [F.col(c) for c in df.columns if c != column]
    return rounded(df.select(*keys, F.posexplode(column).alias("dim", "value")))


# Shared sub-plans ---------------------------------------------------------------------------


def region_intensity(spark: SparkSession, sf: str) -> DataFrame:
    return T.compute_intensity(A.region_chunks(spark, sf), A.theme_labels(spark))


def account_intensity(spark: SparkSession, sf: str) -> DataFrame:
    return T.compute_intensity(A.account_chunks(spark, sf), A.theme_labels(spark))


def region_changes(spark: SparkSession, sf: str) -> DataFrame:
    return C.compute_yoy_changes(region_intensity(spark, sf))


def account_changes(spark: SparkSession, sf: str) -> DataFrame:
    return C.compute_yoy_changes(account_intensity(spark, sf))


def account_drift(spark: SparkSession, sf: str) -> DataFrame:
    return D.drift_of_members(T.drop_noise(A.account_chunks(spark, sf)), A.LINE_DIMENSION)


def region_result(spark: SparkSession, sf: str) -> DriftResult:
    chunks = A.region_chunks(spark, sf)
    return drift_plan(chunks, A.theme_labels(spark), dimension=A.LINE_DIMENSION)


def account_result(spark: SparkSession, sf: str) -> DriftResult:
    chunks = A.account_chunks(spark, sf)
    return drift_plan(chunks, A.theme_labels(spark), dimension=A.LINE_DIMENSION)


def themes(spark: SparkSession) -> DataFrame:
    return A.theme_labels(spark).withColumnRenamed("label", "cluster_label")


def _star(found: DriftResult, metadata: DataFrame, labels: DataFrame) -> dict[str, DataFrame]:
    """Gold tables of a corpus from one pass over its chunks."""
    return {
        "companies": G.companies_table(metadata.select("cik"), metadata, found.intensity),
        "themes": G.themes_table(labels, found.intensity),
        "theme_intensity": G.theme_intensity_table(found.intensity),
        "theme_changes": G.theme_changes_table(found.changes, found.centroid_drift),
    }


def region_star(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    metadata = A.nation_companies(spark, sf)
    return _star(region_result(spark, sf), metadata, A.theme_labels(spark))


def account_star(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    metadata = A.customer_companies(spark, sf)
    return _star(account_result(spark, sf), metadata, A.theme_labels(spark))


def region_feed(spark: SparkSession, sf: str) -> DataFrame:
    star = region_star(spark, sf)
    return O.change_feed(star["theme_changes"], star["themes"], star["companies"])


def text_ranked(spark: SparkSession, sf: str) -> DataFrame:
    return drift_plan(A.text_chunks(spark, sf), A.theme_labels(spark)).ranked


def text_explanations(spark: SparkSession, sf: str) -> DataFrame:
    return P.build_explanations(
        text_ranked(spark, sf), A.text_chunks(spark, sf), A.theme_labels(spark)
    )


def text_quality(spark: SparkSession, sf: str) -> DataFrame:
    return G.data_quality_table(
        A.extraction_outcomes(spark, sf), G.noise_by_year(A.text_chunks(spark, sf))
    )


# Intensity: AGG-1, AGG-2, AGG-3, JOIN-1, JOIN-2, FLT-1, SRT-1, SET-7, SCL-9 ------------------


@query
def intensity(spark, sf):
    return rounded(T.sorted_intensity(region_intensity(spark, sf)))


@query
def intensity_accounts(spark, sf):
    return rounded(account_intensity(spark, sf))


@query
def intensity_events(spark, sf):
    return rounded(T.compute_intensity(A.event_chunks(spark, sf)))


@query
def intensity_ratio(spark, sf):
    returned = F.count_if(F.col("l_returnflag") == "R").alias("n_returned")
    counts = (
        A.table(spark, sf, "lineitem")
        .groupBy("l_suppkey")
        .agg(returned, F.count(F.lit(1)).alias("n_lines"))
    )
    return rounded(
        counts.select("*", N.safe_ratio(F.col("n_returned"), F.col("n_lines")).alias("ratio"))
    )


@query
def presence_matrix(spark, sf):
    # Every entity with every year that occurs, so that gaps are columns too.
    found = cut_lineage(region_intensity(spark, sf))
    keys = found.agg(F.array_sort(F.collect_set("cik")), F.array_sort(F.collect_set("fiscal_year"))).first()
    return rounded(T.presence_matrix(found, [f"{cik}_{year}" for cik in keys[0] for year in keys[1]]))


@query
def presence_long(spark, sf):
    return rounded(T.presence_long(account_intensity(spark, sf)))


# Changes: WIN-1, WIN-5, SRT-2, SRT-3, JOIN-3, SCL-3, SCL-4, SCL-10, FLT-9 --------------------


@query
def yoy_changes(spark, sf):
    return rounded(region_changes(spark, sf))


@query
def yoy_changes_accounts(spark, sf):
    return rounded(account_changes(spark, sf))


@query
def yoy_from_counts(spark, sf):
    counts = region_intensity(spark, sf).select(
        "cik", "cluster_id", F.col("fiscal_year").alias("year"), "chunk_count", "total_chunks"
    )
    return rounded(C.compute_yoy_changes(counts))


@query
def yoy_with_zero_rows(spark, sf):
    return rounded(C.compute_yoy_changes(T.densify_disappearances(account_intensity(spark, sf))))


@query
def change_scores(spark, sf):
    """Materiality and change type as plain column functions over order values."""
    orders = A.table(spark, sf, "orders")
    previous = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") / 500000.0)
    current = F.when(F.col("o_orderpriority") != "5-LOW", (F.col("o_orderkey") % 11) / 11.0)
    delta = F.coalesce(current, F.lit(0.0)) - F.coalesce(previous, F.lit(0.0))
    return rounded(
        orders.select(
            "o_orderkey",
            N.change_type(previous, current, delta).alias("change_type"),
            N.materiality(delta, F.col("o_custkey")).alias("materiality_score"),
            N.approximate_intensity(delta, 1).alias("approximate_current"),
            N.approximate_intensity(delta, -1).alias("approximate_previous"),
        ),
        digits=9,  # prices in cents, divided and halved, end at the eighth decimal
    )


@query
def ranked_changes(spark, sf):
    found = region_result(spark, sf)
    ranked = C.rank_changes(found.changes, found.centroid_drift)
    return rounded(
        ranked.select(
            "rank", "cik", "cluster_id", "fiscal_year", "materiality_score", "centroid_drift"
        )
    )


@query
def ranked_changes_accounts(spark, sf):
    ranked = C.rank_changes(account_changes(spark, sf))
    return rounded(
        ranked.select("rank", "cik", "cluster_id", "fiscal_year", "materiality_score", "change_type")
    )


@query
def top_changes(spark, sf):
    return rounded(
        account_result(spark, sf).ranked.select(
            "rank", "cik", "cluster_id", "fiscal_year", "intensity_delta", "materiality_score",
            "change_type", "centroid_drift",
        )
    )


@query
def changes_with_drift(spark, sf):
    found = account_result(spark, sf)
    return rounded(C.attach_drift(found.changes, found.centroid_drift))


# Tracker: FLT-2, FLT-3, FLT-4, AGG-4, AGG-5, AGG-6, JOIN-7, JOIN-8, WIN-4, WIN-10, SET-3 -----


@query
def company_timeline(spark, sf):
    return rounded(R.company_timeline(region_intensity(spark, sf), ONE_COMPANY))


@query
def theme_trajectory(spark, sf):
    return rounded(R.theme_trajectory(account_intensity(spark, sf), 3))


@query
def emerging_themes(spark, sf):
    found = account_intensity(spark, sf)
    return rounded(R.emerging_themes(found, C.compute_yoy_changes(found), EMERGING_YEAR))


@query
def fading_themes(spark, sf):
    return rounded(R.fading_themes(account_changes(spark, sf), themes(spark), EMERGING_YEAR))


@query
def theme_prevalence(spark, sf):
    return rounded(R.theme_prevalence(account_intensity(spark, sf), themes(spark)))


@query
def corpus_stats(spark, sf):
    found = account_intensity(spark, sf)
    stats = R.corpus_stats(found, C.compute_yoy_changes(found))
    by_type = {
        f"n_{kind}": F.coalesce(
            F.try_element_at("change_type_counts", F.lit(kind)), F.lit(0).cast("long")
        )
        for kind in N.CHANGE_TYPES
    }
    return stats.withColumns(by_type).drop("change_type_counts")


@query
def change_type_histogram(spark, sf):
    return R.change_type_histogram(account_changes(spark, sf))


# Vectors: AGG-10..13, AGG-19, JOIN-9..12, SET-2, SET-5, SET-8, WIN-2, WIN-3, SCL-5..8, ML-* --


@query
def cluster_centroids(spark, sf):
    return components(L.cluster_centroids(A.vector_chunks(spark, sf)), "centroid")


@query
def missing_cluster_centroid(spark, sf):
    chunks = A.vector_chunks(spark, sf)
    size = V.vector_dimension(chunks, "embedding")
    present = L.compute_centroid(chunks, 3, size)
    return components(present.unionByName(L.compute_centroid(chunks, 99, size)), "centroid")


@query
def cluster_stats(spark, sf):
    stats = L.cluster_stats(A.vector_chunks(spark, sf), digits=4)
    return stats.withColumn("n_sizes", F.size("cluster_sizes")).drop("cluster_sizes")


@query
def cluster_sizes(spark, sf):
    return L.cluster_sizes(A.region_chunks(spark, sf))


@query
def unit_vectors(spark, sf):
    scaled = A.table(spark, sf, "embeddings").select(
        "vec_id", V.scale(F.col("embedding"), F.col("vec_id") % 5).alias("v")
    )
    return components(
        scaled.select("vec_id", V.l2_normalize(F.col("v")).alias("unit")), "unit"
    )


@query
def centroid_drift(spark, sf):
    chunks = A.vector_chunks(spark, sf)
    embeddings = chunks.select("chunk_id", "embedding")
    return D.compute_centroid_drift(chunks.drop("embedding"), embeddings, exclude_noise=True)


@query
def centroid_drift_accounts(spark, sf):
    return account_drift(spark, sf)


@query
def distribution_drift(spark, sf):
    chunks = A.vector_chunks(spark, sf)
    embeddings = chunks.select("chunk_id", "embedding")
    return D.compute_distribution_drift(chunks.drop("embedding"), embeddings, exclude_noise=True)


@query
def novel_outliers(spark, sf):
    return L.novel_outliers(
        A.text_vectors(spark, sf), dimension=A.embedding_dimension(spark, sf)
    )


@query
def representative_chunks(spark, sf):
    chunks = A.vector_chunks(spark, sf)
    return B.representative_chunks(
        chunks, chunks.select("chunk_id", "embedding"), L.cluster_centroids(chunks)
    )


def _store(spark: SparkSession, sf: str) -> DataFrame:
    """A store in which only documents with an embedding row of their number have a vector."""
    texts = A.documents(spark, sf).select(F.col("doc_id").alias("vec_id"), "text")
    return A.table(spark, sf, "embeddings").join(texts, "vec_id").select(
        F.col("vec_id").cast("string").alias("chunk_id"),
        E.content_key(F.col("text"), E.HASHING_MODEL).alias("content_key"),
        "embedding",
    )


@query
def missing_embeddings(spark, sf):
    missing = E.missing_embeddings(A.text_chunks(spark, sf), _store(spark, sf))
    return missing.select("chunk_id", "content_key")


@query
def merged_embedding_store(spark, sf):
    store = _store(spark, sf)
    missing = E.missing_embeddings(A.text_chunks(spark, sf), store)
    merged = store.select("chunk_id", F.lit("stored").alias("origin")).unionByName(
        missing.select("chunk_id", F.lit("new").alias("origin"))
    )
    return A.text_chunks(spark, sf).select("chunk_id", "cik").join(merged, "chunk_id")


def _shared_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as chunks whose ids repeat: one id per source and year."""
    name = F.concat_ws("_", "cik", F.col("fiscal_year").cast("string"))
    return A.text_chunks(spark, sf).withColumn("chunk_id", name)


@query
def duplicate_chunk_ids(spark, sf):
    return K.duplicate_chunk_ids(_shared_ids(spark, sf))


@query
def stored_vectors(spark, sf):
    """Vectors per chunk and per text out of a store, for chunks with repeated ids."""
    chunks = _shared_ids(spark, sf).select("accession_number", "chunk_id", "text")
    store = E.EmbeddingStore(spark, f"{shared_folder(spark)}/tidemark-store-{uuid.uuid4().hex}")
    vectors = cut_lineage(store.get_or_compute(chunks, lambda df: E.hashing_embeddings(df, dimension=64)))
    own = vectors.groupBy("accession_number", "chunk_id").agg(F.count(F.lit(1)).alias("n_vectors"))
    keys = chunks.select("accession_number", "chunk_id", F.sha2("text", 256).alias("text_sha256"))
    texts = (
        keys.join(vectors, ["accession_number", "chunk_id"])
        .groupBy("text_sha256").agg(F.countDistinct("embedding").alias("n_vectors_of_text"))
    )
    return keys.join(own, ["accession_number", "chunk_id"]).join(texts, "text_sha256")


@query
def text_embeddings(spark, sf):
    return components(
        E.hashing_embeddings(A.text_chunks(spark, sf), dimension=64).select("chunk_id", "embedding"),
        "embedding",
    )


#: Reach and neighbours of the fixed cut of the density tree, for the leading 12 of 64 dimensions.
DENSITY_REACH, DENSITY_SAMPLES = 0.3, 5


NEIGHBOURS = 15


def _placed_vectors(spark, sf):
    rows = A.table(spark, sf, "embeddings").filter("embedding IS NOT NULL")
    vectors = rows.select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"), F.lit(1).cast("long").alias("weight")
    )
    return M.dealt_to_cells(vectors, A.embedding_dimension(spark, sf))


def _neighbour_rows(lists):
    rows = lists.select("id", F.posexplode("near").alias("place", "x"))
    return rows.select(
        F.col("id").alias("vec_id"), (F.col("place") + 1).alias("place"), F.col("x.n").alias("neighbour"),
        F.round("x.d", 6).alias("distance"),
    )


@query
def nearest_vectors(spark, sf):
    placed, cells = _placed_vectors(spark, sf)
    asked = placed.filter(F.col("id") % 20 == 0)
    return _neighbour_rows(M.nearest_neighbours(placed, cells, NEIGHBOURS, asked))


@query
def neighbour_graph(spark, sf):
    placed, _ = _placed_vectors(spark, sf)
    return _neighbour_rows(M.neighbour_graph(placed, NEIGHBOURS)[0])


@query
def density_themes(spark, sf):
    points = A.vector_chunks(spark, sf).select("chunk_id", "embedding")
    return L.ThemeClusterer().fit_predict(points).select("chunk_id", "cluster_id")


@query
def density_clusters(spark, sf):
    leading = F.slice("embedding", 1, L.REDUCED_DIMENSION).cast("array<double>")
    points = A.vector_chunks(spark, sf).select("chunk_id", leading.alias("v"))
    cut = density_components(points, "v", DENSITY_REACH, DENSITY_SAMPLES)
    names = cut.filter("is_core").groupBy("component").agg(F.min("chunk_id").alias("name"))
    return cut.join(names, "component", "left").select("chunk_id", "is_core", F.col("name").alias("component"))


@query
def theme_clusters(spark, sf):
    points = A.vector_chunks(spark, sf).select("chunk_id", "embedding")
    return L.ThemeClusterer(k=9).fit_predict(points).select("chunk_id", "cluster_id")


# Text: TXT-1..16, AGG-14, SET-4, WIN-9, JOIN-19 ----------------------------------------------


@query
def normalized_whitespace(spark, sf):
    spaced = F.replace(
        F.replace(F.col("text"), F.lit(", "), F.lit(",\t  ")), F.lit("\n"), F.lit("\n \t\n\n")
    )
    return A.documents(spark, sf).select("doc_id", X.normalize_whitespace(spaced).alias("text"))


@query
def dehyphenated_text(spark, sf):
    broken = F.replace(F.col("text"), F.lit("e "), F.lit("e-\n"))
    return A.documents(spark, sf).select("doc_id", X.dehyphenate(broken).alias("text"))


def _with_page_lines(text: Column) -> Column:
    return F.concat(
        F.lit("1\n"),
        F.replace(text, F.lit("\n"), F.lit("\n - 12 - \nPage 3 OF 9\n2024 annual\n\t7\npage 4\n")),
        F.lit("\n- 5 -\n"),
    )


@query
def page_lines_removed(spark, sf):
    paged = _with_page_lines(F.col("text"))
    return A.documents(spark, sf).select("doc_id", X.remove_page_lines(paged).alias("text"))


@query
def cleaned_text(spark, sf):
    raw = F.concat(_with_page_lines(F.col("text")), F.lit("\u0007 end-\nline  ①"))
    return A.documents(spark, sf).select("doc_id", X.clean_text(raw).alias("text"))


@query
def prose_flags(spark, sf):
    text = F.col("text")
    return A.documents(spark, sf).select(
        "doc_id",
        X.word_count(text).cast("long").alias("n_words"),
        X.token_estimate(text).cast("long").alias("n_tokens"),
        X.marker_overlap(text).cast("long").alias("n_markers"),
        X.is_prose(text).alias("is_prose"),
    )


@query
def prose_turns(spark, sf):
    turns = A.table(spark, sf, "conversations").where(X.is_prose(F.col("text")))
    return turns.groupBy("role").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.sum(X.token_estimate(F.col("text"))).alias("n_tokens"),
    )


@query
def sentences(spark, sf):
    return A.documents(spark, sf).select(
        "doc_id", F.posexplode(X.sentences(F.col("text"))).alias("pos", "sentence")
    )


@query
def paragraphs(spark, sf):
    listed = F.replace(
        F.replace(F.col("text"), F.lit(". "), F.lit(".\n- ")), F.lit("\n"), F.lit("\n2) \n \n")
    )
    return A.documents(spark, sf).select(
        "doc_id", F.posexplode(X.paragraphs(listed)).alias("pos", "paragraph")
    )


@query
def chunks(spark, sf):
    return K.chunk_sections(A.document_sections(spark, sf))


@query
def keyword_labels(spark, sf):
    return B.keyword_labels(T.drop_noise(A.text_chunks(spark, sf)))


@query
def clean_labels(spark, sf):
    raw = F.concat(
        F.lit(" \"'"), F.col("p_name"), F.lit("  of\tthe u.s. "), F.col("p_brand"),
        F.lit("'s "), F.col("p_type"), F.lit(" line.'\" "),
    )
    return A.table(spark, sf, "part").select("p_partkey", X.clean_label(raw).alias("label"))


def _representatives(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    chunks = A.text_vectors(spark, sf)
    members = chunks.select("chunk_id", "cluster_id")
    vectors = chunks.select("chunk_id", "embedding")
    centroids = L.cluster_centroids(chunks, A.embedding_dimension(spark, sf))
    return B.representative_chunks(members, vectors, centroids), chunks


@query
def label_prompts(spark, sf):
    return B.label_prompts(*_representatives(spark, sf))


@query
def theme_label_choice(spark, sf):
    representatives, chunks = _representatives(spark, sf)
    every = chunks.select("cluster_id").unionByName(A.manual_labels(spark).select("cluster_id"))
    return B.label_themes(every, representatives, chunks, A.manual_labels(spark))


# Sections, pages: TXT-9, SRC-13 --------------------------------------------------------------


@query
def extracted_sections(spark, sf):
    return H.extract_sections(A.document_filings(spark, sf)).drop("html")


@query
def extraction_failures(spark, sf):
    pages = A.pages(spark, sf).select("page_id", "html")
    return (
        H.extract_sections(pages)
        .groupBy("extraction_method", "failure_reason", "success")
        .agg(F.count(F.lit(1)).alias("n_pages"))
    )


@query
def page_text(spark, sf):
    return A.pages(spark, sf).select("page_id", H.page_text(F.col("html")).alias("text"))


# Identifiers and JSON: SCL-1, SCL-2, SCL-13, SCL-15..17, SCL-21, WIN-7, SRC-4, SRC-9, SRC-10 -


@query
def padded_ids(spark, sf):
    key = F.col("c_custkey")
    return A.table(spark, sf, "customer").select(
        "c_custkey",
        I.zero_fill(key).alias("filled"),
        I.pad_cik(F.concat(F.lit(" 000"), key.cast("string"), F.lit(" "))).alias("padded"),
        I.pad_numeric_cik(F.col("c_name")).alias("not_numeric"),
        I.zero_fill(F.concat(F.lit("12345678901"), key.cast("string"))).alias("long_key"),
    )


@query
def accession_numbers(spark, sf):
    bare = F.concat(F.lpad(F.col("o_orderkey").cast("string"), 10, "0"), F.lit("24000123"))
    dashed = I.add_dashes(bare)
    return A.table(spark, sf, "orders").select(
        "o_orderkey",
        dashed.alias("dashed"),
        I.strip_dashes(dashed).alias("bare"),
        I.add_dashes(F.col("o_orderpriority")).alias("other_length"),
        I.bronze_path("bronze", F.col("o_custkey"), dashed, F.lit("index.json")).alias("path"),
    )


_FILING_COLUMNS = (
    "cik", "accession_number", "form", "filing_date", "report_date", "primary_document",
    "fiscal_year",
)


@query
def annual_filings(spark, sf):
    documents = A.order_submissions(spark, sf)
    return J.annual_filings(documents, years=[1996, 1997, 1998]).select(*_FILING_COLUMNS)


@query
def recent_annual_filings(spark, sf):
    documents = A.order_submissions(spark, sf)
    as_of = F.to_date(F.lit("2002-01-01"))
    return J.recent_annual_filings(documents, as_of=as_of).select(*_FILING_COLUMNS)


@query
def standard_facts(spark, sf):
    return rounded(J.standard_facts(A.order_facts(spark, sf), FACT_YEARS))


@query
def fiscal_year_values(spark, sf):
    return rounded(J.fiscal_year_values(A.order_facts(spark, sf), "Liabilities"))


@query
def ticker_map(spark, sf):
    entry = F.struct(
        F.col("s_suppkey").alias("cik_str"),
        F.concat(F.lit("S"), F.col("s_nationkey").cast("string")).alias("ticker"),
        F.col("s_name").alias("title"),
    )
    documents = A.table(spark, sf, "supplier").select(
        F.to_json(F.create_map(F.col("s_suppkey").cast("string"), entry)).alias("json")
    )
    return J.ticker_map(documents)


# Evidence and explanations: WIN-6, JOIN-18, JOIN-21, TXT-17..23, SRT-5 -----------------------


@query
def first_evidence(spark, sf):
    return P.first_evidence(A.text_chunks(spark, sf)).select(
        "cik", "cluster_id", "fiscal_year", "place", "chunk_id", "text"
    )


@query
def change_evidence(spark, sf):
    changes = C.compute_yoy_changes(T.compute_intensity(A.text_chunks(spark, sf)))
    found = P.attach_evidence(changes, A.text_chunks(spark, sf))
    return found.select(
        "cik", "cluster_id", "fiscal_year",
        F.array_join("evidence_current.chunk_id", ",").alias("current_ids"),
        F.array_join("evidence_previous.chunk_id", ",").alias("previous_ids"),
    )


@query
def explanations(spark, sf):
    return text_explanations(spark, sf).select(
        "rank", "change_id", "cik", "cluster_id", "fiscal_year", "explanation_text",
        F.array_join("evidence_chunk_ids", ",").alias("evidence_ids"), "model_used",
    )


@query
def drift_explanations(spark, sf):
    """Template texts of all drifting regions, with measured drift."""
    found = region_result(spark, sf)
    changes = C.attach_drift(found.changes, found.centroid_drift)
    named = T.attach_labels(changes, A.theme_labels(spark))
    return named.select(
        I.change_id(F.col("cik"), F.col("cluster_id"), F.col("fiscal_year")).alias("change_id"),
        P.template_text(named, F.col("cluster_label")).alias("explanation_text"),
    )


@query
def explanation_prompts(spark, sf):
    found = P.attach_evidence(text_ranked(spark, sf), A.text_chunks(spark, sf))
    label = F.concat(F.lit("theme "), F.col("cluster_id").cast("string"))
    return found.select("rank", P.explanation_prompt(found, label).alias("prompt"))


def _text_feed(spark: SparkSession, sf: str) -> DataFrame:
    named = A.theme_labels(spark)
    changes = C.compute_yoy_changes(T.compute_intensity(A.text_chunks(spark, sf), named))
    return changes.join(named, "cluster_id", "left").withColumn(
        "ticker", F.concat(F.lit("S"), F.col("cik").cast("int").cast("string"))
    )


@query
def before_and_after(spark, sf):
    return O.before_and_after(
        _text_feed(spark, sf), A.text_chunks(spark, sf), text_explanations(spark, sf)
    )


@query
def first_explanation(spark, sf):
    told = O.first_explanation(_text_feed(spark, sf), text_explanations(spark, sf))
    return told.select("cik", "cluster_id", "fiscal_year", "change_type", "explanation_text")


# Gold: GLD-1..8, JOIN-4..6, JOIN-13, AGG-7..9, AGG-20, FLT-10..12, SCL-20, SET-3 -------------


@query
def gold_companies(spark, sf):
    ciks = A.customer_companies(spark, sf).select(F.col("cik").cast("long").cast("string").alias("cik"))
    # Entities of one sector come without metadata.
    known = {c: F.when(F.col("sector") != "MACHINERY", F.col(c)) for c in ("ticker", "name", "sector")}
    metadata = A.customer_companies(spark, sf).withColumns(known)
    return G.companies_table(ciks, metadata, account_intensity(spark, sf))


@query
def gold_themes(spark, sf):
    return G.themes_table(
        A.theme_labels(spark), account_intensity(spark, sf), A.manual_labels(spark)
    )


@query
def gold_theme_intensity(spark, sf):
    shifted = region_intensity(spark, sf).withColumns(
        {
            "intensity": F.col("intensity") * 12.0 - 0.5,
            "chunk_count": F.nullif("chunk_count", F.lit(30)),
        }
    )
    return rounded(G.theme_intensity_table(shifted))


@query
def gold_theme_changes(spark, sf):
    found = account_result(spark, sf)
    odd = found.changes.withColumn(
        "change_type",
        F.when(F.col("change_type") == "fading", F.lit("shrinking")).otherwise(F.col("change_type")),
    )
    return rounded(G.theme_changes_table(odd, found.centroid_drift))


@query
def gold_explanations(spark, sf):
    told = text_explanations(spark, sf).withColumn(
        "evidence_chunk_ids",
        F.when(F.col("cluster_id") != 2, F.col("evidence_chunk_ids")),
    )
    return G.explanations_table(told).select(
        "change_id", "cik", "cluster_id", "fiscal_year", "explanation_text", "model_used",
        F.array_join("evidence_chunk_ids", ",").alias("evidence_ids"),
        F.size("evidence_chunk_ids").cast("long").alias("n_evidence"),
    )


@query
def gold_evidence_chunks(spark, sf):
    referenced = G.referenced_chunk_ids(text_explanations(spark, sf))
    return G.evidence_chunks_table(A.text_chunks(spark, sf), referenced)


@query
def gold_data_quality(spark, sf):
    return rounded(text_quality(spark, sf))


@query
def gold_violations(spark, sf):
    raw = A.table(spark, sf, "lineitem").select(
        I.zero_fill(F.col("l_suppkey")).alias("cik"),
        F.col("l_linenumber").alias("cluster_id"),
        F.when(F.col("l_tax") > 0.0, F.year("l_shipdate")).alias("fiscal_year"),
        (F.col("l_discount") - 0.05).alias("intensity_delta"),
        F.lit(None).cast("double").alias("centroid_drift"),
        (F.col("l_quantity") - 10.0).alias("materiality_score"),
        F.when(F.col("l_returnflag") == "R", F.lit("NEW")).otherwise(F.lit("new")).alias("change_type"),
    )
    return S.violations(raw, S.THEME_CHANGES)


# Reports: JOIN-14..17, JOIN-20, AGG-15..18, FLT-5..8, FLT-16, SRT-6..8, SET-6, SCL-11..12, API


@query
def change_feed(spark, sf):
    return rounded(region_feed(spark, sf))


@query
def filtered_feed(spark, sf):
    return rounded(
        O.filter_feed(region_feed(spark, sf), search="Fo", sector="ASIA", change_type="fading")
    )


@query
def feed_by_year(spark, sf):
    found = O.filter_feed(region_feed(spark, sf), search="n1", year=1999)
    return rounded(O.sort_feed(found, "delta"))


@query
def event_list(spark, sf):
    return rounded(O.display_columns(O.event_list(region_feed(spark, sf), "centroid")))


@query
def facet_values(spark, sf):
    feed = region_feed(spark, sf)
    sectors = O.facet_values(feed, "sector").select(
        F.lit("sector").alias("facet"), F.col("sector").alias("value")
    )
    kinds = O.facet_values(feed, "change_type").select(
        F.lit("change_type").alias("facet"), F.col("change_type").alias("value")
    )
    return sectors.unionByName(kinds)


@query
def company_profile(spark, sf):
    star = region_star(spark, sf)
    return rounded(O.company_profile(star["theme_intensity"], star["themes"], ONE_COMPANY))


@query
def company_changes(spark, sf):
    star = region_star(spark, sf)
    return rounded(O.company_changes(star["theme_changes"], star["themes"], ONE_COMPANY))


@query
def company_timeline_cards(spark, sf):
    star = region_star(spark, sf)
    return rounded(
        O.company_timeline_cards(
            star["theme_intensity"], star["theme_changes"], star["themes"], ONE_COMPANY
        )
    )


@query
def headline_figures(spark, sf):
    star = region_star(spark, sf)
    return rounded(
        O.headline_figures(star["companies"], star["themes"], text_quality(spark, sf))
    )


@query
def quality_range(spark, sf):
    return rounded(O.quality_range(text_quality(spark, sf), 2017, 2021))


@query
def chunk_yield(spark, sf):
    return O.chunk_yield(O.quality_range(text_quality(spark, sf), 2016, 2023))


@query
def sector_summary(spark, sf):
    star = account_star(spark, sf)
    known = star["companies"].withColumn(
        "sector", F.when(F.col("sector") != "BUILDING", F.col("sector"))
    )
    return rounded(O.sector_summary(star["theme_intensity"], known))


@query
def review_list(spark, sf):
    return O.review_list(region_star(spark, sf)["themes"])


@query
def theme_network(spark, sf):
    star = region_star(spark, sf)
    return rounded(O.theme_network(star["theme_changes"], star["themes"], star["companies"]))


@query
def node_neighbours(spark, sf):
    star = region_star(spark, sf)
    edges = O.theme_network(star["theme_changes"], star["themes"], star["companies"])
    both = O.node_neighbours(edges, "t4").unionByName(O.node_neighbours(edges, ONE_COMPANY))
    return both.select("from_node", "to_node", "neighbour", "change_type", "fiscal_year")


def _preset(name: str, star: Callable[[SparkSession, str], dict[str, DataFrame]]) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        tables = star(spark, sf)
        Q.register_frames(
            **{t: tables[t] for t in ("companies", "themes", "theme_changes")}
        )
        return rounded(Q.run_preset(spark, name))

    return run


QUERIES["preset_top_drift"] = _preset("top-drift", region_star)
QUERIES["preset_emerging_ai"] = _preset("emerging-ai", account_star)
QUERIES["preset_centroid_divergence"] = _preset("centroid-divergence", account_star)
QUERIES["preset_sector_distribution"] = _preset("sector-distribution", account_star)
