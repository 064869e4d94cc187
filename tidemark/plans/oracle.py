"""DuckDB SQL that computes every registered query independently on the same tables.

Where the library uses a window, a closed form or a bounded selection, the SQL here takes the
direct way: self joins, all pairs, full rankings.
"""

from __future__ import annotations

import unicodedata

from tidemark.plans.catalog import (
    EMERGING_YEAR,
    FACT_YEARS,
    ONE_COMPANY,
)
from tidemark.sources.corpus import MANUAL_LABELS, THEME_NAMES

SQL: dict[str, str] = {}

# The English list that ships with Spark ML, written out for the other engine.
ENGLISH_STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
    she her hers herself it its itself they them their theirs themselves what which who whom
    this that these those am is are was were be been being have has had having do does did
    doing a an the and but if or because as until while of at by for with about against
    between into through during before after above below to from up down in out on off over
    under again further then once here there when where why how all any both each few more
    most other some such no nor not only own same so than too very s t can will just don
    should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm
    you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't weren't
    haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
    couldn't cannot could here's how's let's ought that's there's what's when's where's who's
    why's would
    """.split()
)


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n" + select.strip()


def _values(name: str, mapping: dict[int, str]) -> str:
    rows = ", ".join(f"({k}, '{v}')" for k, v in mapping.items())
    return f"{name}(cluster_id, label) AS (VALUES {rows})"


LABELS = _values("theme_label", THEME_NAMES)
MANUAL = _values("manual_label", MANUAL_LABELS)

LINES = """
lines AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS chunk_id,
         year(o_orderdate)::INTEGER AS fiscal_year, o_custkey,
         (p_size % 12 - 1)::INTEGER AS cluster_id,
         [(l_quantity - 25.0) / 25.0, (l_extendedprice - 37500.0) / 37500.0,
          (l_discount - 0.05) * 20.0, (l_tax - 0.04) * 25.0] AS embedding
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)
"""
REGION = (
    LINES
    + """,
chunks AS (
  SELECT lpad(c_nationkey::VARCHAR, 10, '0') AS cik, lines.*
  FROM lines JOIN customer ON o_custkey = c_custkey)
"""
)
ACCOUNT = (
    LINES
    + """,
chunks AS (SELECT lpad(o_custkey::VARCHAR, 10, '0') AS cik, * FROM lines)
"""
)
EVENTS = """
chunks AS (
  SELECT event_id::VARCHAR AS chunk_id, lpad(user_id::VARCHAR, 10, '0') AS cik,
         week(ts)::INTEGER AS fiscal_year,
         list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type)::INTEGER
           AS cluster_id
  FROM events)
"""
VECTORS = """
chunks AS (
  SELECT vec_id::VARCHAR AS chunk_id, lpad((vec_id % 4)::VARCHAR, 10, '0') AS cik,
         (2020 + (vec_id // 4) % 3)::INTEGER AS fiscal_year,
         (label - 1)::INTEGER AS cluster_id, embedding::DOUBLE[] AS embedding
  FROM embeddings)
"""
TEXTS = """
chunks AS (
  SELECT doc_id::VARCHAR AS chunk_id,
         lpad(regexp_extract(source, '([0-9]+)', 1), 10, '0') AS cik,
         (2016 + doc_id % 8)::INTEGER AS fiscal_year, doc_id AS chunk_index,
         (n_chars % 7 - 1)::INTEGER AS cluster_id, text
  FROM documents)
"""
INTENSITY = """
counted AS (
  SELECT cik, fiscal_year, cluster_id, count(*) AS chunk_count
  FROM chunks WHERE cluster_id <> -1 GROUP BY ALL),
totals AS (
  SELECT cik, fiscal_year, count(*) AS total_chunks
  FROM chunks WHERE cluster_id <> -1 GROUP BY ALL),
intensity AS (
  SELECT c.cik, c.fiscal_year, c.cluster_id, coalesce(l.label, 'unknown') AS cluster_label,
         chunk_count, total_chunks, chunk_count / total_chunks AS intensity,
         chunk_count > 0 AS is_present
  FROM counted c JOIN totals t ON c.cik = t.cik AND c.fiscal_year = t.fiscal_year
  LEFT JOIN theme_label l ON c.cluster_id = l.cluster_id)
"""
INTENSITY_COLUMNS = (
    "cik, fiscal_year, cluster_id, cluster_label, chunk_count, total_chunks, "
    "round(intensity, 6) AS intensity, is_present"
)


def _changes(source: str = "intensity") -> str:
    return f"""
starts AS (SELECT cik, cluster_id, min(fiscal_year) AS first_year FROM {source} GROUP BY ALL),
deltas AS (
  SELECT i.cik, i.cluster_id, i.fiscal_year, i.intensity, i.chunk_count,
         coalesce(p.intensity, 0.0) AS prev_intensity,
         i.intensity - coalesce(p.intensity, 0.0) AS delta,
         i.fiscal_year = s.first_year AS is_first
  FROM {source} i
  JOIN starts s ON i.cik = s.cik AND i.cluster_id = s.cluster_id
  LEFT JOIN {source} p ON i.cik = p.cik AND i.cluster_id = p.cluster_id
    AND p.fiscal_year = i.fiscal_year - 1),
changes AS (
  SELECT cik, cluster_id, fiscal_year, fiscal_year AS year, intensity, prev_intensity,
         delta AS intensity_delta, delta, chunk_count,
         abs(delta) * ln(1.0 + chunk_count) AS materiality_score,
         abs(delta) * ln(1.0 + chunk_count) AS materiality,
         CASE WHEN is_first OR (prev_intensity = 0 AND intensity > 0) THEN 'new'
              WHEN intensity = 0 AND prev_intensity > 0 THEN 'disappeared'
              WHEN delta > 0.02 THEN 'intensifying' WHEN delta < -0.02 THEN 'fading'
              ELSE 'stable' END AS change_type,
         is_first OR (prev_intensity = 0 AND intensity > 0) AS first_appearance,
         NOT is_first AND intensity = 0 AND prev_intensity > 0 AS disappeared
  FROM deltas)
"""


CHANGES = _changes()
CHANGE_COLUMNS = (
    "cik, cluster_id, fiscal_year, year, round(intensity, 6) AS intensity, "
    "round(prev_intensity, 6) AS prev_intensity, round(intensity_delta, 6) AS intensity_delta, "
    "round(delta, 6) AS delta, chunk_count, round(materiality_score, 6) AS materiality_score, "
    "round(materiality, 6) AS materiality, change_type, first_appearance, disappeared"
)
DRIFT = """
component AS (
  SELECT cik, cluster_id, fiscal_year, generate_subscripts(embedding, 1) AS dim,
         unnest(embedding) AS value
  FROM chunks WHERE cluster_id <> -1),
mean AS (
  SELECT cik, cluster_id, fiscal_year, dim, avg(value) AS value FROM component GROUP BY ALL),
version AS (
  SELECT cik, cluster_id, fiscal_year,
         max(fiscal_year) OVER (PARTITION BY cik, cluster_id ORDER BY fiscal_year
           ROWS BETWEEN 1 PRECEDING AND 1 PRECEDING) AS before
  FROM (SELECT DISTINCT cik, cluster_id, fiscal_year FROM mean)),
cosine AS (
  SELECT v.cik, v.cluster_id, v.fiscal_year, v.before,
         greatest(0.0, least(2.0, 1 - sum(a.value * b.value)
           / sqrt(sum(a.value * a.value)) / sqrt(sum(b.value * b.value)))) AS distance
  FROM version v
  JOIN mean a ON a.cik = v.cik AND a.cluster_id = v.cluster_id AND a.fiscal_year = v.fiscal_year
  JOIN mean b ON b.cik = v.cik AND b.cluster_id = v.cluster_id AND b.fiscal_year = v.before
    AND b.dim = a.dim
  GROUP BY ALL),
drift AS (
  SELECT cik, cluster_id, fiscal_year, round(distance, 4) AS centroid_drift FROM cosine)
"""
DRIFTED = """
drifted AS (
  SELECT c.*, d.centroid_drift
  FROM changes c LEFT JOIN drift d ON c.cik = d.cik AND c.cluster_id = d.cluster_id
    AND c.fiscal_year = d.fiscal_year)
"""
REGION_COMPANIES = """
companies AS (
  SELECT lpad(n_nationkey::VARCHAR, 10, '0') AS cik, 'N' || n_nationkey AS ticker,
         n_name AS name, r_name AS sector
  FROM nation JOIN region ON n_regionkey = r_regionkey)
"""
ACCOUNT_COMPANIES = """
companies AS (
  SELECT lpad(c_custkey::VARCHAR, 10, '0') AS cik, 'C' || c_custkey AS ticker,
         c_name AS name, c_mktsegment AS sector
  FROM customer)
"""
THEMES = """
themes AS (
  SELECT i.cluster_id::BIGINT AS cluster_id,
         coalesce(any_value(l.label), 'cluster_' || i.cluster_id) AS label,
         count(DISTINCT cik) AS n_companies_ever,
         min(fiscal_year)::BIGINT AS first_seen_year, max(fiscal_year)::BIGINT AS last_seen_year,
         false AS override_flag
  FROM intensity i LEFT JOIN theme_label l ON i.cluster_id = l.cluster_id
  GROUP BY i.cluster_id)
"""
GOLD_CHANGES = """
theme_changes AS (
  SELECT cik, cluster_id::BIGINT AS cluster_id, fiscal_year::BIGINT AS fiscal_year,
         intensity_delta, centroid_drift, materiality_score, change_type
  FROM drifted)
"""
GOLD_CHANGE_COLUMNS = (
    "cik, cluster_id, fiscal_year, round(intensity_delta, 6) AS intensity_delta, "
    "centroid_drift, round(materiality_score, 6) AS materiality_score, change_type"
)
REGION_STAR = (
    LABELS, REGION, INTENSITY, CHANGES, DRIFT, DRIFTED, REGION_COMPANIES, THEMES, GOLD_CHANGES,
)
ACCOUNT_STAR = (
    LABELS, ACCOUNT, INTENSITY, CHANGES, DRIFT, DRIFTED, ACCOUNT_COMPANIES, THEMES, GOLD_CHANGES,
)
FEED = """
feed AS (
  SELECT tc.*, t.label, c.ticker, c.name, c.sector
  FROM theme_changes tc LEFT JOIN themes t ON tc.cluster_id = t.cluster_id
  LEFT JOIN companies c ON tc.cik = c.cik)
"""
FEED_COLUMNS = GOLD_CHANGE_COLUMNS + ", label, ticker, name, sector"

# Intensity ----------------------------------------------------------------------------------

SQL["intensity"] = _with(
    LABELS, REGION, INTENSITY, select=f"SELECT {INTENSITY_COLUMNS} FROM intensity"
)
SQL["intensity_accounts"] = _with(
    LABELS, ACCOUNT, INTENSITY, select=f"SELECT {INTENSITY_COLUMNS} FROM intensity"
)
SQL["intensity_events"] = _with(
    "theme_label(cluster_id, label) AS (SELECT -5, 'none')", EVENTS, INTENSITY,
    select=f"SELECT {INTENSITY_COLUMNS} FROM intensity",
)
SQL["intensity_ratio"] = """
SELECT l_suppkey, count(*) FILTER (l_returnflag = 'R') AS n_returned, count(*) AS n_lines,
       round(count(*) FILTER (l_returnflag = 'R') / count(*), 6) AS ratio
FROM lineitem GROUP BY l_suppkey
"""
# The keys are written out here; the query computes its own, so that other keys would show.
_matrix = ",\n".join(
    f"round(coalesce(sum(intensity) FILTER (cik || '_' || fiscal_year = '{v}'), 0.0), 6) AS \"{v}\""
    for v in [f"{cik:010d}_{year}" for cik in range(25) for year in range(1995, 2002)]
)
SQL["presence_matrix"] = _with(
    LABELS, REGION, INTENSITY,
    select=f"SELECT cluster_id, {_matrix} FROM intensity GROUP BY cluster_id",
)
SQL["presence_long"] = _with(
    LABELS, ACCOUNT, INTENSITY,
    select="SELECT cik, fiscal_year, cluster_id, round(sum(intensity), 6) AS intensity "
    "FROM intensity GROUP BY ALL",
)

# Changes ------------------------------------------------------------------------------------

SQL["yoy_changes"] = _with(
    LABELS, REGION, INTENSITY, CHANGES, select=f"SELECT {CHANGE_COLUMNS} FROM changes"
)
SQL["yoy_changes_accounts"] = _with(
    LABELS, ACCOUNT, INTENSITY, CHANGES, select=f"SELECT {CHANGE_COLUMNS} FROM changes"
)
SQL["yoy_from_counts"] = SQL["yoy_changes"]
DENSE = """
dense AS (
  SELECT cik, fiscal_year, cluster_id, chunk_count, intensity FROM intensity
  UNION ALL
  SELECT i.cik, i.fiscal_year + 1, i.cluster_id, 0, 0.0
  FROM intensity i
  WHERE EXISTS (SELECT 1 FROM intensity o
                WHERE o.cik = i.cik AND o.fiscal_year = i.fiscal_year + 1)
    AND NOT EXISTS (SELECT 1 FROM intensity o
                    WHERE o.cik = i.cik AND o.cluster_id = i.cluster_id
                      AND o.fiscal_year = i.fiscal_year + 1))
"""
SQL["yoy_with_zero_rows"] = _with(
    LABELS, ACCOUNT, INTENSITY, DENSE, _changes("dense"),
    select=f"SELECT {CHANGE_COLUMNS} FROM changes",
)
SQL["change_scores"] = """
WITH v AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 500000.0 END AS p,
         CASE WHEN o_orderpriority <> '5-LOW' THEN (o_orderkey % 11)::DOUBLE / 11.0::DOUBLE END AS c
  FROM orders),
d AS (SELECT *, coalesce(c, 0.0) - coalesce(p, 0.0) AS delta FROM v)
SELECT o_orderkey,
       CASE WHEN p IS NULL OR p = 0 THEN 'new' WHEN c IS NULL OR c = 0 THEN 'disappeared'
            WHEN delta > 0.02 THEN 'intensifying' WHEN delta < -0.02 THEN 'fading'
            ELSE 'stable' END AS change_type,
       round(abs(delta) * ln(1.0 + o_custkey), 9) AS materiality_score,
       round(greatest(0.0, least(1.0, 0.5 + delta / 2)), 9) AS approximate_current,
       round(greatest(0.0, least(1.0, 0.5 - delta / 2)), 9) AS approximate_previous
FROM d
"""
SQL["ranked_changes"] = _with(
    LABELS, REGION, INTENSITY, CHANGES, DRIFT, DRIFTED,
    select="SELECT row_number() OVER (ORDER BY round(materiality_score, 12) DESC, cik, cluster_id, "
    "fiscal_year) AS rank, cik, cluster_id, fiscal_year, "
    "round(materiality_score, 6) AS materiality_score, centroid_drift FROM drifted",
)
SQL["ranked_changes_accounts"] = _with(
    LABELS, ACCOUNT, INTENSITY, CHANGES,
    select="SELECT row_number() OVER (ORDER BY round(materiality_score, 12) DESC, cik, cluster_id, "
    "fiscal_year) AS rank, cik, cluster_id, fiscal_year, "
    "round(materiality_score, 6) AS materiality_score, change_type FROM changes",
)
SQL["top_changes"] = _with(
    LABELS, ACCOUNT, INTENSITY, CHANGES, DRIFT, DRIFTED,
    select="SELECT row_number() OVER (ORDER BY round(materiality_score, 12) DESC, cik, cluster_id, "
    "fiscal_year) AS rank, cik, cluster_id, fiscal_year, "
    "round(intensity_delta, 6) AS intensity_delta, "
    "round(materiality_score, 6) AS materiality_score, change_type, centroid_drift "
    "FROM drifted ORDER BY rank LIMIT 500",
)
SQL["changes_with_drift"] = _with(
    LABELS, ACCOUNT, INTENSITY, CHANGES, DRIFT, DRIFTED,
    select=f"SELECT {CHANGE_COLUMNS}, centroid_drift FROM drifted",
)

# Tracker ------------------------------------------------------------------------------------

SQL["company_timeline"] = _with(
    LABELS, REGION, INTENSITY,
    select=f"SELECT {INTENSITY_COLUMNS} FROM intensity WHERE cik = '{ONE_COMPANY}'",
)
SQL["theme_trajectory"] = _with(
    LABELS, ACCOUNT, INTENSITY,
    select=f"SELECT {INTENSITY_COLUMNS} FROM intensity WHERE cluster_id = 3",
)
SQL["emerging_themes"] = _with(
    LABELS, ACCOUNT, INTENSITY, CHANGES,
    select=f"""
SELECT q.cluster_id, s.cluster_label, company_count, mean_intensity, total_chunk_count
FROM (SELECT cluster_id, count(DISTINCT cik) AS company_count FROM changes
      WHERE fiscal_year = {EMERGING_YEAR} AND first_appearance
      GROUP BY cluster_id HAVING count(DISTINCT cik) >= 3) q
LEFT JOIN (SELECT cluster_id, any_value(cluster_label) AS cluster_label,
                  round(avg(intensity), 6) AS mean_intensity,
                  sum(chunk_count)::BIGINT AS total_chunk_count
           FROM intensity WHERE fiscal_year = {EMERGING_YEAR} GROUP BY cluster_id) s
  ON q.cluster_id = s.cluster_id""",
)
SQL["fading_themes"] = _with(
    LABELS, ACCOUNT, INTENSITY, CHANGES,
    select=f"""
SELECT {CHANGE_COLUMNS}, label AS cluster_label
FROM changes LEFT JOIN theme_label USING (cluster_id)
WHERE fiscal_year = {EMERGING_YEAR} AND change_type IN ('disappeared', 'fading')""",
)
SQL["theme_prevalence"] = _with(
    LABELS, ACCOUNT, INTENSITY,
    """yearly AS (SELECT cluster_id, fiscal_year, avg(intensity) AS m
                  FROM intensity GROUP BY ALL)""",
    """peak AS (SELECT cluster_id, fiscal_year FROM (
                  SELECT *, row_number() OVER (PARTITION BY cluster_id
                                               ORDER BY m DESC, fiscal_year) AS r FROM yearly)
                WHERE r = 1)""",
    select="""
SELECT i.cluster_id, any_value(l.label) AS cluster_label,
       count(DISTINCT cik) AS unique_companies, min(i.fiscal_year) AS first_year,
       max(i.fiscal_year) AS last_year, round(avg(intensity), 6) AS mean_intensity,
       any_value(p.fiscal_year) AS peak_intensity_year
FROM intensity i JOIN peak p ON i.cluster_id = p.cluster_id
LEFT JOIN theme_label l ON i.cluster_id = l.cluster_id
GROUP BY i.cluster_id""",
)
_BY_TYPE = ", ".join(
    f"(SELECT count(*) FROM changes WHERE change_type = '{k}') AS n_{k}"
    for k in ("new", "intensifying", "fading", "disappeared", "stable")
)
SQL["corpus_stats"] = _with(
    LABELS, ACCOUNT, INTENSITY, CHANGES,
    select=f"""
SELECT count(DISTINCT cik) AS total_companies, count(DISTINCT fiscal_year) AS total_years,
       (SELECT count(*) FROM (SELECT DISTINCT cik, fiscal_year FROM intensity)) AS total_filings,
       sum(chunk_count)::BIGINT AS total_chunks,
       (SELECT round(avg(n), 4) FROM (SELECT count(DISTINCT cluster_id) AS n FROM intensity
                                      GROUP BY cik, fiscal_year)) AS mean_themes_per_filing,
       round(avg(intensity), 6) AS mean_intensity_per_theme,
       count(DISTINCT cluster_id) AS total_themes, {_BY_TYPE}
FROM intensity""",
)
SQL["change_type_histogram"] = _with(
    LABELS, ACCOUNT, INTENSITY, CHANGES,
    select="SELECT change_type, count(*) AS n_changes FROM changes GROUP BY change_type",
)

# Vectors ------------------------------------------------------------------------------------

_CENTROIDS = """
centroid AS (
  SELECT cluster_id, dim, avg(value) AS value
  FROM (SELECT cluster_id, unnest(embedding) AS value,
               generate_subscripts(embedding, 1) AS dim FROM chunks WHERE cluster_id <> -1)
  GROUP BY ALL)
"""
SQL["cluster_centroids"] = _with(
    VECTORS, _CENTROIDS,
    "members AS (SELECT cluster_id, count(*) AS n_members FROM chunks GROUP BY ALL)",
    select="SELECT cluster_id, n_members, (dim - 1)::INTEGER AS dim, round(value, 6) AS value "
    "FROM centroid JOIN members USING (cluster_id)",
)
SQL["missing_cluster_centroid"] = _with(
    VECTORS, _CENTROIDS,
    select="SELECT cluster_id, (dim - 1)::INTEGER AS dim, round(value, 6) AS value FROM centroid "
    "WHERE cluster_id = 3 UNION ALL SELECT 99, range::INTEGER, 0.0 FROM range(64)",
)
SQL["nearest_vectors"] = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL),
d AS (SELECT q.vec_id, n.vec_id AS neighbour, list_distance(q.e, n.e) AS d
      FROM v q JOIN v n ON q.vec_id <> n.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, neighbour) AS place FROM d)
SELECT vec_id, place::INTEGER AS place, neighbour, round(d, 6) AS distance FROM r WHERE place <= 15
"""
SQL["density_clusters"] = """
WITH RECURSIVE points AS (
  SELECT vec_id::VARCHAR AS chunk_id, embedding[1:12]::DOUBLE[] AS v FROM embeddings
), pairs AS (
  SELECT a.chunk_id AS a, b.chunk_id AS b FROM points a JOIN points b
  ON a.chunk_id <> b.chunk_id AND list_distance(a.v, b.v) <= 0.3
), core AS (
  SELECT a FROM pairs GROUP BY a HAVING count(*) >= 5
), reached AS (
  SELECT a AS root, a AS place FROM core
  UNION
  SELECT r.root, p.b FROM reached r JOIN pairs p ON p.a = r.place JOIN core c ON c.a = p.b
), named AS (
  SELECT place, min(root) AS component FROM reached GROUP BY place
)
SELECT chunk_id, component IS NOT NULL AS is_core, component FROM points LEFT JOIN named ON place = chunk_id
"""
SQL["cluster_stats"] = _with(
    VECTORS,
    select="""
SELECT count(DISTINCT cluster_id) FILTER (cluster_id <> -1) AS n_clusters,
       count(*) FILTER (cluster_id = -1) AS noise_count, count(*) AS total_points,
       round(count(*) FILTER (cluster_id = -1) / count(*), 4) AS noise_fraction,
       count(DISTINCT cluster_id) FILTER (cluster_id <> -1)::INTEGER AS n_sizes
FROM chunks""",
)
SQL["cluster_sizes"] = _with(
    REGION, select="SELECT cluster_id, count(*) AS n FROM chunks GROUP BY cluster_id"
)
SQL["unit_vectors"] = """
WITH scaled AS (
  SELECT vec_id, generate_subscripts(embedding, 1) AS dim,
         unnest(embedding)::DOUBLE * (vec_id % 5) AS v FROM embeddings),
length AS (SELECT vec_id, sqrt(sum(v * v)) AS n FROM scaled GROUP BY vec_id)
SELECT vec_id, (dim - 1)::INTEGER AS dim,
       round(v / CASE WHEN n = 0 THEN 1.0 ELSE n END, 6) AS value
FROM scaled JOIN length USING (vec_id)
"""
SQL["centroid_drift"] = _with(
    VECTORS, DRIFT, select="SELECT cik, cluster_id, fiscal_year, centroid_drift FROM drift"
)
SQL["centroid_drift_accounts"] = _with(
    ACCOUNT, DRIFT, select="SELECT cik, cluster_id, fiscal_year, centroid_drift FROM drift"
)
SQL["distribution_drift"] = _with(
    VECTORS, DRIFT,
    """
member AS (
  SELECT cik, cluster_id, fiscal_year, chunk_id, embedding,
         count(*) OVER (PARTITION BY cik, cluster_id, fiscal_year) AS n
  FROM chunks WHERE cluster_id <> -1)""",
    """
pair AS (
  SELECT cik, cluster_id, fiscal_year, distance AS observed
  FROM cosine WHERE before = fiscal_year - 1)""",
    """
apart AS (
  SELECT p.cik, p.cluster_id, p.fiscal_year, a.fiscal_year AS ya, b.fiscal_year AS yb,
         avg(list_cosine_distance(a.embedding, b.embedding)) AS d, max(a.n) AS n
  FROM pair p
  JOIN member a ON a.cik = p.cik AND a.cluster_id = p.cluster_id
    AND a.fiscal_year IN (p.fiscal_year, p.fiscal_year - 1)
  JOIN member b ON b.cik = p.cik AND b.cluster_id = p.cluster_id
    AND b.fiscal_year IN (p.fiscal_year, p.fiscal_year - 1)
  GROUP BY ALL)""",
    """
spread AS (
  SELECT cik, cluster_id, fiscal_year,
         max(d) FILTER (ya = fiscal_year AND yb = fiscal_year - 1) AS x,
         coalesce(max(d) FILTER (ya = yb AND ya = fiscal_year AND n > 1), 0.0) AS c,
         coalesce(max(d) FILTER (ya = yb AND ya = fiscal_year - 1 AND n > 1), 0.0) AS p
  FROM apart GROUP BY ALL)""",
    """
drawn AS (
  SELECT p.cik, p.cluster_id, p.fiscal_year, p.observed, m.embedding, i,
         row_number() OVER (PARTITION BY p.cik, p.cluster_id, p.fiscal_year, i
                            ORDER BY md5(m.chunk_id || '#' || i))
           <= count(*) FILTER (m.fiscal_year = p.fiscal_year)
                OVER (PARTITION BY p.cik, p.cluster_id, p.fiscal_year, i) AS first_part
  FROM pair p
  JOIN member m ON m.cik = p.cik AND m.cluster_id = p.cluster_id
    AND m.fiscal_year IN (p.fiscal_year, p.fiscal_year - 1),
  range(1, 61) AS r(i))""",
    """
regrouped AS (
  SELECT cik, cluster_id, fiscal_year, observed, i, dim,
         avg(value) FILTER (first_part) AS a, avg(value) FILTER (NOT first_part) AS b
  FROM (SELECT * EXCLUDE (embedding), generate_subscripts(embedding, 1) AS dim,
               unnest(embedding) AS value FROM drawn)
  GROUP BY ALL)""",
    """
shuffled AS (
  SELECT cik, cluster_id, fiscal_year, i,
         1 - sum(a * b) / sqrt(sum(a * a)) / sqrt(sum(b * b)) >= observed - 1e-12 AS reached
  FROM regrouped GROUP BY cik, cluster_id, fiscal_year, observed, i)""",
    """
p AS (
  SELECT cik, cluster_id, fiscal_year, count(*) FILTER (reached) / 60 AS p_value
  FROM shuffled GROUP BY ALL)""",
    select="""
SELECT cik, cluster_id, fiscal_year, round(observed, 4) AS centroid_drift,
       round(greatest(0.0, 2 * x - c - spread.p), 4) AS wasserstein_drift,
       round(p_value, 4) AS p_value,
       round(greatest(0.0, least(1.0, 1 - (c + spread.p) / 2)), 4) AS boilerplate_index,
       p_value < 0.05 AS is_statistically_significant
FROM pair JOIN spread USING (cik, cluster_id, fiscal_year)
JOIN p USING (cik, cluster_id, fiscal_year)""",
)
TEXT_VECTORS = """
chunks AS (
  SELECT doc_id::VARCHAR AS chunk_id, (label - 1)::INTEGER AS cluster_id,
         embedding::DOUBLE[] AS embedding, text
  FROM documents JOIN embeddings ON vec_id = doc_id % (SELECT count(*) FROM embeddings))
"""
_MARKERS = "['the','and','to','of','in','a','is','that','for','our','we','by','as','with']"
WORDS = "list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')"
PROSE = f"""
worded AS (SELECT *, {WORDS} AS words FROM {{source}}),
flagged AS (
  SELECT *, len(words) AS n_words,
         len(list_filter(words, lambda w: regexp_matches(w, '[a-zA-Z]'))) AS n_alpha,
         len(list_intersect({_MARKERS},
                            list_transform(words, lambda w: lower(w)))) AS n_markers
  FROM worded),
prose AS (
  SELECT *, n_words >= 15 AND n_alpha / greatest(n_words, 1) >= 0.65 AND n_markers >= 3
    AS is_prose FROM flagged)
"""
CENTROID_LISTS = """
middle AS (SELECT cluster_id, list(value ORDER BY dim) AS centroid FROM centroid GROUP BY ALL)
"""
SQL["novel_outliers"] = _with(
    TEXT_VECTORS, _CENTROIDS, CENTROID_LISTS, PROSE.format(source="chunks"),
    """
nearest AS (
  SELECT p.chunk_id, p.text, min(list_cosine_distance(p.embedding, m.centroid)) AS d
  FROM prose p, middle m WHERE p.is_prose AND p.cluster_id = -1 GROUP BY ALL)""",
    select="SELECT chunk_id, round(d, 4) AS anomaly_score, true AS is_outlier, text "
    "FROM nearest ORDER BY d DESC, chunk_id LIMIT 50",
)
_REPRESENTATIVE = """
near AS (
  SELECT c.cluster_id, c.chunk_id,
         row_number() OVER (PARTITION BY c.cluster_id
           ORDER BY list_cosine_distance(c.embedding, m.centroid), c.chunk_id)::INTEGER AS place
  FROM chunks c JOIN middle m ON c.cluster_id = m.cluster_id),
representative AS (SELECT * FROM near WHERE place <= 5)
"""
SQL["representative_chunks"] = _with(
    VECTORS, _CENTROIDS, CENTROID_LISTS, _REPRESENTATIVE,
    select="SELECT cluster_id, chunk_id, place FROM representative",
)
SQL["missing_embeddings"] = """
SELECT doc_id::VARCHAR AS chunk_id, sha256('hashing-tf' || chr(10) || text) AS content_key
FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)
"""
SQL["merged_embedding_store"] = """
SELECT doc_id::VARCHAR AS chunk_id,
       lpad(regexp_extract(source, '([0-9]+)', 1), 10, '0') AS cik,
       CASE WHEN doc_id IN (SELECT vec_id FROM embeddings) THEN 'stored' ELSE 'new' END AS origin
FROM documents
"""

_SHARED_ID = "lpad(regexp_extract(source, '([0-9]+)', 1), 10, '0') || '_' || (2016 + doc_id % 8)"
SQL["duplicate_chunk_ids"] = f"""
SELECT {_SHARED_ID} AS chunk_id, count(*) AS n FROM documents GROUP BY ALL HAVING count(*) > 1
"""
SQL["stored_vectors"] = f"""
SELECT doc_id::VARCHAR AS accession_number, {_SHARED_ID} AS chunk_id, sha256(text) AS text_sha256,
       1::BIGINT AS n_vectors, 1::BIGINT AS n_vectors_of_text FROM documents
"""

# Text ---------------------------------------------------------------------------------------


def _strip(expression: str) -> str:
    return f"regexp_replace({expression}, '^\\s+|\\s+$', '', 'g')"


def _normalized(expression: str) -> str:
    inner = f"regexp_replace({expression}, '[ \\t]+', ' ', 'g')"
    return _strip(f"regexp_replace({inner}, '\\n\\s*\\n', chr(10) || chr(10), 'g')")


def _dehyphenated(expression: str) -> str:
    word = "[\\pL\\pN_]+"
    return f"regexp_replace({expression}, '({word})-\\n({word})', '\\1\\2', 'g')"


def _unpaged(expression: str) -> str:
    pattern = "(?i)^\\s*(-\\s*[0-9]+\\s*-|page\\s+[0-9]+(\\s+of\\s+[0-9]+)?|[0-9]+)\\s*$"
    lines = f"string_split(regexp_replace({expression}, '\\n$', ''), chr(10))"
    kept = f"list_filter({lines}, lambda x: NOT regexp_matches(x, '{pattern}'))"
    return f"array_to_string({kept}, chr(10))"


def _decomposed(expression: str) -> str:
    """Compatibility decomposition of Latin letters and circled digits by plain replacement."""
    for code in [*range(0xA0, 0x180), *range(0x2460, 0x2474)]:
        parts = unicodedata.normalize("NFKD", chr(code))
        if parts != chr(code):
            replacement = " || ".join(f"chr({ord(p)})" for p in parts)
            expression = f"replace({expression}, chr({code}), {replacement})"
    return expression


SQL["normalized_whitespace"] = f"""
SELECT doc_id, {_normalized("v")} AS text
FROM (SELECT doc_id, replace(replace(text, ', ', ',' || chr(9) || '  '), chr(10),
      chr(10) || ' ' || chr(9) || chr(10) || chr(10)) AS v FROM documents)
"""
SQL["dehyphenated_text"] = f"""
SELECT doc_id, {_dehyphenated("replace(text, 'e ', 'e-' || chr(10))")} AS text FROM documents
"""
_PAGED = (
    "'1' || chr(10) || replace(text, chr(10), chr(10) || ' - 12 - ' || chr(10) || "
    "'Page 3 OF 9' || chr(10) || '2024 annual' || chr(10) || chr(9) || '7' || chr(10) || "
    "'page 4' || chr(10)) || chr(10) || '- 5 -' || chr(10)"
)
SQL["page_lines_removed"] = f"SELECT doc_id, {_unpaged(_PAGED)} AS text FROM documents"
SQL["cleaned_text"] = f"""
WITH raw AS (
  SELECT doc_id, {_PAGED} || chr(7) || ' end-' || chr(10) || 'line  ' || chr(9312) AS text
  FROM documents),
flat AS (SELECT doc_id, regexp_replace({_decomposed("text")},
           '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x{{7f}}-\\x{{9f}}]', '', 'g') AS text FROM raw),
joined AS (SELECT doc_id, {_dehyphenated("text")} AS text FROM flat),
unpaged AS (SELECT doc_id, {_unpaged("text")} AS text FROM joined)
SELECT doc_id, {_normalized("text")} AS text FROM unpaged
"""
SQL["prose_flags"] = _with(
    PROSE.format(source="documents"),
    select="SELECT doc_id, n_words, greatest(1, floor(n_words / 0.75))::BIGINT AS n_tokens, "
    "n_markers, is_prose FROM prose",
)
SQL["prose_turns"] = _with(
    PROSE.format(source="conversations"),
    select="SELECT role, count(*) AS n_turns, "
    "sum(greatest(1, floor(n_words / 0.75)))::BIGINT AS n_tokens "
    "FROM prose WHERE is_prose GROUP BY role",
)


def _sentence_list(expression: str) -> str:
    marked = f"regexp_replace({expression}, '([.!?])\\s+([A-Z])', '\\1' || chr(1) || '\\2', 'g')"
    parts = f"list_transform(string_split({marked}, chr(1)), lambda s: {_strip('s')})"
    return f"list_filter({parts}, lambda s: s <> '')"


SQL["sentences"] = f"""
SELECT doc_id, (generate_subscripts(s, 1) - 1)::INTEGER AS pos, unnest(s) AS sentence
FROM (SELECT doc_id, {_sentence_list("text")} AS s FROM documents)
"""


def _paragraph_list(expression: str) -> str:
    blocks = f"regexp_split_to_array({expression}, '\\n\\s*\\n')"
    stripped = f"list_transform({blocks}, lambda b: {_strip('b')})"
    marked = "regexp_replace(b, '(?m)^([•*-]|[0-9]+[.):])(\\s)', chr(1) || '\\1\\2', 'g')"
    pieces = f"flatten(list_transform({stripped}, lambda b: string_split({marked}, chr(1))))"
    return f"list_filter(list_transform({pieces}, lambda p: {_strip('p')}), lambda p: p <> '')"


_LISTED = (
    "replace(replace(text, '. ', '.' || chr(10) || '- '), chr(10), "
    "chr(10) || '2) ' || chr(10) || ' ' || chr(10))"
)
SQL["paragraphs"] = f"""
SELECT doc_id, (generate_subscripts(p, 1) - 1)::INTEGER AS pos, unnest(p) AS paragraph
FROM (SELECT doc_id, {_paragraph_list(_LISTED)} AS p FROM documents)
"""


def _word_count(expression: str) -> str:
    return f"len(list_filter(regexp_split_to_array({expression}, '\\s+'), lambda w: w <> ''))"


SQL["chunks"] = f"""
WITH RECURSIVE section AS (
  SELECT lpad(doc_id::VARCHAR, 10, '0') AS cik, (2016 + doc_id % 8)::INTEGER AS fiscal_year,
         doc_id::VARCHAR AS accession_number, lang AS section, text FROM documents),
paragraph AS (
  SELECT * EXCLUDE (text, p), unnest(p) AS text, generate_subscripts(p, 1) AS para
  FROM (SELECT *, {_paragraph_list("text")} AS p FROM section)),
sized AS (SELECT *, {_word_count("text")} AS n FROM paragraph),
kept AS (SELECT * FROM sized WHERE n >= 40),
sentence AS (
  SELECT cik, fiscal_year, accession_number, section, para, unnest(s) AS s,
         generate_subscripts(s, 1) AS pos
  FROM (SELECT *, {_sentence_list("text")} AS s FROM kept WHERE n > 300)),
counted AS (SELECT *, {_word_count("s")} AS n FROM sentence),
packed AS (
  SELECT accession_number, para, pos, 1 AS grp, n AS running FROM counted WHERE pos = 1
  UNION ALL
  SELECT c.accession_number, c.para, c.pos,
         p.grp + CASE WHEN p.running + c.n > 300 THEN 1 ELSE 0 END,
         CASE WHEN p.running + c.n > 300 THEN c.n ELSE p.running + c.n END
  FROM packed p JOIN counted c ON c.accession_number = p.accession_number
    AND c.para = p.para AND c.pos = p.pos + 1),
piece AS (
  SELECT accession_number, para, 1 AS grp, text FROM kept WHERE n <= 300
  UNION ALL
  SELECT accession_number, para, grp, string_agg(s, ' ' ORDER BY pos)
  FROM packed JOIN counted USING (accession_number, para, pos) GROUP BY ALL),
numbered AS (
  SELECT *, (row_number() OVER (PARTITION BY accession_number ORDER BY para, grp) - 1)::INTEGER
    AS chunk_index FROM piece)
SELECT printf('%s_%d_%s_%04d', s.cik, s.fiscal_year, s.section, chunk_index) AS chunk_id,
       s.cik, s.fiscal_year, accession_number, s.section, chunk_index, n.text,
       {_word_count("n.text")}::INTEGER AS token_count
FROM numbered n JOIN (SELECT * EXCLUDE (text) FROM section) s USING (accession_number)
WHERE {_word_count("n.text")} >= 40
"""
_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOP_WORDS)


def _title(expression: str) -> str:
    runs = f"regexp_extract_all(lower({expression}), '[\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]+|[^\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]+')"
    return f"array_to_string(list_transform({runs}, lambda r: upper(r[1]) || r[2:]), '')"


def _keywords(source: str) -> tuple[str, ...]:
    return (
        f"""
token AS (
  SELECT cluster_id, list_filter(regexp_extract_all(lower(text), '[\\pL\\pN_]{{2,}}'),
                                 lambda t: t NOT IN ({_STOP})) AS t
  FROM {source}),
term AS (
  SELECT cluster_id, unnest(t) AS term FROM token
  UNION ALL
  SELECT cluster_id, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))
  FROM token),
counted_term AS (SELECT cluster_id, term, count(*) AS n FROM term GROUP BY ALL),
placed_term AS (
  SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY n DESC, term DESC) AS place
  FROM counted_term),
keyword AS (
  SELECT cluster_id,
         left(string_agg({_title("term")}, ' / ' ORDER BY place), 50) AS label
  FROM placed_term WHERE place <= 3 GROUP BY cluster_id)
""",
    )


SQL["keyword_labels"] = _with(
    TEXTS, *_keywords("chunks WHERE cluster_id <> -1"),
    select="SELECT cluster_id, label FROM keyword",
)
SQL["clean_labels"] = f"""
WITH raw AS (
  SELECT p_partkey, ' "''' || p_name || '  of' || chr(9) || 'the u.s. ' || p_brand || '''s '
         || p_type || ' line.''" ' AS v FROM part),
bare AS (SELECT p_partkey, rtrim({_strip("trim(" + _strip("v") + ", '\"''')")}, '.') AS v FROM raw)
SELECT p_partkey, left({_title("regexp_replace(v, '\\s+', ' ', 'g')")}, 50) AS label FROM bare
"""
SQL["label_prompts"] = _with(
    TEXT_VECTORS, _CENTROIDS, CENTROID_LISTS, _REPRESENTATIVE,
    select="""
SELECT r.cluster_id,
       'Below are ' || count(*) || ' excerpts from company risk disclosures. Name the risk theme '
       || 'they share in three to six words. Answer with the label only.' || chr(10) || chr(10)
       || string_agg('[' || place || '] ' || left(text, 500), chr(10) || chr(10) ORDER BY place)
         AS prompt
FROM representative r JOIN chunks USING (chunk_id) GROUP BY r.cluster_id""",
)
SQL["theme_label_choice"] = _with(
    MANUAL, TEXT_VECTORS, _CENTROIDS, CENTROID_LISTS, _REPRESENTATIVE,
    "excerpt AS (SELECT r.cluster_id, text FROM representative r JOIN chunks USING (chunk_id))",
    *_keywords("excerpt"),
    "every AS (SELECT cluster_id FROM chunks UNION SELECT cluster_id FROM manual_label)",
    select=f"""
SELECT cluster_id, coalesce({_title("m.label")}, k.label, 'Unknown Theme') AS label
FROM every LEFT JOIN manual_label m USING (cluster_id) LEFT JOIN keyword k USING (cluster_id)""",
)

# Sections and pages -------------------------------------------------------------------------

SQL["extracted_sections"] = f"""
WITH body AS (
  SELECT doc_id, lang, {_strip("text")} AS text, lang = 'en' AS is_ixbrl, lang <> 'fr' AS found
  FROM documents),
cut AS (
  SELECT *, regexp_matches(text, '(?i)item\\s+(1a|1b\\b|1c\\b|2\\b|3\\b)') AS cross_reference
  FROM body)
SELECT doc_id, lang, CASE WHEN found THEN text ELSE '' END AS text,
       found AND length(text) >= 30 AS success,
       CASE WHEN found THEN length(text) ELSE 0 END::INTEGER AS char_count, is_ixbrl,
       CASE WHEN NOT found THEN 'none'
            ELSE CASE WHEN is_ixbrl THEN 'ixbrl' ELSE 'legacy_html' END
              || CASE WHEN length(text) >= 30 THEN '_boundary' ELSE '_fallback' END
       END AS extraction_method,
       CASE WHEN NOT found THEN 'ITEM_1A_HEADING_NOT_FOUND'
            WHEN length(text) < 30 THEN 'EXTRACTED_SECTION_TOO_SHORT' END AS failure_reason,
       CASE WHEN NOT found THEN 'ITEM_1A_HEADING_NOT_FOUND'
            WHEN length(text) < 30 THEN 'EXTRACTED_SECTION_TOO_SHORT' END AS error
FROM cut
"""
SQL["extraction_failures"] = """
SELECT 'none' AS extraction_method, 'ITEM_1A_HEADING_NOT_FOUND' AS failure_reason,
       false AS success, count(*) AS n_pages
FROM pages WHERE NOT regexp_matches(html, '(?i)item\\s+1a')
"""


def _page_text() -> str:
    steps = [
        ("(?is)<script\\b.*?</script>", ""),
        ("(?is)<style\\b.*?</style>", ""),
        ("(?is)<footer\\b.*?</footer>", ""),
        ("(?is)<footer\\b.*$", ""),
        ("(?s)<!--.*?-->", "\\x01"),
        ("<[^>]*>", "\\x01"),
    ]
    expression = "html"
    for pattern, replacement in steps:
        target = "chr(1)" if replacement else "''"
        expression = f"regexp_replace({expression}, '{pattern}', {target}, 'g')"
    # Between two tags a run of marks is one line feed; blanks alone stay a node of their own.
    expression = f"regexp_replace({expression}, '\\x01+', chr(10), 'g')"
    for entity, code in (("copy", 169), ("middot", 183), ("quot", 34), ("amp", 38)):
        expression = f"regexp_replace({expression}, '&{entity};?', chr({code}), 'g')"
    return _normalized(expression)


SQL["page_text"] = f"SELECT page_id, {_page_text()} AS text FROM pages"

# Identifiers and JSON -----------------------------------------------------------------------

SQL["padded_ids"] = """
SELECT c_custkey, lpad(c_custkey::VARCHAR, 10, '0') AS filled,
       lpad(c_custkey::VARCHAR, 10, '0') AS padded,
       NULL::VARCHAR AS not_numeric, '12345678901' || c_custkey AS long_key
FROM customer
"""
SQL["accession_numbers"] = """
SELECT o_orderkey, lpad(o_orderkey::VARCHAR, 10, '0') || '-24-000123' AS dashed,
       lpad(o_orderkey::VARCHAR, 10, '0') || '24000123' AS bare,
       o_orderpriority AS other_length,
       'bronze/' || lpad(o_custkey::VARCHAR, 10, '0') || '/' || lpad(o_orderkey::VARCHAR, 10, '0')
         || '24000123/index.json' AS path
FROM orders
"""
FILINGS = """
filing AS (
  SELECT lpad(o_custkey::VARCHAR, 10, '0') AS cik, n,
         lpad(o_orderkey::VARCHAR, 10, '0') || '-24-00000' || n AS accession_number,
         CASE WHEN n = 1 THEN CASE WHEN o_orderstatus = 'F' THEN '10-K' ELSE '10-Q' END
              WHEN n = 2 THEN '10-K' ELSE '10-K/A' END AS form,
         CASE n WHEN 1 THEN o_orderdate::DATE::VARCHAR
                WHEN 2 THEN (o_orderdate::DATE + INTERVAL 12 MONTH)::DATE::VARCHAR
                WHEN 3 THEN (o_orderdate::DATE + INTERVAL 14 MONTH)::DATE::VARCHAR
                ELSE 'unknown' END AS filing_date,
         (o_orderdate::DATE - 60)::VARCHAR AS report_date,
         o_orderpriority || '.htm' AS primary_document
  FROM orders, range(1, 5) AS r(n))
"""
SQL["annual_filings"] = _with(
    FILINGS,
    select="SELECT cik, accession_number, form, filing_date, report_date, primary_document, "
    "left(filing_date, 4)::INTEGER AS fiscal_year FROM filing "
    "WHERE form = '10-K' AND left(filing_date, 4) IN ('1996', '1997', '1998')",
)
SQL["recent_annual_filings"] = _with(
    FILINGS,
    select="SELECT cik, accession_number, form, filing_date, report_date, primary_document, "
    "left(filing_date, 4)::INTEGER AS fiscal_year FROM filing "
    "WHERE form IN ('10-K', '10-K/A') AND filing_date <> 'unknown' "
    "AND filing_date >= '1997-01-01'",
)
SQL["standard_facts"] = f"""
WITH o AS (
  SELECT lpad(o_orderkey::VARCHAR, 10, '0') AS cik, year(o_orderdate)::INTEGER AS y,
         o_totalprice AS v, o_orderstatus AS s,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'Revenues'
              ELSE 'RevenueFromContractWithCustomerExcludingAssessedTax' END AS revenue
  FROM orders),
f AS (
  SELECT cik, y AS fiscal_year, 'Revenues' AS concept, revenue AS reported_as, v * 2 AS value,
         y || '-06-01' AS filed_date FROM o
  UNION ALL
  SELECT cik, y + 1, 'Revenues', revenue, v * 4, (y + 1) || '-02-01' FROM o
  UNION ALL
  SELECT cik, y, 'Assets', 'Assets', v, y || '-02-01' FROM o WHERE s <> 'O'
  UNION ALL
  SELECT cik, y, 'Liabilities', 'Liabilities', -v, y || '-02-01' FROM o)
SELECT cik, fiscal_year, concept, reported_as, round(value, 6) AS value, 'USD' AS unit, filed_date
FROM f WHERE fiscal_year IN ({", ".join(map(str, FACT_YEARS))})
"""
SQL["fiscal_year_values"] = """
SELECT lpad(o_orderkey::VARCHAR, 10, '0') AS cik, year(o_orderdate)::INTEGER AS fiscal_year,
       round(-o_totalprice, 6) AS value FROM orders
"""
SQL["ticker_map"] = """
SELECT lpad(s_suppkey::VARCHAR, 10, '0') AS cik, 'S' || s_nationkey AS ticker, s_name AS name
FROM supplier
"""

# Evidence and explanations ------------------------------------------------------------------

EVIDENCE = """
evidence AS (
  SELECT cik, cluster_id, fiscal_year, chunk_id, text,
         row_number() OVER (PARTITION BY cik, cluster_id, fiscal_year
                            ORDER BY chunk_index, chunk_id)::INTEGER AS place
  FROM chunks),
first_evidence AS (SELECT * FROM evidence WHERE place <= 2)
"""
SQL["first_evidence"] = _with(
    TEXTS, EVIDENCE,
    select="SELECT cik, cluster_id, fiscal_year, place, chunk_id, text FROM first_evidence",
)
CITED = """
cited AS (
  SELECT cik, cluster_id, fiscal_year, list(chunk_id ORDER BY place) AS ids,
         list(text ORDER BY place) AS texts
  FROM first_evidence GROUP BY ALL)
"""
_NEIGHBOURS = """
LEFT JOIN cited n ON n.cik = c.cik AND n.cluster_id = c.cluster_id
  AND n.fiscal_year = c.fiscal_year
LEFT JOIN cited b ON b.cik = c.cik AND b.cluster_id = c.cluster_id
  AND b.fiscal_year = c.fiscal_year - 1
"""
TEXT_CHANGES = (LABELS, TEXTS, INTENSITY, CHANGES, EVIDENCE, CITED)
SQL["change_evidence"] = _with(
    *TEXT_CHANGES,
    select=f"""
SELECT c.cik, c.cluster_id, c.fiscal_year, coalesce(array_to_string(n.ids, ','), '')
         AS current_ids, coalesce(array_to_string(b.ids, ','), '') AS previous_ids
FROM changes c {_NEIGHBOURS}""",
)


def _percent(expression: str) -> str:
    return f"printf('%.1f', ({expression}) * 100.0) || '%'"


def _template(label: str) -> str:
    return f"""
'The theme "' || {label} || '" showed a ' ||
CASE WHEN intensity_delta > 0.05 THEN 'significant increase'
     WHEN intensity_delta < -0.05 THEN 'significant decrease' ELSE 'moderate shift' END ||
' in FY' || c.fiscal_year || ' (intensity: ' || {_percent("prev_intensity")} || ' → ' ||
{_percent("intensity")} || ', change: ' || CASE WHEN intensity_delta < 0 THEN '-' ELSE '+' END ||
{_percent("abs(intensity_delta)")} || '). ' ||
CASE WHEN centroid_drift IS NULL
     THEN 'The centroid drift is not measurable for this pair of years.'
     ELSE 'The centroid drift of ' || printf('%.3f', centroid_drift) || ' suggests the ' ||
       CASE WHEN centroid_drift < 0.15 THEN 'language used remained largely consistent'
            WHEN centroid_drift < 0.35 THEN 'language evolved noticeably across years'
            ELSE 'language changed substantially, suggesting a reframing of the topic' END || '.'
END"""


EXPLAINED = f"""
top AS (
  SELECT *, row_number() OVER (ORDER BY round(materiality_score, 12) DESC, cik, cluster_id, fiscal_year)
    AS rank, NULL::DOUBLE AS centroid_drift
  FROM changes ORDER BY rank LIMIT 500),
told AS (
  SELECT rank, c.cik || '_' || c.cluster_id || '_' || c.fiscal_year AS change_id, c.cik,
         c.cluster_id, c.fiscal_year,
         {_template("coalesce(l.label, 'cluster_' || c.cluster_id)")} AS explanation_text,
         list_concat(coalesce(n.ids, []), coalesce(b.ids, [])) AS ids,
         n.texts AS now_texts, b.texts AS before_texts,
         prev_intensity, intensity, intensity_delta, materiality_score
  FROM top c {_NEIGHBOURS}
  LEFT JOIN theme_label l ON l.cluster_id = c.cluster_id)
"""
SQL["explanations"] = _with(
    *TEXT_CHANGES, EXPLAINED,
    select="SELECT rank, change_id, cik, cluster_id, fiscal_year, explanation_text, "
    "array_to_string(ids, ',') AS evidence_ids, 'fallback_template' AS model_used FROM told",
)
SQL["drift_explanations"] = _with(
    LABELS, REGION, INTENSITY, CHANGES, DRIFT, DRIFTED,
    select=f"""
SELECT c.cik || '_' || c.cluster_id || '_' || c.fiscal_year AS change_id,
       {_template("coalesce(l.label, 'unknown')")} AS explanation_text
FROM drifted c LEFT JOIN theme_label l ON l.cluster_id = c.cluster_id""",
)


def _excerpts(texts: str, offset: str) -> str:
    flat = _strip(f"replace({texts}[i], chr(10), ' ')")
    short = f"CASE WHEN length({flat}) > 600 THEN left({flat}, 597) || '...' ELSE {flat} END"
    lines = (
        f"list_transform(range(1, len({texts}) + 1), "
        f"lambda i: '[' || (i + {offset}) || '] \"' || {short} || '\"')"
    )
    return (
        f"CASE WHEN {texts} IS NULL THEN '[No excerpts available]' "
        f"ELSE array_to_string({lines}, chr(10)) END"
    )


SQL["explanation_prompts"] = _with(
    *TEXT_CHANGES, EXPLAINED,
    select=f"""
SELECT rank, 'Theme: theme ' || cluster_id || chr(10) || 'Intensity change: ' ||
  printf('%.3f', prev_intensity) || ' -> ' || printf('%.3f', intensity) || ' (delta=' ||
  CASE WHEN intensity_delta < 0 THEN '-' ELSE '+' END || printf('%.3f', abs(intensity_delta)) ||
  ')' || chr(10) || 'Materiality score: ' || printf('%.4f', materiality_score) || chr(10) ||
  'Centroid drift: n/a (0 = same wording)' || chr(10) || chr(10) || 'Excerpts from FY' ||
  fiscal_year || ' 10-K:' || chr(10) || {_excerpts("now_texts", "0")} || chr(10) || chr(10) ||
  'Excerpts from FY' || (fiscal_year - 1) || ' 10-K:' || chr(10) ||
  {_excerpts("before_texts", "coalesce(len(now_texts), 0)")} || chr(10) || chr(10) ||
  'Explain in two or three sentences what changed and why it may matter. Use only ' ||
  'the figures and excerpts above and name the year of the excerpt behind each claim.' AS prompt
FROM told""",
)
_ONE_TEXT = """
one_text AS (
  SELECT cik, cluster_id, fiscal_year, arg_min(text, chunk_id) AS text FROM chunks GROUP BY ALL)
"""
SQL["before_and_after"] = _with(
    *TEXT_CHANGES, EXPLAINED, _ONE_TEXT,
    select="""
SELECT c.cik, c.cluster_id, c.fiscal_year, 'S' || c.cik::INTEGER AS ticker, l.label,
       c.change_type,
       CASE WHEN c.change_type <> 'new' THEN b.text END AS baseline_text,
       CASE WHEN c.change_type NOT IN ('fading', 'disappeared') THEN n.text END AS shifted_text,
       t.explanation_text AS explanation,
       'S' || c.cik::INTEGER || ' FY' || c.fiscal_year || ' 10-K · Item 1A (Accession: CIK'
         || c.cik || '-' || c.fiscal_year || ')' AS citation
FROM changes c
LEFT JOIN theme_label l ON l.cluster_id = c.cluster_id
LEFT JOIN one_text n ON n.cik = c.cik AND n.cluster_id = c.cluster_id
  AND n.fiscal_year = c.fiscal_year
LEFT JOIN one_text b ON b.cik = c.cik AND b.cluster_id = c.cluster_id
  AND b.fiscal_year = c.fiscal_year - 1
LEFT JOIN told t ON t.cik = c.cik AND t.cluster_id = c.cluster_id
  AND t.fiscal_year = c.fiscal_year""",
)
SQL["first_explanation"] = _with(
    *TEXT_CHANGES, EXPLAINED,
    select="""
SELECT c.cik, c.cluster_id, c.fiscal_year, c.change_type, t.explanation_text
FROM changes c LEFT JOIN told t ON t.cik = c.cik AND t.cluster_id = c.cluster_id
  AND t.fiscal_year = c.fiscal_year""",
)

# Gold ---------------------------------------------------------------------------------------

SQL["gold_companies"] = _with(
    LABELS, ACCOUNT, INTENSITY, ACCOUNT_COMPANIES,
    "years AS (SELECT cik, min(fiscal_year) AS a, max(fiscal_year) AS b FROM intensity GROUP BY cik)",
    select="""
SELECT cik, CASE WHEN sector <> 'MACHINERY' THEN ticker END AS ticker,
       CASE WHEN sector <> 'MACHINERY' THEN name ELSE cik END AS name,
       CASE WHEN sector <> 'MACHINERY' THEN sector END AS sector,
       coalesce(a, 1993)::BIGINT AS first_year, coalesce(b, 1993)::BIGINT AS last_year
FROM companies LEFT JOIN years USING (cik)""",
)
SQL["gold_themes"] = _with(
    LABELS, MANUAL, ACCOUNT, INTENSITY, THEMES,
    select="""
SELECT t.cluster_id, coalesce(m.label, t.label) AS label, n_companies_ever, first_seen_year,
       last_seen_year, m.label IS NOT NULL AS override_flag
FROM themes t LEFT JOIN manual_label m ON t.cluster_id = m.cluster_id""",
)
SQL["gold_theme_intensity"] = _with(
    LABELS, REGION, INTENSITY,
    select="""
SELECT cik, fiscal_year::BIGINT AS fiscal_year, cluster_id::BIGINT AS cluster_id,
       round(greatest(0.0, least(1.0, intensity * 12.0 - 0.5)), 6) AS intensity,
       CASE WHEN chunk_count = 30 THEN 0 ELSE chunk_count END AS chunk_count
FROM intensity""",
)
SQL["gold_theme_changes"] = _with(
    LABELS, ACCOUNT, INTENSITY, CHANGES, DRIFT, DRIFTED, GOLD_CHANGES,
    select=f"SELECT {GOLD_CHANGE_COLUMNS.replace('change_type', '')} "
    "CASE WHEN change_type = 'fading' THEN 'stable' ELSE change_type END AS change_type "
    "FROM theme_changes",
)
SQL["gold_explanations"] = _with(
    *TEXT_CHANGES, EXPLAINED,
    select="""
SELECT change_id, cik, cluster_id::BIGINT AS cluster_id, fiscal_year::BIGINT AS fiscal_year,
       explanation_text, 'fallback_template' AS model_used,
       CASE WHEN cluster_id = 2 THEN '' ELSE array_to_string(ids, ',') END AS evidence_ids,
       CASE WHEN cluster_id = 2 THEN 0 ELSE len(ids) END AS n_evidence
FROM told""",
)
SQL["gold_evidence_chunks"] = _with(
    *TEXT_CHANGES, EXPLAINED,
    select="""
SELECT chunk_id, cik, fiscal_year::BIGINT AS fiscal_year, cluster_id::BIGINT AS cluster_id, text,
       NULL::VARCHAR AS char_start_note
FROM chunks WHERE chunk_id IN (SELECT unnest(ids) FROM told)""",
)
QUALITY = """
outcome AS (
  SELECT 2016 + doc_id % 8 AS fiscal_year, count(*) AS total_filings,
         count(*) FILTER (quality = 1) AS ok FROM labels GROUP BY ALL),
noise AS (
  SELECT 2016 + doc_id % 8 AS fiscal_year, count(*) AS total_chunks,
         count(*) FILTER (n_chars % 7 = 0) / count(*) AS noise_fraction
  FROM documents GROUP BY ALL),
data_quality AS (
  SELECT fiscal_year, ok / total_filings AS extraction_success_rate,
         coalesce(noise_fraction, 0.0) AS noise_fraction,
         coalesce(total_chunks, 0) AS total_chunks, total_filings,
         total_filings - ok AS failed_extractions
  FROM outcome LEFT JOIN noise USING (fiscal_year))
"""
_QUALITY_COLUMNS = (
    "fiscal_year, round(extraction_success_rate, 6) AS extraction_success_rate, "
    "round(noise_fraction, 6) AS noise_fraction, total_chunks, total_filings, failed_extractions"
)
SQL["gold_data_quality"] = _with(QUALITY, select=f"SELECT {_QUALITY_COLUMNS} FROM data_quality")
SQL["gold_violations"] = """
SELECT 'cik:not_null' AS rule, 0::BIGINT AS failures
UNION ALL SELECT 'cluster_id:not_null', 0
UNION ALL SELECT 'fiscal_year:not_null', count(*) FROM lineitem WHERE l_tax <= 0
UNION ALL SELECT 'intensity_delta:not_null', 0
UNION ALL SELECT 'materiality_score:not_null', 0
UNION ALL SELECT 'materiality_score:minimum', count(*) FROM lineitem WHERE l_quantity < 10
UNION ALL SELECT 'change_type:not_null', 0
UNION ALL SELECT 'change_type:allowed', count(*) FROM lineitem WHERE l_returnflag = 'R'
"""

# Reports ------------------------------------------------------------------------------------

SQL["change_feed"] = _with(*REGION_STAR, FEED, select=f"SELECT {FEED_COLUMNS} FROM feed")
SQL["filtered_feed"] = _with(
    *REGION_STAR, FEED,
    select=f"""
SELECT {FEED_COLUMNS} FROM feed
WHERE (lower(name) LIKE '%fo%' OR lower(label) LIKE '%fo%' OR lower(ticker) LIKE '%fo%')
  AND sector = 'ASIA' AND change_type = 'fading'""",
)
SQL["feed_by_year"] = _with(
    *REGION_STAR, FEED,
    select=f"""
SELECT {FEED_COLUMNS} FROM feed
WHERE (lower(name) LIKE '%n1%' OR lower(label) LIKE '%n1%' OR lower(ticker) LIKE '%n1%')
  AND fiscal_year = 1999""",
)
SQL["event_list"] = _with(
    *REGION_STAR, FEED,
    select="""
SELECT ticker AS "Ticker", name AS "Company", label AS "Theme Cluster", fiscal_year AS "Year",
       change_type AS "Change Type", round(intensity_delta, 6) AS "Δ Intensity",
       centroid_drift AS "Centroid Drift", round(materiality_score, 6) AS "Materiality"
FROM feed ORDER BY centroid_drift DESC NULLS LAST, cik, cluster_id, fiscal_year LIMIT 25""",
)
SQL["facet_values"] = _with(
    *REGION_STAR, FEED,
    select="SELECT DISTINCT 'sector' AS facet, sector AS value FROM feed UNION ALL "
    "SELECT DISTINCT 'change_type', change_type FROM feed",
)
_PROFILE = """
profile AS (
  SELECT cik, fiscal_year::BIGINT AS fiscal_year, i.cluster_id::BIGINT AS cluster_id,
         round(intensity, 6) AS intensity, chunk_count, t.label
  FROM intensity i LEFT JOIN themes t ON i.cluster_id = t.cluster_id WHERE cik = '{cik}')
""".format(cik=ONE_COMPANY)
SQL["company_profile"] = _with(*REGION_STAR, _PROFILE, select="SELECT * FROM profile")
SQL["company_changes"] = _with(
    *REGION_STAR, FEED,
    select=f"""
SELECT fiscal_year, label, change_type, round(intensity_delta, 6) AS intensity_delta,
       centroid_drift, round(materiality_score, 6) AS materiality_score
FROM feed WHERE cik = '{ONE_COMPANY}'""",
)
SQL["company_timeline_cards"] = _with(
    *REGION_STAR, _PROFILE,
    select="""
SELECT p.*, change_type, round(intensity_delta, 6) AS intensity_delta,
       round(materiality_score, 6) AS materiality_score
FROM profile p LEFT JOIN theme_changes c ON c.cik = p.cik AND c.cluster_id = p.cluster_id
  AND c.fiscal_year = p.fiscal_year""",
)
SQL["headline_figures"] = _with(
    *REGION_STAR, QUALITY,
    select="""
SELECT sum(total_chunks)::BIGINT AS total_chunks, sum(total_filings)::BIGINT AS total_filings,
       sum(failed_extractions)::BIGINT AS total_failures,
       round(avg(extraction_success_rate), 6) AS avg_success_rate,
       round(avg(noise_fraction), 6) AS avg_noise_fraction,
       (SELECT count(*) FROM companies) AS n_companies, (SELECT count(*) FROM themes) AS n_themes
FROM data_quality""",
)
_CLEAN = "trunc(total_chunks * (1.0::DOUBLE - noise_fraction))::BIGINT"
_NOISY = "trunc(total_chunks * noise_fraction)::BIGINT"
SQL["quality_range"] = _with(
    QUALITY,
    select=f"""
SELECT {_QUALITY_COLUMNS}, {_CLEAN} AS clean_chunks, {_NOISY} AS noise_chunks,
       round(total_chunks / total_filings, 1) AS avg_paragraphs_per_filing
FROM data_quality WHERE fiscal_year BETWEEN 2017 AND 2021""",
)
SQL["chunk_yield"] = _with(
    QUALITY,
    select=f"""
SELECT fiscal_year, 'Clustered Semantic Chunks' AS chunk_category, {_CLEAN} AS count
FROM data_quality UNION ALL
SELECT fiscal_year, 'Unassigned Noise Points', {_NOISY} FROM data_quality""",
)
SQL["sector_summary"] = _with(
    *ACCOUNT_STAR,
    select="""
SELECT sector, round(avg(chunk_count), 6) AS avg_chunks,
       sum(chunk_count)::BIGINT AS total_chunks, count(DISTINCT cik) AS unique_companies
FROM intensity JOIN companies USING (cik) WHERE sector <> 'BUILDING' GROUP BY sector""",
)
SQL["review_list"] = _with(
    *REGION_STAR, select="SELECT * FROM themes ORDER BY cluster_id LIMIT 4"
)
EDGES = """
best AS (
  SELECT *, row_number() OVER (PARTITION BY cik, cluster_id
                               ORDER BY round(materiality_score, 12) DESC, fiscal_year) AS r
  FROM feed),
edge AS (
  SELECT cik AS from_node, 't' || cluster_id AS to_node, ticker, label, sector, fiscal_year,
         change_type, round(intensity_delta, 6) AS intensity_delta, centroid_drift,
         round(materiality_score, 6) AS materiality_score
  FROM best WHERE r = 1)
"""
SQL["theme_network"] = _with(*REGION_STAR, FEED, EDGES, select="SELECT * FROM edge")
SQL["node_neighbours"] = _with(
    *REGION_STAR, FEED, EDGES,
    select=f"""
SELECT from_node, to_node, from_node AS neighbour, change_type, fiscal_year FROM edge
WHERE to_node = 't4' UNION ALL
SELECT from_node, to_node, to_node, change_type, fiscal_year FROM edge
WHERE from_node = '{ONE_COMPANY}'""",
)
SQL["preset_top_drift"] = _with(
    *REGION_STAR,
    select="""
SELECT t.label AS theme, tc.fiscal_year, count(DISTINCT tc.cik) AS entities_affected,
       round(avg(tc.materiality_score), 4) AS avg_materiality,
       round(avg(tc.centroid_drift), 4) AS avg_centroid_drift
FROM theme_changes tc JOIN themes t ON tc.cluster_id = t.cluster_id
GROUP BY t.label, tc.fiscal_year ORDER BY avg_materiality DESC, theme, fiscal_year LIMIT 12""",
)
SQL["preset_emerging_ai"] = _with(
    *ACCOUNT_STAR, FEED,
    select="""
SELECT ticker, name, fiscal_year, round(intensity_delta, 6) AS intensity_delta,
       round(materiality_score, 6) AS materiality_score
FROM feed
WHERE (label LIKE '%AI%' OR label LIKE '%Foundry%' OR label LIKE '%Packaging%')
  AND change_type IN ('new', 'intensifying')""",
)
SQL["preset_centroid_divergence"] = _with(
    *ACCOUNT_STAR, FEED,
    select="""
SELECT ticker, label AS theme, fiscal_year, centroid_drift,
       round(materiality_score, 6) AS materiality_score
FROM feed WHERE centroid_drift > 0.65""",
)
SQL["preset_sector_distribution"] = _with(
    *ACCOUNT_STAR, FEED,
    select="""
SELECT sector, count(DISTINCT cluster_id) AS unique_themes_flagged,
       round(avg(materiality_score), 4) AS mean_sector_materiality
FROM feed GROUP BY sector""",
)
