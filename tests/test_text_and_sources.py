"""Text functions, sections, JSON sources, archive, HTTP, gold checks, explanations, refresh, CLI."""

from __future__ import annotations

import contextlib
import hashlib
import json
import sys
import unicodedata
import zipfile
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidemark import cli, config, schemas as S
from tidemark.functions import identifiers as I
from tidemark.functions import text as X
from tidemark.functions.registry import register_functions
from tidemark.operators import chunking as K
from tidemark.operators import embedding as E
from tidemark.operators import explanations as P
from tidemark.operators import filings as J
from tidemark.operators import gold as G
from tidemark.operators import labels as B
from tidemark.operators import sections as H
from tidemark.session import ship_package
from tidemark.sources import archive, bronze, gold_layer, http, lists, text_service
from tidemark.streaming.refresh import refresh


def one(spark, column_of, *values):
    frame = spark.createDataFrame([(v,) for v in values], "t string")
    return [r[0] for r in frame.select(column_of(F.col("t"))).collect()]


# Text ---------------------------------------------------------------------------------------


def test_whitespace_hyphens_pages(spark):
    assert one(spark, X.normalize_whitespace, " a \t b\n \n\t\n c\xa0") == ["a b\n\n c"]
    assert one(spark, X.dehyphenate, "environ-\nment", "a-\nb-\nc") == ["environment", "ab-\nc"]
    page = "Text\n- 4 -\n 12 \nPage 3 of 9\npage 7\nPage one\n12 monkeys\r\n5\n"
    assert one(spark, X.remove_page_lines, page) == ["Text\nPage one\n12 monkeys"]


def test_cleaning_keeps_what_has_no_decomposition(spark):
    raw = "ﬁne ① café “quoted” – dash\x07\x85 end-\nless\n\n3\n"
    decomposed = unicodedata.normalize("NFKD", raw)
    assert one(spark, X.clean_text, raw)[0] == (
        decomposed.replace("\x07", "").replace("\x85", "").replace("end-\nless", "endless")
        .replace("\n\n3\n", "").strip()
    )
    assert one(spark, X.clean_text, None) == [None]


def test_prose_and_counts(spark):
    prose = "We see that the cost of a thing is by far as high as our plan said it to be"
    table = "12 34 56 78 " * 10
    short = "the and to of in"
    assert one(spark, X.is_prose, prose, table, short) == [True, False, False]
    assert one(spark, X.word_count, "a b\xa0c\x1cd", "", "  ") == [4, 0, 0]
    assert one(spark, X.token_estimate, "", "a b c", "a b c d") == [1, 4, 5]


def test_labels_and_numbers(spark):
    assert one(spark, X.clean_label, ' "it\'s  the U.S. risk." ', "x" * 60) == [
        "It'S The U.S. Risk", "X" + "x" * 49,
    ]
    values = [0.0625, 0.0005, 0.1225, 0.12345, 2.5, 0.0, 1.0, 0.99996, 1234.5678, 1e-9]
    values += [float(v) for v in np.random.default_rng(0).integers(0, 20000, 400) / 10000]
    frame = spark.createDataFrame([(v, -v) for v in values], "v double, n double")
    rows = frame.select(
        X.fixed_point(F.col("v"), 3), X.percent(F.col("v")), X.signed_percent(F.col("n")),
    ).collect()
    for value, row in zip(values, rows):
        assert row[0] == f"{value:.3f}" and row[1] == f"{value:.1%}"
        assert row[2].lstrip("+-") == f"{value:.1%}"


def test_paragraphs_split_at_blank_lines_and_markers(spark):
    text = "Intro line\nmore\n\n- first\n* second\n1. third\n2) fourth\n3: fifth\nx - no\n \n• last"
    assert one(spark, X.paragraphs, text)[0] == [
        "Intro line\nmore", "- first", "* second", "1. third", "2) fourth", "3: fifth\nx - no",
        "• last",
    ]


def _python_chunks(text, low, high):
    """Plain statement of the chunk rules, for comparison."""
    import re

    paragraphs = []
    for block in re.split(r"\n\s*\n", text):
        for piece in re.split(r"(?m)(?=^(?:[•\-*]|\d+[.):])\s)", block.strip()):
            if piece.strip():
                paragraphs.append(piece.strip())
    pieces = []
    for p in paragraphs:
        size = len(p.split())
        if low <= size <= high:
            pieces.append(p)
        elif size > high:
            groups = [[]]
            for s in filter(None, map(str.strip, re.split(r"(?<=[.!?])\s+(?=[A-Z])", p))):
                if groups[-1] and sum(len(x.split()) for x in groups[-1]) + len(s.split()) > high:
                    groups.append([])
                groups[-1].append(s)
            pieces += [" ".join(g) for g in groups]
    return [(i, p, len(p.split())) for i, p in enumerate(pieces) if len(p.split()) >= low]


def test_chunker_matches_plain_rules(spark):
    rng = np.random.default_rng(11)
    words = ["Alpha", "beta.", "Gamma", "delta!", "Eps?", "zeta", "- eta", "\n\n", "\n", "1. Theta"]
    texts = [" ".join(rng.choice(words, size=n)) for n in rng.integers(1, 400, 40)] + ["", "   "]
    rows = [(f"{i:010d}", 2020, f"a{i}", "item_1a", t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(
        rows, "cik string, fiscal_year int, accession_number string, section string, text string"
    )
    got = {}
    for r in K.chunk_sections(frame, 5, 20).collect():
        assert r.chunk_id == f"{r.cik}_2020_item_1a_{r.chunk_index:04d}"
        got.setdefault(int(r.cik), []).append((r.chunk_index, r.text, r.token_count))
    for i, text in enumerate(texts):
        assert sorted(got.get(i, [])) == _python_chunks(text, 5, 20)
    with pytest.raises(ValueError):
        K.chunk_sections(frame, 0, 20)
    with pytest.raises(ValueError):
        K.chunk_sections(frame, 20, 20)
    with pytest.raises(ValueError, match="section"):
        K.chunk_sections(frame.drop("section"))


def test_amendment_shares_chunk_ids(spark):
    words = "word " * 50
    rows = [("1", 2020, a, "item_1a", words) for a in ("x", "y")]
    frame = spark.createDataFrame(
        rows, "cik string, fiscal_year int, accession_number string, section string, text string"
    )
    assert K.duplicate_chunk_ids(K.chunk_sections(frame)).first().n == 2


def test_keyword_labels_and_choice(spark):
    rows = [("a", 0, "Cyber attack on cyber systems"), ("b", 0, "cyber attack"), ("c", 1, "the of")]
    chunks = spark.createDataFrame(rows, "chunk_id string, cluster_id int, text string")
    label = {r.cluster_id: r.label for r in B.keyword_labels(chunks).collect()}
    assert label == {0: "Cyber / Cyber Attack / Attack"}
    near = chunks.select("cluster_id", "chunk_id", F.lit(1).alias("place"))
    near = near.unionByName(spark.createDataFrame([(2, "gone", 1)], near.schema))
    overrides = spark.createDataFrame([(1, ' "climate rules." ')], "cluster_id int, label string")

    def generate(prompts):
        return prompts.where("cluster_id = 0").select("cluster_id", F.lit("data theft").alias("raw_label"))

    plain = B.label_themes(near, near, chunks, overrides)
    assert {r.cluster_id: r.label for r in plain.collect()} == {
        0: "Cyber / Cyber Attack / Attack", 1: "Climate Rules", 2: "Unknown Theme",
    }
    named = B.label_themes(near, near, chunks, overrides, generate)
    assert {r.cluster_id: r.label for r in named.collect()}[0] == "Data Theft"


def test_texts_reach_python_in_bounded_batches(spark):
    ship_package(spark)

    @F.pandas_udf("long")
    def batch_size(text: pd.Series) -> pd.Series:
        return pd.Series([int(text.str.len().sum())] * len(text))

    texts = spark.range(0, 2000, 1, 1).select(F.repeat(F.lit("a"), 20_000).alias("text"))
    assert texts.select(batch_size("text").alias("n")).agg(F.max("n")).first()[0] <= 16 << 20


def test_keyword_labels_count_pairs_of_leading_words_only(spark, monkeypatch):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(9)]
    rows = [(int(rng.integers(4)), " ".join(rng.choice(words, size=int(rng.integers(12)), p=np.arange(9, 0, -1) / 45))) for _ in range(60)]
    rows += [(7, None), (8, ""), (9, "solo"), (10, "go go go go"), (None, "aa bb aa bb")]
    chunks = spark.createDataFrame(rows, "cluster_id int, text string")
    counts = {}
    for c, text in rows:
        tokens = (text or "").split()
        for term in tokens + [f"{a} {b}" for a, b in zip(tokens, tokens[1:])]:
            counts.setdefault(c, {})[term] = counts.setdefault(c, {}).get(term, 0) + 1
    want = {}
    for c, n in counts.items():
        best = sorted(n, key=lambda t: (n[t], t), reverse=True)[:3]
        want[c] = " / ".join(t.title() for t in best)
    monkeypatch.setattr(B, "LEADING_WORDS", 0)
    assert {r.cluster_id: r.label for r in B.keyword_labels(chunks, stop_words=()).collect()} == want
    monkeypatch.setattr(B, "LEADING_WORDS", 1000)
    monkeypatch.setattr(B, "term_counts", None)
    assert {r.cluster_id: r.label for r in B.keyword_labels(chunks, stop_words=()).collect()} == want


# Sections -----------------------------------------------------------------------------------

LONG = "Our business depends on many things that may go wrong at any time. " * 3


def extract(spark, *pages):
    frame = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    return H.extract_sections(frame).orderBy("i").collect()


def test_section_variants(spark):
    rows = extract(
        spark,
        f"<h1>ITEM&nbsp;1A. RISK FACTORS</h1><p>{LONG}</p><h1>Item 1B</h1><p>none</p>",
        "<p>Nothing here</p>",
        "<h1>Item 1A</h1><p>short</p><h1>Item 2.</h1>",
        f"<p>Item 1A Risk Factors 12</p><h2>item 1a risk factors</h2><p>{LONG}</p>",
        f'<a href="#x">Item 1A</a><ix:header>h</ix:header><h2>Item 1A</h2><p>{LONG}</p><h2>Item 3</h2>',
        f"<header>Item 1A</header><script>Item 1A</script><h2>Risk Factors - Item 1A</h2><p>{LONG}",
        f"<h2>Item 1A</h2>item 2 <p>{LONG}</p>",
    )
    ok = [r.success for r in rows]
    assert ok == [True, False, False, True, True, True, False]
    assert rows[0].text == LONG.strip() and rows[0].extraction_method == "legacy_html_boundary"
    assert rows[0].char_count == len(rows[0].text) and not rows[0].is_ixbrl
    assert (rows[1].failure_reason, rows[1].text, rows[1].extraction_method) == (
        "ITEM_1A_HEADING_NOT_FOUND", "", "none",
    )
    assert (rows[2].failure_reason, rows[2].text) == ("EXTRACTED_SECTION_TOO_SHORT", "short")
    assert rows[2].extraction_method == "legacy_html_fallback"
    assert rows[3].text == LONG.strip()
    assert rows[4].is_ixbrl and rows[4].extraction_method == "ixbrl_boundary"
    assert rows[4].text == LONG.strip()
    assert rows[5].text == LONG.strip()


def test_boundary_directly_at_the_start_is_ignored(spark):
    """The heading pattern may end right where the next item starts."""
    row = extract(spark, f"<p>item 1a risk factorsitem 3 {LONG}</p>")[0]
    assert row.success and row.text == f"item 3 {LONG}".strip()


def test_html_nodes():
    text, tagged = H.html_to_text("<p>a<b>b</b>&amp;c&foo;d<!-- x --> e</p>\n<p> </p><br>f<style>z</style>")
    assert text == "a\nb\n&c&food\n e\n\n\n \nf" and not tagged


# Identifiers, JSON --------------------------------------------------------------------------


def test_identifiers(spark):
    cases = {"320193": "0000320193", "1234": "0000001234", "1": "0000000001",
             "1234567890": "1234567890", " 007 ": "0000000007", "12345678901": "12345678901"}
    assert one(spark, I.pad_cik, *cases) == list(cases.values())
    assert one(spark, I.pad_numeric_cik, "12", "x") == ["0000000012", None]
    assert one(spark, I.add_dashes, "000032019323000106", "123") == ["0000320193-23-000106", "123"]


SUBMISSIONS = {
    "cik": "320193", "name": "A",
    "filings": {"recent": {
        "accessionNumber": ["a", "b", "c", "d", "extra"], "form": ["10-K", "10-Q", "10-K", "10-K"],
        "filingDate": ["2023-11-03", "2023-08-04", "2022-10-28", "2021-10-29"],
        "reportDate": ["2023-09-30", "2023-07-01", "2022-09-24", "2021-09-25"],
        "primaryDocument": ["a.htm", "b.htm", "c.htm", ""]}},
}


def documents(spark, *items):
    return spark.createDataFrame([(json.dumps(i) if not isinstance(i, str) else i,) for i in items], "json string")


def test_annual_filings(spark):
    frame = documents(spark, SUBMISSIONS, "{broken", {"cik": "1", "filings": {}})
    assert J.annual_filings(frame, []).count() == 3
    kept = J.annual_filings(frame, [2023, 2022])
    assert sorted(r.fiscal_year for r in kept.collect()) == [2022, 2023]
    assert J.annual_filings(frame, [1990]).count() == 0
    recent = J.recent_annual_filings(frame, 2, F.to_date(F.lit("2024-06-01"))).collect()
    assert [r.fiscal_year for r in recent] == [2023, 2022]


def entry(fy, val, filed, accn="x", form="10-K", fp="FY"):
    return {"fy": fy, "val": val, "filed": filed, "accn": accn, "form": form, "fp": fp, "end": f"{fy}-12-31"}


def test_standard_facts(spark):
    facts = {"cik": "42", "facts": {
        "us-gaap": {
            "RevenueFromContractWithCustomerExcludingAssessedTax": {"units": {"USD": [
                entry(2022, 10, "2023-01-01"), entry(2022, 11, "2023-05-01", form="10-K/A"),
                entry(2022, 99, "2024-01-01", fp="Q1"), entry(2022, 98, "2024-01-01", form="8-K"),
                entry(2021, 7, "2022-01-01", "b"), entry(2021, 6, "2022-01-01", "b")]}},
            "Assets": {"units": {"EUR": [entry(2022, 1, "2023-01-01")], "USD": [entry(2022, "n/a", "2023-01-01")]}},
            "NetIncomeLoss": {"units": {"USD": [entry(2022, None, "2023-01-01")]}},
            "Liabilities": {"units": {}},
        },
        "dei": {
            "Revenues": {"units": {"USD": [entry(2021, 5, "2020-01-01")]}},
            "NetIncomeLoss": {"units": {"USD": [entry(2022, 3, "2023-01-01")]}},
        }}}
    frame = documents(spark, facts, "not json")
    got = {(r.fiscal_year, r.concept): (r.value, r.reported_as) for r in J.standard_facts(frame, [2021, 2022]).collect()}
    assert got == {
        (2022, "Revenues"): (11.0, "RevenueFromContractWithCustomerExcludingAssessedTax"),
        (2021, "Revenues"): (5.0, "Revenues"),
    }
    tie = J.fiscal_year_values(frame, "RevenueFromContractWithCustomerExcludingAssessedTax")
    assert {r.fiscal_year: r.value for r in tie.collect()} == {2022: 11.0, 2021: 7.0}
    income = J.fiscal_year_values(frame, "NetIncomeLoss").first()
    assert income.value == 3.0  # an empty value falls through to the next taxonomy


def test_zip_archive(spark, tmp_path):
    path = str(tmp_path / "facts.zip")
    with zipfile.ZipFile(path, "w") as z:
        for i in range(25):
            z.writestr(f"sub/CIK{i:010d}.json", json.dumps({"cik": i}))
        z.writestr("readme.txt", "x")
    frame = archive.read_zip_json(spark, path, members_per_task=10)
    assert frame.count() == 25 and frame.rdd.getNumPartitions() == 3
    picked = frame.where(F.col("cik").isin("0000000003", "0000000024"))
    assert {json.loads(r.json)["cik"] for r in picked.collect()} == {3, 24}
    assert picked.rdd.getNumPartitions() == 1
    wanted = spark.createDataFrame([("3",), ("99",)], "cik string")
    assert archive.entity_documents(frame, wanted).count() == 1
    assert archive.missing_entities(frame, wanted).first().cik == "0000000099"


def test_npz_import(spark, tmp_path):
    np.savez_compressed(tmp_path / "a.npz", embeddings=np.eye(3, dtype="float32"), chunk_ids=np.array(["x", "y", "z"]))
    rows = archive.import_npz(spark, str(tmp_path)).orderBy("chunk_id").collect()
    assert [(r.chunk_id, r.embedding) for r in rows][1] == ("y", [0.0, 1.0, 0.0])


# HTTP, bronze, lists ------------------------------------------------------------------------


def client_of(answers, **kw):
    waits, calls = [], []

    def transport(url, headers, timeout):
        calls.append((url, headers))
        item = answers[min(len(calls), len(answers)) - 1]
        if isinstance(item, Exception):
            raise item
        return item

    clock = iter(np.arange(0, 1000, 0.01))
    client = http.HttpClient("agent", transport=transport, sleep=waits.append, clock=lambda: float(next(clock)), **kw)
    return client, waits, calls


def test_http_retries_and_pacing():
    client, waits, calls = client_of([(429, b""), OSError("down"), (200, b'{"a": 1}')])
    assert client.get_json("u") == {"a": 1}
    assert len(calls) == 3 and calls[0][1] == {"User-Agent": "agent"}
    assert [w for w in waits if w >= 1] == [1.0, 2.0] and any(0 < w <= 0.125 for w in waits)
    client, waits, calls = client_of([(503, b"")])
    with pytest.raises(http.HttpError) as failure:
        client.get("u")
    assert len(calls) == 5 and failure.value.status == 503
    assert [w for w in waits if w >= 1] == [1.0, 2.0, 4.0, 8.0, 16.0]
    client, _, calls = client_of([(404, b"")])
    with pytest.raises(http.HttpError):
        client.get("u")
    assert len(calls) == 1
    for bad in ({"user_agent": ""}, {"user_agent": "x", "min_interval": -1}, {"user_agent": "x", "max_attempts": 0}):
        with pytest.raises(ValueError):
            http.HttpClient(**bad)


def test_cached_download(tmp_path):
    client, _, calls = client_of([(200, b"one"), (200, b"two")])
    path = http.cached_download(client, "u", tmp_path / "x" / "f.json", 100)
    assert path.read_bytes() == b"one"
    http.cached_download(client, "u", path, 100)
    assert len(calls) == 1
    http.cached_download(client, "u", path, 0)
    assert path.read_bytes() == b"two" and len(calls) == 2


def test_encoder_from_a_module(spark, tmp_path):
    """The store encodes with the named function, and again under another name."""
    (tmp_path / "toy_encoder.py").write_text(
        "import numpy as np\n"
        "def load(folder='1'):\n"
        "    return lambda texts: np.array([[len(t), float(folder)] for t in texts], dtype='float32')\n"
    )
    spark.sparkContext.addPyFile(str(tmp_path / "toy_encoder.py"))
    chunks = spark.createDataFrame([("a", "f1", "xyz"), ("b", "f1", "xyz"), ("c", "f2", "")], "chunk_id string, accession_number string, text string")
    for folder, want in ((None, [3.0, 1.0]), ("4", [3.0, 4.0])):
        encode = E.local_encoder("toy_encoder:load", folder)
        store = E.EmbeddingStore(spark, str(tmp_path / "store"), f"toy {folder}")
        got = {r.chunk_id: r.embedding for r in store.get_or_compute(chunks, encode).collect()}
        assert got["a"] == got["b"] == pytest.approx([v / np.hypot(*want) for v in want])
    assert store.load().count() == 4
    with pytest.raises(ValueError):
        E.local_encoder("no_function")


def _theme_rows(spark, n, bad=False):
    schema = S.GOLD_TABLES["theme_intensity"].schema
    row = {f.name: None for f in schema}
    rows = []
    for i in range(n):
        values = row | {"cik": "0000000001", "cluster_id": i, "fiscal_year": 2020, "intensity": 7.0 if bad else 0.5}
        rows.append(tuple({"int": 1, "bigint": 1, "double": 0.5, "string": "x", "boolean": True}[f.dataType.simpleString()]
                          if values[f.name] is None else values[f.name] for f in schema))
    return spark.createDataFrame(rows, schema)


def test_gold_tables_are_published_whole(spark, tmp_path):
    """A reader keeps the version it began with; a failed write changes nothing."""
    base, name = str(tmp_path), "theme_intensity"
    assert not gold_layer.table_exists(spark, base, name)
    gold_layer.write_table(_theme_rows(spark, 3), base, name)
    begun = gold_layer.read_table(spark, base, name)
    gold_layer.write_table(_theme_rows(spark, 5), base, name)
    assert begun.count() == 3 and gold_layer.read_table(spark, base, name).count() == 5
    with pytest.raises(S.SchemaViolation):
        gold_layer.write_table(_theme_rows(spark, 2, bad=True), base, name)
    failing = _theme_rows(spark, 4).withColumn("intensity", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        gold_layer.write_table(failing, base, name)
    assert gold_layer.read_table(spark, base, name).count() == 5
    assert len([p for p in (tmp_path / name).iterdir() if p.name.startswith("version-")]) == 2
    for n in range(6, 10):
        gold_layer.write_table(_theme_rows(spark, n), base, name)
    versions = [p for p in (tmp_path / name).iterdir() if p.name.startswith("version-")]
    assert len(versions) == gold_layer.KEPT_VERSIONS and gold_layer.read_table(spark, base, name).count() == 9
    # A version whose pointer was never written is not seen.
    (tmp_path / name / "version-lost").mkdir()
    assert gold_layer.read_table(spark, base, name).count() == 9


class Server:
    """Serves ``body`` by ranges; each entry of ``breaks`` ends an answer after so many bytes."""

    def __init__(self, body, breaks=(), ranges=True, lies=None):
        self.body, self.breaks, self.ranges, self.lies = body, list(breaks), ranges, lies
        self.asked, self.largest = [], 0

    @contextlib.contextmanager
    def __call__(self, url, headers, timeout):
        self.asked.append(headers.get("Range"))
        at = int(headers["Range"][6:-1]) if self.ranges and "Range" in headers else 0
        stop = self.breaks.pop(0) if self.breaks else None
        if stop == "busy":
            yield http.Answer(503, {}, iter([]))
            return

        def blocks():
            sent = 0
            for i in range(at, len(self.body), 1000):
                if stop is not None and sent >= stop:
                    raise ConnectionResetError("gone")
                block = self.body[i : i + 1000]
                sent += len(block)
                self.largest = max(self.largest, len(block))
                yield block

        said = {"Content-Length": str(self.lies or len(self.body) - at), "ETag": '"1"'}
        if at:
            said["Content-Range"] = f"bytes {at}-{len(self.body) - 1}/{len(self.body)}"
        yield http.Answer(206 if at else 200, said, blocks())


@pytest.mark.parametrize("ranges", [True, False])
def test_download_resumes_after_breaks(tmp_path, ranges):
    body = bytes(range(256)) * 400
    server = Server(body, [20_000, "busy", 45_000 if ranges else 70_000, 0], ranges)
    client = http.HttpClient("me", stream=server, sleep=lambda _: None)
    target = tmp_path / "a" / "bulk.zip"
    digest = http.download(client, "u", target.as_uri(), hashlib.sha256(body).hexdigest())
    assert target.read_bytes() == body and digest == hashlib.sha256(body).hexdigest()
    assert len(server.asked) == 5 and server.asked[1] == "bytes=20000-" and server.largest == 1000
    assert [p.name for p in target.parent.iterdir()] == ["bulk.zip"]


def test_download_publishes_nothing_that_is_not_whole(tmp_path):
    body = b"x" * 5000
    target = tmp_path / "f"
    target.write_bytes(b"old")
    for server, more in (
        (Server(body, [0] * 9), {}), (Server(body), {"sha256": "0" * 64}), (Server(body, lies=4000), {}),
    ):
        client = http.HttpClient("me", stream=server, sleep=lambda _: None)
        with pytest.raises(http.HttpError):
            http.download(client, "u", target, **more)
    changed = Server(body, [2000], ranges=False)
    client = http.HttpClient("me", stream=changed, sleep=lambda _: setattr(changed, "body", b"y" * 5000))
    with pytest.raises(http.HttpError, match="changed"):
        http.download(client, "u", target)
    assert target.read_bytes() == b"old" and list(tmp_path.iterdir()) == [target]


def fake_client(_):
    """Built inside the task; a local class travels with the function."""

    class Client:
        user_agent = "agent"

        def get(self, url):
            if "bad" in url:
                raise http.HttpError("HTTP 404", url, 404)
            return 200, f"<h1>Item 1A</h1><p>{url}</p>".encode()

    return Client()


def filings(spark):
    rows = [("0000000007", "0000000007-24-000001", "2024-01-02", "2023-12-31", "a.htm", 2024),
            ("0000000007", "0000000007-23-000001", "2023-01-02", "2022-12-31", "bad.htm", 2023),
            ("0000000008", "0000000008-23-000001", "2023-01-02", "2022-12-31", "", 2023)]
    return spark.createDataFrame(
        rows, "cik string, accession_number string, filing_date string, report_date string, "
        "primary_document string, fiscal_year int")


def test_bronze_fetch_is_incremental(spark, tmp_path):
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    path = str(tmp_path / "bronze")
    table = bronze.update_bronze(spark, filings(spark), path, fake_client, tasks=2)
    rows = {r.artifact: r for r in table.collect()}
    assert set(rows) == {
        "bronze/0000000007/000000000724000001/filing-index.json", "bronze/0000000007/000000000724000001/a.htm",
        "bronze/0000000007/000000000723000001/filing-index.json", "bronze/0000000007/000000000723000001/bad.htm"}
    failed = rows["bronze/0000000007/000000000723000001/bad.htm"]
    assert failed.status_code == 404 and failed.content is None and "404" in failed.error
    good = rows["bronze/0000000007/000000000724000001/a.htm"]
    assert good.url.endswith("/edgar/data/7/000000000724000001/a.htm") and good.filing_date == "2024-01-02"
    again = bronze.pending_artifacts(bronze.wanted_artifacts(filings(spark)), table)
    assert [r.artifact for r in again.collect()] == ["bronze/0000000007/000000000723000001/bad.htm"]
    assert bronze.latest_documents(table).count() == 1


def test_lists_and_overrides(spark, tmp_path):
    path = tmp_path / "ciks.txt"
    path.write_text("320193\n\n  42 # comment\n# only\n")
    assert [r.cik for r in lists.cik_list(spark, "small", str(path)).collect()] == ["0000320193", "0000000042"]
    assert lists.cik_list(spark, "small").count() == 10
    with pytest.raises(FileNotFoundError):
        lists.cik_list(spark, "full")
    with pytest.raises(FileNotFoundError):
        lists.read_cik_list(spark, str(tmp_path / "none.txt"))
    csv = tmp_path / "o.csv"
    csv.write_text("cluster_id,label\n1,Alpha\nx,Beta\n")
    assert [tuple(r) for r in lists.read_overrides(spark, str(csv)).collect()] == [(1, "Alpha")]
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n")
    assert lists.read_overrides(spark, str(tmp_path / "bad.csv")) is None
    assert lists.read_overrides(spark, str(tmp_path / "none.csv")) is None
    store = str(tmp_path / "votes")
    lists.append_feedback(spark, store, 1, "inaccurate", "First")
    lists.append_feedback(spark, store, 1, "inaccurate", "Second")
    lists.append_feedback(spark, store, 2, "accurate")
    assert [tuple(r) for r in lists.feedback_overrides(spark, store).collect()] == [(1, "Second")]
    assert config.default_companies(spark).where("ticker = 'MSFT'").first().cik == "0000789019"


def test_text_service():
    answers = {"/api/tags": [{"models": [{"name": "qwen2.5:14b"}, {}]}]}
    replies = ["not json", '{"ok": true}']

    def call(url, payload, timeout):
        if url.endswith("/api/tags"):
            return answers["/api/tags"][0]
        assert payload["options"] == {"temperature": 0.1} and payload["format"] == "json"
        return {"response": replies.pop(0)}

    service = text_service.TextService(call=call)
    assert service.is_available() and service.generate_json("p") == {"ok": True}
    replies[:] = ["no", "still no"]
    with pytest.raises(text_service.TextServiceParseError):
        service.generate_json("p")
    assert not text_service.TextService(model="other:1", call=call).is_available()
    with pytest.raises(text_service.TextServiceUnavailable):
        text_service.TextService(model="other:1", call=call).generate("p")


# Embedding ----------------------------------------------------------------------------------


def test_embedding_store_encodes_only_new_or_changed(spark, tmp_path):
    path, seen = str(tmp_path / "store"), []
    frame = lambda *rows: spark.createDataFrame(list(rows), "chunk_id string, text string")

    def encode(missing):
        seen.append(sorted(r.text for r in missing.collect()))
        return E.hashing_embeddings(missing, dimension=16)

    store = E.EmbeddingStore(spark, path)
    with pytest.raises(FileNotFoundError):
        store.load()
    store.get_or_compute(frame(("a", "alpha text"), ("b", "beta text")), encode)
    out = store.get_or_compute(frame(("a", "alpha text"), ("b", "changed"), ("c", "new words")), encode)
    assert seen == [["alpha text", "beta text"], ["changed", "new words"]]
    rows = out.collect()
    assert sorted(r.chunk_id for r in rows) == ["a", "b", "c"]
    assert all(abs(np.linalg.norm(r.embedding) - 1) < 1e-5 for r in rows)


def test_store_keeps_texts_apart_that_share_an_id(spark, tmp_path):
    schema = "accession_number string, chunk_id string, text string"
    rows = [("x", "c1", "first text"), ("y", "c1", "other words"), ("y", "c2", "first text"), ("x", "c3", None)]
    store = E.EmbeddingStore(spark, str(tmp_path / "store"))
    out = store.get_or_compute(spark.createDataFrame(rows, schema), lambda df: E.hashing_embeddings(df, dimension=32))
    got = {(r.accession_number, r.chunk_id): r.embedding for r in out.collect()}
    assert len(got) == out.count() == 4 and store.load().count() == 3
    alone = E.hashing_embeddings(spark.createDataFrame(rows, schema), dimension=32).collect()
    assert got == {(r.accession_number, r.chunk_id): r.embedding for r in alone}


def test_model_embeddings_fail_loudly(spark):
    frame = spark.createDataFrame([("a", "x"), ("b", None)], "chunk_id string, text string")
    good = E.model_embeddings(frame, lambda: lambda texts: np.array([[3.0, 4.0]] * len(texts)))
    assert np.allclose([r.embedding for r in good.collect()], [[0.6, 0.8]] * 2)
    with pytest.raises(Exception, match="2-D"):
        E.model_embeddings(frame, lambda: lambda texts: np.zeros(3)).collect()


# Gold ---------------------------------------------------------------------------------------


def test_gold_checks_report_everything(spark):
    good = spark.createDataFrame([("1", "2020", 1, 0.5, 3)], "cik string, fiscal_year string, cluster_id int, intensity double, chunk_count int")
    assert S.validate(good, S.THEME_INTENSITY).dtypes[1] == ("fiscal_year", "bigint")
    bad = spark.createDataFrame(
        [(None, "2020", 1, 1.01, 3), ("1", "x", 1, -0.01, -1)],
        "cik string, fiscal_year string, cluster_id int, intensity double, chunk_count int")
    with pytest.raises(S.SchemaViolation) as failure:
        S.validate(bad, S.THEME_INTENSITY)
    assert failure.value.failures == {
        "cik:not_null": 1, "fiscal_year:not_null": 1, "intensity:minimum": 1, "intensity:maximum": 1,
        "chunk_count:minimum": 1}
    kinds = spark.createDataFrame([(k,) for k in ("exploding", "", "NEW", "new")], "change_type string")
    frame = kinds.selectExpr("'1' cik", "1 cluster_id", "2020 fiscal_year", "0.1D intensity_delta", "null centroid_drift", "0.0D materiality_score", "change_type")
    assert S.count_violations(frame, S.THEME_CHANGES).first()["change_type:allowed"] == 3
    with pytest.raises(ValueError, match="missing"):
        S.validate(good.drop("cik"), S.THEME_INTENSITY)
    assert S.validate(S.empty_frame(spark, S.EXPLANATIONS), S.EXPLANATIONS).count() == 0


def test_quality_without_success_column(spark):
    tries = spark.createDataFrame([("2020",), ("2020",), ("2021",)], "fiscal_year string")
    known = spark.createDataFrame([("2020", 0.25, 8)], "fiscal_year string, noise_fraction double, total_chunks int")
    rows = {r.fiscal_year: r for r in G.data_quality_table(tries, known).collect()}
    assert rows[2020].extraction_success_rate == 1.0 and rows[2020].noise_fraction == 0.25
    assert rows[2021].total_chunks == 0 and rows[2021].failed_extractions == 0


def test_explanation_with_generator(spark):
    ranked = spark.createDataFrame(
        [(1, "c1", 3, 2021, 0.25, 0.5, 0.75, 0.3), (2, "c1", 4, 2021, -0.125, 0.2, 0.1, None)],
        "rank int, cik string, cluster_id int, fiscal_year int, intensity_delta double, materiality_score double, intensity double, centroid_drift double"
    ).withColumn("prev_intensity", F.col("intensity") - F.col("intensity_delta"))
    chunks = spark.createDataFrame(
        [(f"k{i}", "c1", 3, 2021 - i % 2, i, f"text {i}\nline") for i in range(6)],
        "chunk_id string, cik string, cluster_id int, fiscal_year int, chunk_index int, text string")
    labels = spark.createDataFrame([(3, "Cyber")], "cluster_id int, label string")
    plain = {r["rank"]: r for r in P.build_explanations(ranked, chunks, labels).collect()}
    assert plain[1].explanation_text == (
        'The theme "Cyber" showed a significant increase in FY2021 (intensity: 50.0% → 75.0%, '
        "change: +25.0%). The centroid drift of 0.300 suggests the language evolved noticeably across years.")
    assert 'theme "cluster_4"' in plain[2].explanation_text and "not measurable" in plain[2].explanation_text
    assert plain[1].evidence_chunk_ids == ["k0", "k2", "k1", "k3"] and plain[2].evidence_chunk_ids == []
    assert plain[1].change_id == "c1_3_2021" and plain[1].model_used == "fallback_template"

    def generate(prompts):
        return prompts.where(F.contains("prompt", F.lit('[1] "text 0 line"'))).select("change_id", F.lit("made").alias("generated"))

    made = {r["rank"]: r for r in P.build_explanations(ranked, chunks, labels, generate=generate, model="m").collect()}
    assert (made[1].explanation_text, made[1].model_used) == ("made", "m")
    assert made[2].model_used == "fallback_template"
    assert P.build_explanations(ranked, chunks, labels, max_explanations=1).count() == 1


def test_sql_functions(spark):
    names = register_functions(spark)
    assert "change_type" in names
    row = spark.sql("""
        SELECT materiality(-0.2D, 10L) m, change_type(0.5D, 0.6D, 0.1D) c, pad_cik(' 0042 ') k, word_count('a b  c') w,
               cosine_distance(array(1D, 0D), array(0D, 1D)) d, cosine_distance(array(0D), array(1D)) z,
               chunk_id('1', 2020, 's', 7) i, safe_ratio(1D, 0D) r""").first()
    assert row.m == pytest.approx(0.2 * np.log(11)) and row.c == "intensifying"
    assert (row.k, row.w, row.d, row.z, row.i, row.r) == ("0000000042", 3, 1.0, 1.0, "1_2020_s_0007", 0.0)
    text = spark.sql("SELECT t.full_text FROM VALUES ('<p>a</p><p>b</p>') AS v(h), LATERAL html_text(h) t").first()[0]
    assert text == "a\nb"


# Refresh, stages, CLI -----------------------------------------------------------------------


def test_streaming_refresh_takes_each_filing_once(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "chunks", "check"))
    frame = lambda k: spark.createDataFrame(
        [(f"{k:010d}", f"a{k}", 2020, f"<h1>Item 1A</h1><p>{LONG * 20}</p>")],
        "cik string, accession_number string, fiscal_year int, html string")
    frame(1).write.parquet(source)
    refresh(spark, source, out, check, str(tmp_path / "vectors")).awaitTermination()
    first = spark.read.parquet(out).count()
    frame(2).write.mode("append").parquet(source)
    refresh(spark, source, out, check, str(tmp_path / "vectors")).awaitTermination()
    refresh(spark, source, out, check, str(tmp_path / "vectors")).awaitTermination()
    stored = spark.read.parquet(out)
    assert stored.count() == 2 * first and stored.select("chunk_id").distinct().count() == 2 * first
    texts = stored.select("text").distinct().count()
    assert spark.read.parquet(str(tmp_path / "vectors")).count() == texts
    # An amendment of the same year shares the chunk ids; its chunks and a corrected text are kept.
    spark.createDataFrame(
        [(f"{1:010d}", "a1-amended", 2020, f"<h1>Item 1A</h1><p>{LONG * 20}</p>"),
         (f"{2:010d}", "a2", 2020, f"<h1>Item 1A</h1><p>{'Corrected. ' + LONG * 20}</p>")],
        "cik string, accession_number string, fiscal_year int, html string").write.mode("append").parquet(source)
    refresh(spark, source, out, check, str(tmp_path / "vectors")).awaitTermination()
    stored = spark.read.parquet(out)
    assert stored.where("accession_number = 'a1-amended'").count() == first
    assert stored.where("accession_number = 'a2' and text like 'Corrected.%'").count() == 1


def test_stages_end_to_end(spark, tmp_path, capsys):
    base = str(tmp_path / "data")
    layers = config.Layers(base)
    rng = np.random.default_rng(2)
    topics = ["cyber attack systems data breach", "climate carbon emission rules", "credit debt interest rate"]
    rows = []
    for cik in range(1, 5):
        for year in (2021, 2022, 2023):
            paragraphs = []
            for _ in range(8):
                words = topics[rng.integers(0, 3)].split()
                paragraphs.append(" ".join(rng.choice(words, size=50)))
            body = "".join(f"<p>{p}</p>\n\n" for p in paragraphs)
            rows.append((f"bronze/{cik}/{year}", f"{cik:010d}", f"acc-{cik}-{year}", year, "document", "u", None, None,
                         200, None, "agent", "2024", f"<h1>Item 1A</h1>{body}<h1>Item 2</h1>".encode()))
    twice = [r for r in rows if r[2] == "acc-1-2022"][0]
    rows.append((*twice[:2], "acc-1-2022-amended", *twice[3:]))  # two filings of one entity and year
    rows.append(("bronze/9/2023", "0000000009", "acc-9", 2023, "document", "u", None, None, 200, None, "agent", "2024", b"<p>x</p>"))
    spark.createDataFrame(rows, bronze.FETCHED_SCHEMA).write.partitionBy("fiscal_year").parquet(layers.bronze)
    Path(base, "overrides").mkdir()
    Path(layers.overrides).write_text("cluster_id,label\n0,Reviewed Theme\n")
    code = cli.main(["--base", base, "run", "--skip-ingestion", "--no-text-service", "--max-explanations", "6"], spark)
    shown = capsys.readouterr().out
    assert code == 0, shown
    assert "ingestion   skipped" in shown
    gold = {n: gold_layer.read_table(spark, layers.gold, n) for n in S.GOLD_TABLES}
    chunks, clusters = (spark.read.parquet(layers.silver(t)) for t in ("chunks", "clusters"))
    one = "cik = '0000000001' and fiscal_year = 2022"
    amended = chunks.where(one)
    assert amended.count() == 2 * amended.select("chunk_id").distinct().count() > 0
    assert clusters.count() == chunks.count()
    counted = spark.read.parquet(layers.silver("intensity")).where(one).agg(F.sum("chunk_count")).first()[0]
    noise = clusters.join(amended.select("accession_number", "chunk_id"), ["accession_number", "chunk_id"]).where("cluster_id = -1").count()
    assert counted == amended.count() - noise
    assert gold["explanations"].count() == 6 and gold["companies"].count() == 4
    assert gold["themes"].where("override_flag").first().label == "Reviewed Theme"
    assert gold["theme_intensity"].count() == gold["theme_changes"].count() > 0
    referenced = {i for r in gold["explanations"].collect() for i in r.evidence_chunk_ids}
    assert {r.chunk_id for r in gold["evidence_chunks"].collect()} == referenced
    assert spark.read.parquet(layers.silver("chunks")).select("accession_number", "chunk_id").distinct().count() == chunks.count()
    quality = {r.fiscal_year: r for r in gold["data_quality"].collect()}
    assert quality[2023].failed_extractions == 1 and quality[2022].extraction_success_rate == 1.0
    sizes = gold_layer.check_sizes(spark, {"themes": gold_layer.table_path(spark, layers.gold, "themes"), "none": base + "/none"})
    assert sizes["none"] == 0.0 and sizes["themes"] > 0
    from tidemark.plans import sql_console as Q
    from tidemark.plans import stages

    moved = stages.feed(spark, layers, "wasserstein").collect()
    assert len(moved) == gold["theme_changes"].count()
    figures = [r.wasserstein_drift for r in moved]
    known = [f for f in figures if f is not None]
    assert known and known == sorted(known, reverse=True) and figures[: len(known)] == known
    outliers = spark.read.parquet(layers.silver("outliers"))
    assert outliers.join(clusters.where("cluster_id = -1"), "chunk_id", "left_anti").count() == 0
    assert sorted(Q.register_gold(spark, layers.gold)) == sorted(S.GOLD_TABLES)
    assert Q.run_preset(spark, "top-drift").count() > 0
    assert Q.run_sql(spark, "SELECT * FROM themes WHERE cluster_id = 77").count() == 0
    assert cli.main(["--base", base, "status"], spark) == 0
    assert "gold.themes" in capsys.readouterr().out
    assert cli.main(["--base", base, "check-setup"], spark) == 0


def test_failed_stage_ends_the_run():
    def boom():
        raise RuntimeError("no")

    results = cli.run_stages({"a": lambda: {"n": 1}, "b": boom, "c": lambda: {}}, {"z"}, lambda _: None)
    assert [(r.stage, r.status) for r in results] == [("a", "ok"), ("b", "error")]
    assert cli.format_duration(12.34) == "12.3s" and cli.format_duration(185) == "3m05s"
    assert "n=1" in cli.summary(results)
