from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import language as L

WORDS = {
    "en": "the and of that with from this have which there their would about".split(),
    "fr": "le la et des une dans pour que avec sur était être après très".split(),
    "de": "der die und nicht mit auf für eine über schön wird nach durch".split(),
}
SCHEMA = "doc_id long, text string, lang string, host string, language int"


def sentence(lang, seed, n=40):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(WORDS[lang], n))


def rows_in():
    rows = [(i, sentence(x, i), x, f"h{i % 4}", 1) for i, x in enumerate(["en", "fr", "de"] * 20)]
    rows += [(100, sentence("fr", 100), "en-US", None, 1)]  # the declaration is wrong
    rows += [(101, None, "en", "h1", 1), (102, "", None, None, 1), (103, "12 !! %%", "de", "h2", 1)]
    rows += [(104, sentence("de", 104), None, "new", 1), (None, sentence("en", 5, 5000), None, None, 1)]
    return rows


def run(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return L.identify(df, F.col("text"), F.col("lang"), F.col("host"), F.col("host"), key=F.col("doc_id"))


def test_languages_and_rejections(spark):
    got = run(spark, rows_in())
    assert got.columns == ["doc_id", "text", "lang", "host", "language", "confidence", "accepted"]
    got = {r.doc_id: r for r in got.collect()}
    for i, x in enumerate(["en", "fr", "de"] * 20):
        assert got[i].language == x and got[i].accepted and got[i].confidence > 0.9
    assert got[100].language == "fr" and got[104].language == "de" and got[None].language == "en"
    for i in (101, 102, 103):
        assert (got[i].language, got[i].confidence, got[i].accepted) == ("und", 0.0, False)


def test_against_brute_force(spark):
    """The fused posterior restated with plain dictionaries."""
    rows = [r for r in rows_in() if r[1]]
    df = spark.createDataFrame(rows, SCHEMA)
    plain = df.select(
        F.col("text").alias("_text"), L.primary(F.col("lang")).alias("_declared"), F.col("doc_id").alias("_key")
    )
    model = L.fit(plain)
    names = [*model.languages, L.UNKNOWN]
    seen = []
    for r in rows:
        s = model.score(r[1])
        seen.append((r, s, names[int(np.argmax(s[:-1]))] if s[-1] else None))
    tag = lambda r: (r[2] or "")[:2] or None
    sums = {n: 1.0 + sum(b == n for _, _, b in seen) for n in names}
    known = sum(v for k, v in sums.items() if k != L.UNKNOWN)
    whole = {n: (1 - L.UNKNOWN_SHARE) * sums[n] / known for n in names[:-1]} | {L.UNKNOWN: L.UNKNOWN_SHARE}

    def smooth(count, parent):
        total = sum(count.values())
        return {n: (count[n] + L.PRIOR_ROWS * parent[n]) / (total + L.PRIOR_ROWS) for n in names}

    def counts(match):
        return {n: sum(b == n for r, _, b in seen if match(r)) for n in names}

    got = {r.doc_id: r for r in run(spark, rows).collect()}
    for r, s, _ in seen:
        if not s[-1]:
            continue  # no letters
        prior = whole
        if r[3] is not None:
            own = counts(lambda x: x[3] == r[3])
            prior = smooth(own, smooth(own, whole))
        post = {n: s[i] + math.log(prior[n]) for i, n in enumerate(names)}
        if tag(r):
            own = counts(lambda x: tag(x) == tag(r))
            share = sum(own.values()) / sum(sums.values())
            for n in names:
                post[n] += math.log((own[n] + L.PRIOR_ROWS * (share + 1e-6)) / (sums[n] + L.PRIOR_ROWS))
        top = max(post, key=post.get)
        confidence = 1 / sum(math.exp(v - post[top]) for v in post.values())
        assert got[r[0]].language == top and abs(got[r[0]].confidence - confidence) < 1e-6


def test_address_and_markup(spark):
    df = spark.createDataFrame(
        [("https://u@M.blog.example.DE:80/fr?x#y", "<HTML class=a lang='De-at'><p>x<script>var t</script >y<!-- z --></p>"), (None, None), ("nonsense", "plain")],
        "url string, html string",
    )
    parts = L.address(F.col("url"))
    got = df.select(parts["host"], parts["domain"], parts["suffix"], L.primary(L.markup_language(F.col("html"))), F.trim(L.visible_text(F.col("html")))).collect()
    assert tuple(got[0][:4]) == ("m.blog.example.de", "example.de", "de", "de") and got[0][4].split() == ["x", "y"]
    assert tuple(got[1]) == (None,) * 5 and tuple(got[2]) == (None, None, None, None, "plain")


def test_empty_and_undeclared(spark):
    assert run(spark, []).count() == 0
    got = run(spark, [(1, "some words", None, None, 1)]).collect()
    assert [(r.language, r.accepted) for r in got] == [("und", False)]


def test_declared_languages_are_found_again(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = L.identify(docs, F.col("text"), F.lit(None).cast("string"), F.col("source"), F.col("source"), key=F.col("doc_id"))
    assert got.filter("accepted").count() == 0  # nothing declared, nothing learned
    got = L.identify(docs, F.col("text"), F.col("lang"), F.col("source"), F.col("source"), key=F.col("doc_id"))
    right = got.filter((F.col("lang") == F.col("language")) & F.col("accepted")).count()
    assert right >= 0.97 * docs.count()


def test_many_languages(spark):
    rng = np.random.default_rng(3)
    tags = [f"{a}{b}" for a in "abcdefg" for b in "klmnopqrst"]
    words = {x: ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(12)] for x in tags}
    rows = [(i, " ".join(rng.choice(words[x], 40)), x, None, 1) for i, x in enumerate(tags * 6)]
    got = run(spark, rows).collect()
    assert len(tags) == 70 and len(got) == 420
    assert all(r.language == r.lang and r.accepted for r in got)
