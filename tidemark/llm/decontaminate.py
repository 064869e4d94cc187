"""Benchmark decontamination: documents that hold a benchmark item, found by built-in functions only.

A window of a document as long as an item is fingerprinted with SimHash over its word shingles. An
index over blocks of the items' fingerprints finds every window within the Hamming radius: the
radius spread over the blocks leaves some block within a few bits, and all keys that near are in the
index. Windows found are verified by the exact similarity of the weighted shingles.

No start of a window needs to be tried but those at which a shared shingle comes in as the last one:
all windows of an item have as many shingles, so a window can only be better than the one a word
earlier by the shingle that comes in. The first of the best windows of all starts is thus tried. So are
those at which a shared shingle has the same place in both; they go first where they are as good.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, column, drop_ids, saved, whole_text

SHINGLE_WORDS = 5
#: An item is held when 100 * shared weight >= PERCENT * total weight.
PERCENT = 75
#: Fingerprints of texts at the least similarity differ in 11 of 64 bits on average, with a standard
#: deviation of 3; the radius is more than six deviations above.
RADIUS, BLOCKS, BLOCK_BITS = 31, 8, 8
#: One of the blocks differs in at most so many bits.
BLOCK_RADIUS = RADIUS // BLOCKS
#: Benchmark shingles that are broadcast at once, 48 bytes each; a larger benchmark is met in slices.
BROADCAST_ROWS = 1_000_000


def words(text: Column) -> Column:
    """Words between ASCII white space, A-Z lower-cased."""
    return F.filter(F.split(ascii_lower(text), "[ \\t-\\r]+"), lambda w: w != "")


def _shingles(own: str, size: Column | int) -> Column:
    """Hashes of all shingles of ``size`` words in the array column ``own``; a shorter text is one."""
    n = f"least({size}, size({own}))"
    return F.when(
        F.size(own) > 0,
        F.expr(f"transform(sequence(0, size({own}) - {n}), i -> xxhash64({n}, slice({own}, i + 1, {n})))"),
    ).otherwise(F.expr("cast(array() as array<bigint>)"))


def simhash(hashes: str) -> Column:
    """64-bit SimHash of an array of hashes; a shingle weighs as often as it occurs."""
    sums = (
        f"transform(sequence(0, 63), b -> aggregate({hashes}, 0, "
        "(a, x) -> a + cast(shiftright(x, b) & 1L as int) * 2 - 1))"
    )
    return F.expr(
        f"aggregate(zip_with(sequence(0, 63), {sums}, (b, s) -> if(s > 0, shiftleft(1L, b), 0L)), 0L, (a, x) -> a | x)"
    )


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per item with words: id, number of words, shingle hashes, fingerprint."""
    rows = benchmark.select(column(id_col).cast("long").alias("item_id"), words(whole_text(text_col)).alias("_w"))
    # Items that repeat id and words are one.
    rows = rows.filter(F.size("_w") > 0).distinct()
    rows = rows.select("item_id", F.size("_w").alias("n"), F.hash("item_id", "_w").alias("_part"), F.xxhash64("_w").alias("item"), _shingles("_w", SHINGLE_WORDS).alias("g"))
    return rows.withColumn("item_print", simhash("g"))


def _index(items: DataFrame) -> DataFrame:
    """``item_id, item, block, key``: for every block of a fingerprint all keys within the radius."""
    near = F.expr(f"filter(sequence(0, {2**BLOCK_BITS - 1}), m -> bit_count(m) <= {BLOCK_RADIUS})")
    rows = items.select("item_id", "item", "item_print", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("block"))
    rows = rows.select("*", F.explode(near).alias("m"))
    return rows.select("item_id", "item", "block", _block("item_print").bitwiseXOR(F.col("m")).alias("key"))


def _block(fingerprint: str) -> Column:
    return F.expr(f"cast(shiftrightunsigned({fingerprint}, block * {BLOCK_BITS}) & {2**BLOCK_BITS - 1} as int)")


def _windows(docs: DataFrame, items: DataFrame, size: int) -> DataFrame:
    """Item-sized windows that a shingle of ``size`` words shared with an item ends, or (``placed``)
    in which it has the item's place."""
    grams = items.filter(F.least("n", F.lit(SHINGLE_WORDS)) == size)
    grams = grams.select("item_id", "item", "n", F.posexplode("g").alias("offset", "gram"))
    positions = docs.filter(F.size("w") >= size).select("doc_id", "doc", "w", F.posexplode("w").alias("pos", "_word"))
    positions = positions.filter(F.col("pos") <= F.size("w") - size)
    gram = F.xxhash64(F.lit(size), *[F.get("w", F.col("pos") + i) for i in range(size)])
    hits = positions.withColumn("gram", gram).join(F.broadcast(grams), "gram")
    placed = F.greatest(F.lit(0), F.least(F.col("pos") - F.col("offset"), F.size("w") - F.col("n")))
    ended = F.greatest(F.lit(0), F.col("pos") + size - F.col("n"))
    both = F.array(
        F.struct(placed.alias("start"), F.lit(True).alias("placed")),
        F.struct(ended.alias("start"), F.lit(False).alias("placed")),
    )
    laid = hits.select("doc_id", "doc", "item_id", "item", "w", "n", F.inline(both))
    return laid.select("doc_id", "doc", "item_id", "item", "start", "placed", F.slice("w", F.col("start") + 1, F.col("n")).alias("window"))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``doc_id, item_id, start, similarity``: one row per document and item it holds, with the first
    word and the similarity of the best window of all starts. Of equally good ones, those come first in
    which a shared shingle has the same place as in the item (pushed inside at the ends), then the
    first in the document.

    Shingles have five words and weigh as often as they occur; an item of fewer words is one shingle
    of its own length. A window is as long as the item. Null and empty texts hold nothing
    and are held by nothing; null ids are ids like any other; rows that repeat id and text count
    once. Other columns are not read. Only windows are shuffled, never whole texts.
    """
    items = saved(_items(benchmark, item_id_col, item_text_col), "benchmark-items")
    text = whole_text(text_col)
    rows = docs.select(column(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("doc"), words(text).alias("w"))
    totals = items.agg(F.sum(F.size("g")).alias("grams"), F.collect_set(F.least("n", F.lit(SHINGLE_WORDS))).alias("sizes")).first()
    slices = math.ceil((totals["grams"] or 0) / BROADCAST_ROWS)
    found = None
    for k in range(max(1, slices)):
        part = items.filter(F.pmod("_part", F.lit(max(1, slices))) == k)
        for size in sorted(totals["sizes"]) or [SHINGLE_WORDS]:
            windows = _windows(rows, part, size)
            found = windows if found is None else found.unionByName(windows)
    distinct = found.groupBy("doc_id", "doc", "item_id", "item", "start").agg(F.first("window").alias("window"), F.max("placed").alias("placed"))
    # The shingle length is that of the item: shorter than five words only with the item.
    printed = distinct.select("doc_id", "doc", "item_id", "item", "start", "placed", _shingles("window", SHINGLE_WORDS).alias("h"))
    printed = saved(printed.withColumn("window_print", simhash("h")), "window-fingerprints")
    probes = printed.select(
        "doc_id", "doc", "item_id", "item", "start", "window_print",
        F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("block"),
    )
    probes = probes.select("doc_id", "doc", "item_id", "item", "start", "block", _block("window_print").alias("key"))
    index = _index(items)
    place = ["doc_id", "doc", "item_id", "item", "start"]
    same = [F.col(f"i.{c}").eqNullSafe(F.col(f"p.{c}")) for c in ("item_id", "item", "block", "key")]
    candidates = probes.alias("p").join(index.alias("i"), same, "left_semi").select(*place).distinct()
    same = [F.col(f"c.{c}").eqNullSafe(F.col(f"w.{c}")) for c in place]
    near = printed.alias("w").join(candidates.alias("c"), same, "left_semi")
    own = items.select(F.col("item_id").alias("_i"), F.col("item").alias("_t"), "g", "item_print")
    near = near.join(own, F.col("item_id").eqNullSafe(F.col("_i")) & (F.col("item") == F.col("_t")))
    near = near.filter(F.bit_count(F.col("window_print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
    shared = F.expr(
        "aggregate(array_distinct(g), 0, (a, x) -> a + least(size(filter(g, y -> y = x)), size(filter(h, y -> y = x))))"
    )
    scored = near.withColumn("shared", shared).withColumn("all", F.size("g") + F.size("h") - F.col("shared"))
    held = scored.filter(F.col("shared") * 100 >= F.col("all") * PERCENT)
    best = held.groupBy("doc_id", "item_id").agg(
        F.max(F.struct((F.col("shared") / F.col("all")).alias("similarity"), "placed", (-F.col("start")).alias("back"))).alias("best")
    )
    return best.select("doc_id", "item_id", (-F.col("best.back")).alias("start"), F.col("best.similarity").alias("similarity"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that hold an item. A document without id goes with every other
    one without id."""
    held = contaminated(docs, benchmark, id_col, text_col).select("doc_id").distinct()
    return drop_ids(docs, saved(held, "contaminated"), id_col)
