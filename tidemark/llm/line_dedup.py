"""Removal of lines that repeat an earlier line up to a few edits.

Lines are joined by edit distance: a line is split into threshold-plus-one segments, and a line
within the threshold must hold one of them unchanged, at a place that depends on the lengths. Each
line looks up its own substrings for all shorter lengths in the index of segments, and candidates
are verified with a banded bit-parallel edit distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import column, saved, whole_rows, whole_text

#: Lines within so many edits of an earlier line are removed.
EDITS = 2
#: Shorter lines are never removed: headings, brackets and list marks repeat for good reason.
LEAST_LINE = 20
#: Line keys that a task remembers, so that a common line is passed on once.
REMEMBERED = 500_000
#: Lines on either side of one block of comparisons.
BLOCK = 512


def segment(length: int | Column, i: int, edits: int) -> tuple:
    """Start (from 0) and size of segment ``i`` (from 0) of a line of ``length``; the last segments
    are one character longer where the length does not divide."""
    parts = edits + 1
    base = length // parts if isinstance(length, int) else F.floor(length / parts).cast("int")
    longer = parts - length % parts  # the first segment that is one longer
    if isinstance(length, int):
        return i * base + max(0, i - longer), base + int(i >= longer)
    extra = F.greatest(F.lit(0), F.lit(i) - longer)
    return (base * i + extra).cast("int"), (base + (F.lit(i) >= longer).cast("int")).cast("int")


def shifts(i: int, delta: int, edits: int) -> range:
    """How far a segment ``i`` of a line that is ``delta`` shorter may be displaced in the probing
    line, counting from its place: at most i edits lie before it and edits - i after it."""
    low = max(-i, delta - (edits - i))
    return range(low, min(i, delta + edits - i) + 1)


def segment_keys(line: Column, edits: int) -> Column:
    """Keys of a line as an array of ``(key, own)``: its own segments in the index, and the substrings
    with which it looks up lines of its own or a smaller length."""
    size = F.char_length(line)
    out = []
    for delta in range(edits + 1):
        length = size - delta
        for i in range(edits + 1):
            start, width = segment(length, i, edits)
            for shift in shifts(i, delta, edits):
                part = F.substr(line, start + 1 + shift, width)
                own = delta == 0 and shift == 0
                out.append(F.struct(F.xxhash64(F.lit(i), length, part).alias("key"), F.lit(own).alias("own")))
    return F.array(*out)


def within(a: str, b: str, edits: int) -> bool:
    """Whether the edit distance of two texts is at most ``edits``."""
    if abs(len(a) - len(b)) > edits:
        return False
    # A common start or end does not change the distance.
    low, most = 0, min(len(a), len(b))
    step = 64
    while low < most and a[low : low + step] == b[low : low + step]:
        low += step
    low = min(low, most)
    while low < most and a[low] == b[low]:
        low += 1
    a, b = a[low:], b[low:]
    end, most = 0, min(len(a), len(b))
    while end < most and a[len(a) - 1 - end] == b[len(b) - 1 - end]:
        end += 1
    a, b = a[: len(a) - end], b[: len(b) - end]
    if len(a) > len(b):
        a, b = b, a
    if not a or len(b) <= edits:
        return len(b) <= edits
    if edits == 1:
        return False  # two texts that differ at both ends and are longer than one need two edits
    return _banded(b, a, edits) <= edits


def _banded(a: str, b: str, k: int) -> int:
    """Edit distance of ``a`` and the shorter ``b`` if at most ``k``, else some number above ``k``.

    The bits of a word are the rows of a band of width 2k + 1 around the diagonal, which moves down
    one row with each column. Vertical differences +1 and -1 are kept in ``up`` and ``down``; the
    score follows the lowest diagonal of the band until the last row, then that row.
    """
    if len(a) <= k:
        return len(a)  # not the distance, but not above k either
    width = 2 * k + 1
    full = (1 << width) - 1
    rows: dict[str, int] = {}
    for i, c in enumerate(a):
        rows[c] = rows.get(c, 0) | 1 << i
    up, down = full & ~((1 << (k + 1)) - 1), 0  # column 0, already moved to the rows of column 1
    up |= 1 << k
    score = k
    for j in range(1, len(b) + 1):
        top = j - k - 1  # index in ``a`` of the band's first row
        match = rows.get(b[j - 1], 0)
        match = (match >> top if top >= 0 else match << -top) & full
        level = ((((match & up) + up) ^ up) | match | down) & full
        plus = (down | ~(level | up)) & full
        minus = level & up
        if j + k <= len(a):
            score += not level >> (2 * k) & 1
        else:
            bit = len(a) - 1 - top
            score += (plus >> bit & 1) - (minus >> bit & 1)
        # To column j + 1: rows move down by one, a row that enters is one more than the last.
        up = (minus | ~((level >> 1) | plus)) & full
        down = (level >> 1) & plus
    return score


def repeats(texts: list[str], blocks: list[int], edits: int) -> list[int]:
    """Positions of the texts with an earlier one within the distance. With two blocks, only pairs
    across them are compared."""
    found = []
    across = len(set(blocks)) > 1
    wide = len(texts) > 12
    if wide:
        # An edit changes at most two counts of characters by one each.
        counts = np.stack([np.bincount(np.frombuffer(t.encode("utf-32-le"), np.uint32) % 61, minlength=61) for t in texts])
        marks = np.array(blocks)
    for i in range(1, len(texts)):
        if wide:
            near = np.abs(counts[:i] - counts[i]).sum(axis=1) <= 2 * edits
            if across:
                near &= marks[:i] != marks[i]
            earlier = np.flatnonzero(near)
        else:
            earlier = [j for j in range(i) if not across or blocks[j] != blocks[i]]
        if any(within(texts[j], texts[i], edits) for j in earlier):
            found.append(i)
    return found


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Eligible lines: ``doc, doc_hash, at, line, k1, k2``; (k1, k2) stands for the line."""
    text = whole_text(text_col)
    rows = docs.select(
        column(id_col).cast("long").alias("doc"),
        F.xxhash64(text).alias("doc_hash"),
        F.posexplode(F.split(text, "\n")).alias("at", "line"),
    )
    rows = rows.filter(F.char_length("line") >= LEAST_LINE)
    return rows.withColumns({"k1": F.xxhash64("line"), "k2": F.xxhash64(F.lit(1), "line")})


def _once_a_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``k1, k2, line`` without lines that the task has passed on lately; equal keys of what it
    forgets meet again in the shuffle."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        fresh = []
        for k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            fresh.append(k not in seen)
            seen.add(k)
        if len(seen) > REMEMBERED:
            seen.clear()
        yield batch.filter(pa.array(fresh, pa.bool_()))


def _later_lines(rows: DataFrame, edits: int) -> DataFrame:
    """``k1, k2`` of lines that repeat an earlier line, from rows sorted by block and place."""
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run: list[tuple] = []
        mark = None
        out: list[tuple[int, int]] = []

        def close() -> None:
            for i in repeats([r[0] for r in run], [r[1] for r in run], edits) if len(run) > 1 else ():
                out.append(run[i][2:])
            run.clear()

        def batch_out() -> pa.RecordBatch:
            k1, k2 = zip(*out) if out else ((), ())
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(k1, pa.int64()), pa.array(k2, pa.int64())], schema=schema)

        for batch in batches:
            names = ["key", "low", "high", "line", "block", "k1", "k2"]
            for key, low, high, *row in zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names)):
                if (key, low, high) != mark:
                    close()
                    mark = (key, low, high)
                run.append(tuple(row))
            yield batch_out()
        close()
        yield batch_out()

    return rows.mapInArrow(work, "k1 long, k2 long").distinct()


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS) -> DataFrame:
    """``doc, doc_hash, kept``: for each document the numbers of its eligible lines that stay.

    A document is a pair of id and text hash. Of equal lines the first in order of id and line number
    stays, unless a different line within the distance comes earlier; this is judged on the input,
    so a line may go for a line that goes itself.
    """
    lines = _lines(docs, id_col, text_col)
    place = F.struct("doc", "doc_hash", "at")
    firsts = saved(lines.groupBy("k1", "k2").agg(F.min(place).alias("place")), "first-lines")
    # Equal lines have equal keys; a task passes each line on once. One shuffle by key serves to combine
    # what tasks have in common, to count and to keep; a frequent key's lines pass through as sorted rows.
    once = lines.select("k1", "k2", "line").mapInArrow(_once_a_task, "k1 bigint, k2 bigint, line string")
    keyed = once.select("k1", F.explode(segment_keys(F.col("line"), edits)).alias("k")).select("k1", "k.*").repartition("key")
    keyed = keyed.groupBy("key", "k1").agg(F.max(F.col("own").cast("int")).alias("own"))
    same = Window.partitionBy("key")
    counted = keyed.withColumns({"n": F.count(F.lit(1)).over(same), "indexed": F.max("own").over(same)})
    shared = counted.filter((F.col("n") > 1) & (F.col("indexed") == 1))
    candidates = saved(shared.select("key", "k1", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "candidates")
    # Merge joins at every size: both tables below grow with the lines and are never small by right.
    wanted = candidates.select("k1").distinct().hint("merge")
    texts = (
        lines.join(wanted, "k1", "left_semi").groupBy("k1", "k2")
        .agg(F.min(place).alias("place"), F.min("line").alias("line"))
    )
    # Blocks of bounded size meet in pairs; most keys have a single block.
    block = F.pmod(F.xxhash64("k1", "k2"), F.col("blocks")).cast("int")
    dealt = candidates.join(saved(texts, "candidate-lines"), "k1").withColumn("block", block)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    sorted_rows = dealt.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "place")
    gone = _later_lines(sorted_rows.select("key", "low", "high", "line", "block", "k1", "k2"), edits)
    stays = firsts.join(saved(gone, "repeated-lines"), ["k1", "k2"], "left_anti").select("place.*")
    return stays.groupBy("doc", "doc_hash").agg(F.collect_list("at").alias("kept"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS) -> DataFrame:
    """``docs`` without repeated lines, with ``n_lines`` and ``n_removed``; one row per input row.

    Lines end at line feeds; lines shorter than ``LEAST_LINE`` always stay. A document keeps its row
    when all its lines go; its text is then empty. Rows that agree in id and text are one document
    and keep the same lines; null ids come first in the order. A null text stays null and has no
    lines. The text is shuffled once, to meet its line numbers.
    """
    kept = saved(repeated_lines(docs, id_col, text_col, edits), "kept-lines")

    kinds = pa.struct([("text", pa.string()), ("n_lines", pa.int32()), ("n_removed", pa.int32())])

    @F.arrow_udf("text string, n_lines int, n_removed int")
    def cut(texts: pa.Array, numbers: pa.Array) -> pa.Array:
        out = []
        for text, own in zip(texts, numbers):
            lines = text.as_py().split("\n")
            stay = set(own.as_py() or ())
            left = [x for i, x in enumerate(lines) if len(x) < LEAST_LINE or i in stay]
            out.append({"text": "\n".join(left), "n_lines": len(lines), "n_removed": len(lines) - len(left)})
        return pa.array(out, kinds)

    rows = whole_rows(docs, _doc=column(id_col).cast("long"), _hash=F.xxhash64(whole_text(text_col)))
    same = F.col("_doc").eqNullSafe(F.col("doc")) & (F.col("_hash") == F.col("doc_hash"))
    text = F.col("_row").getField(text_col).cast("string")
    joined = rows.join(kept.hint("merge"), same, "left")
    joined = joined.withColumn("_cut", cut(F.coalesce(text, F.lit("")), F.col("kept")))
    results = {
        text_col: F.when(text.isNotNull(), F.col("_cut.text")),
        "n_lines": F.when(text.isNotNull(), F.col("_cut.n_lines")).otherwise(0),
        "n_removed": F.when(text.isNotNull(), F.col("_cut.n_removed")).otherwise(0),
    }
    names = [*docs.columns, *[c for c in ("n_lines", "n_removed") if c not in docs.columns]]
    return joined.select(*[results.get(c, F.col("_row").getField(c)).alias(c) for c in names])
