"""Mixing sources to target weights, to the word.

Documents are counted by source and exact length. Every length is taken the same share of times, rounded
down; what is then left of a source's budget is fitted by a bounded knapsack over the lengths. Takes of
a length go round its documents in the order of a seeded hash, so none is taken twice before all are
taken once.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import HOT_SHARE, column, partitions, saved

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in order, the share of all words that is mixed, and how many
#: times a document may be taken.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = 20_240_229
#: Words that are left to the knapsack, but for the length of one document.
KNAPSACK_WORDS = 1 << 16

PLAN = (
    "key string, size bigint, n bigint, whole bigint, extra bigint, source_size bigint, target double"
)
COLUMNS = ["doc_id", "size", "source_size", "target", "taken"]


# --- targets ---------------------------------------------------------------------------------


def source_key(source: Column) -> Column:
    """A key without nulls in the order of code points, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def _numbered(sources: DataFrame) -> DataFrame:
    """``sources`` with ``place`` 0, 1, .. in the order of ``key``: a range sort, stored with each row's
    position, and the sizes of the parts before."""
    slot = F.monotonically_increasing_id()
    ordered = saved(sources.orderBy("key").withColumn("slot", slot), "mix-sources")
    placed = ordered.withColumn("part", F.shiftright("slot", 33))
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    # One row per task of the sort.
    before = F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    place = F.col("before") + F.col("slot") - F.shiftleft("part", 33)
    return placed.join(offsets, "part").select(*sources.columns, place.alias("place"))


def source_targets(
    classes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """``key, source_size, target`` from ``key, size, n``.

    Sources share ``share`` of all words by weight. A target above ``most`` times its source's size
    stops there and the rest is shared again; each round is one small sum over the sources."""
    sizes = classes.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    sources = saved(
        _numbered(sizes).select("key", "source_size", weight.alias("weight"), (F.col("source_size") * most).alias("limit")),
        "mix-weights",
    )
    level, before = 0.0, -1
    while True:
        stopped = F.col("limit") <= F.col("weight") * F.lit(level)
        found = sources.agg(
            F.sum("source_size").alias("words"), F.sum(F.when(stopped, F.col("limit"))).alias("used"),
            F.sum(F.when(~stopped, F.col("weight"))).alias("rest"), F.count_if(stopped).alias("stopped"),
        ).first()
        if not found["rest"] or found["stopped"] == before:
            break
        level = (share * found["words"] - (found["used"] or 0)) / found["rest"]
        before = found["stopped"]
    target = F.least(F.col("limit").cast("double"), F.col("weight") * F.lit(level))
    return sources.select("key", "source_size", target.alias("target"))


# --- budgets ---------------------------------------------------------------------------------


def knapsack(lengths: list[int], counts: list[int], budget: float) -> list[int]:
    """How many of each length to take for a sum as near as can be to ``budget`` (ties: below it).

    Each length is split into binary multiples. ``first`` holds the multiple that first reached a sum,
    so a sum is undone by taking off that multiple: what remains was reached before."""
    chosen = [0] * len(lengths)
    top = math.floor(2 * budget)
    if top < 1:
        return chosen
    first = np.full(top + 1, -1, dtype="int32")
    reached = np.zeros(top + 1, dtype=bool)
    reached[0] = True
    nearest = math.ceil(budget - 0.5)
    steps: list[tuple[int, int]] = []
    for i in np.argsort(lengths, kind="stable")[::-1]:
        left, multiple = min(counts[i], top // lengths[i]), 1
        while left > 0 and not reached[nearest]:
            take = min(multiple, left)
            words = take * lengths[i]
            if words > top:
                break
            new = reached[: top + 1 - words] & ~reached[words:]
            first[words:][new] = len(steps)
            reached[words:] |= new
            steps.append((int(i), take))
            left, multiple = left - take, multiple * 2
    sums = np.flatnonzero(reached)
    total = int(sums[np.argmin(np.abs(sums - budget))])
    while total:
        i, take = steps[first[total]]
        chosen[i] += take
        total -= take * lengths[i]
    return chosen


def _filled(lengths: list[int], bounds: list[int], budget: float, free: int) -> list[int]:
    """Takes per length: the same share of every length, rounded down and less ``free``, and the rest
    by a knapsack."""
    words = sum(length * n for length, n in zip(lengths, bounds))
    taken = [max(0, n * math.floor(budget) // words - free) for n in bounds]
    left = budget - sum(length * t for length, t in zip(lengths, taken))
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        while taken[i] < bounds[i] and left - lengths[i] >= KNAPSACK_WORDS:
            taken[i] += 1
            left -= lengths[i]
    more = knapsack(lengths, [n - t for n, t in zip(bounds, taken)], left)
    return [t + m for t, m in zip(taken, more)]


def fitted(lengths: list[int], bounds: list[int], budget: float) -> list[int]:
    """How often to take each length, at most ``bounds``, for a sum near ``budget``. Where the rest
    that rounding leaves cannot be met to the word, up to two takes of each length are fitted anew."""
    if budget >= sum(length * n for length, n in zip(lengths, bounds)):
        return list(bounds)

    def off(found: list[int]) -> float:
        return abs(sum(length * t for length, t in zip(lengths, found)) - budget)

    best = _filled(lengths, bounds, budget, 0)
    for free in (1, 2):
        if off(best) > 0.5:
            best = min(best, _filled(lengths, bounds, budget, free), key=off)
    return best


def _planned(source: pd.DataFrame) -> pd.DataFrame:
    """The plan of one source: its lengths, however many documents it has."""
    source = source.sort_values("size").reset_index(drop=True)
    some = source[source["size"] > 0]
    takes = np.zeros(len(source), dtype="int64")
    bounds = [MOST * int(n) for n in some["n"]]
    takes[some.index] = fitted([int(v) for v in some["size"]], bounds, float(source["target"].iloc[0]))
    planned = source.assign(whole=takes // source["n"], extra=takes % source["n"])
    return planned[[c.split()[0] for c in PLAN.split(", ")]]


def budget_plan(classes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source and length: all ``n`` documents are taken ``whole`` times, ``extra`` of them once more."""
    return classes.join(targets, "key").groupBy("key").applyInPandas(_planned, PLAN)


# --- documents -------------------------------------------------------------------------------


def _drawn(rows: DataFrame) -> Column:
    """Whether a row is among the ``extra`` first tickets of its source and length."""
    order = Window.partitionBy("key", "size").orderBy("ticket", "doc_id")
    return F.row_number().over(order) <= F.col("extra")


def _taken(rows: DataFrame, once_more: Column) -> DataFrame:
    times = F.col("whole") + F.when(once_more, F.lit(1)).otherwise(F.lit(0))
    return rows.withColumn("taken", F.col("size") * times).select(*COLUMNS)


def _from_hot_classes(rows: DataFrame, hot: DataFrame, share: float) -> DataFrame:
    """Documents of lengths that hold a large part of all rows, without bringing one length together.

    Tickets are counted by their leading bits; the bucket in which the last one is drawn is found from
    the counts, and only the rows of that bucket, about a sixteenth of a share, are ranked."""
    bits = F.ceil(F.log2(F.col("n") / F.lit(share))) + 4
    placed = rows.join(F.broadcast(hot.withColumn("bits", bits.cast("int"))), ["key", "size"])
    placed = placed.withColumn("bucket", F.expr("shiftright(ticket, 64 - bits)"))
    counts = placed.groupBy("key", "size", "bucket").agg(F.count(F.lit(1)).alias("rows"), F.first("extra").alias("extra"))
    upto = F.sum("rows").over(Window.partitionBy("key", "size").orderBy("bucket"))
    last = counts.withColumn("upto", upto).filter("upto >= extra").groupBy("key", "size").agg(
        F.min_by(F.struct("bucket", F.expr("extra - (upto - rows)").alias("quota")), "bucket").alias("last")
    )
    # One row per hot class, of which there are fewer than HOT_SHARE x partitions.
    last = saved(last.select("key", "size", "last.*").withColumnRenamed("bucket", "last_bucket"), "mix-buckets")
    found = placed.join(F.broadcast(last), ["key", "size"])
    clear = _taken(found.filter("bucket <> last_bucket"), F.expr("bucket < last_bucket"))
    open_ = found.filter("bucket = last_bucket").drop("extra").withColumnRenamed("quota", "extra")
    return clear.unionByName(_taken(open_, _drawn(open_)))


def mix(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED
) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every document.

    ``size`` is the number of words, 0 for a null or empty text; such documents are taken with 0 words.
    A null source is a source of its own, after all others; an empty one comes first. Null and repeated
    ids are documents like others: of rows that agree in id and text, it does not matter which is drawn.
    If there are no words, all targets are 0; an empty table gives an empty result. Further columns
    are ignored. The draw depends on ``seed``, ids and texts alone, not on the partitions.

    Texts are read once. What is shuffled afterwards is a key, a size and a hash per document.
    """
    text = F.coalesce(column(text_col).cast("string"), F.lit(""))
    rows = saved(
        documents.select(
            column(id_col).cast("long").alias("doc_id"), source_key(column(source_col).cast("string")).alias("key"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
            F.xxhash64(F.lit(seed), column(id_col).cast("long"), text).alias("ticket"),
        ),
        "mix-rows",
    )
    classes = saved(rows.groupBy("key", "size").agg(F.count(F.lit(1)).alias("n")), "mix-classes")
    plan = saved(budget_plan(classes, saved(source_targets(classes), "mix-targets")), "mix-plan")
    total = classes.agg(F.sum("n")).first()[0] or 0
    share = max(1.0, total / (HOT_SHARE * partitions(documents.sparkSession)))
    # Fewer than HOT_SHARE x partitions rows, so it may be broadcast.
    hot = plan.filter(F.col("n") > share)
    # The plan grows with the sources and their lengths, so it is never broadcast.
    others = rows.join(F.broadcast(hot.select("key", "size")), ["key", "size"], "left_anti").join(
        plan.filter(F.col("n") <= share).hint("merge"), ["key", "size"]
    )
    return _taken(others, _drawn(others)).unionByName(_from_hot_classes(rows, hot, share))
