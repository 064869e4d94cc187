"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A sketch is filled in rounds: each round throws all shingles into random bins, later rounds with
larger values, so the first rounds settle most bins; a second series of rounds, one per bin, fills
what is still empty. Every coordinate is a sample of the same shingle in two sets with probability
equal to their similarity, and estimates are concentrated as with independent hash functions.

Links come from candidates that share a band, checked on the full shingle sets. Groups are never
expanded into all pairs: equal sets count once, each bucket is first compared with its smallest
document only, and only documents left outside that document's component are compared further.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import column, saved, whole_text
from tidemark.llm.graph import components

SHINGLE_WORDS = 5
#: Links need ``LINK_PERCENT`` * union <= 100 * intersection.
LINK_PERCENT = 75
#: A pair of similarity 0.75 shares no band with probability (1 - 0.75^4)^44 = 6e-8.
BANDS, ROWS = 44, 4
COORDINATES = BANDS * ROWS
#: Pairs whose estimated similarity is 6 standard deviations below the threshold need no full
#: comparison; 8 bits are kept of each coordinate.
LEAST_ESTIMATE = LINK_PERCENT / 100 - 6 * math.sqrt(0.75 * 0.25 / COORDINATES)
#: Documents on either side of one block of comparisons.
BLOCK = 256

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, element by element."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; a shorter text is one shingle."""
    words = text.encode().lower().split()  # of bytes: A-Z only, ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(SHINGLE_WORDS, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        out = _mix(out * _U(0x9E3779B97F4A7C15) + hashes[i : len(words) - size + 1 + i])
    return np.unique(out)


def sketch(shingles: np.ndarray, size: int = COORDINATES) -> np.ndarray:
    """Fast similarity sketch: ``size`` coordinates, all filled for a non-empty set.

    Round i puts every shingle into one of ``size`` bins with a value in [i, i + 1) and a bin keeps
    its least value; when all bins are filled, later rounds cannot change them. Rounds ``size`` to
    ``2 size - 1`` put every shingle into bin i - size, so no bin stays empty.
    """
    bins = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    step = max(1, 512 // len(shingles))
    for low in range(0, size, step):
        rounds = np.arange(low, min(low + step, size), dtype=np.uint64)
        drawn = _mix(shingles[None, :] ^ _mix(rounds + _U(1))[:, None])
        values = (rounds << _U(48))[:, None] | (drawn >> _U(16))
        np.minimum.at(bins, (drawn & _U(0xFFFF)).ravel() % _U(size), values.ravel())
        if bins.max() != np.iinfo(np.uint64).max:
            return bins
    for b in np.flatnonzero(bins == np.iinfo(np.uint64).max):
        i = _U(size + int(b))
        drawn = _mix(shingles ^ _mix(np.array([i + _U(1)]))[0])
        bins[b] = (i << _U(48)) | (drawn.min() >> _U(16))
    return bins


def band_keys(bins: np.ndarray) -> np.ndarray:
    """One 64-bit key per band."""
    rows = bins.reshape(-1, ROWS)
    key = np.arange(1, len(rows) + 1, dtype=np.uint64)
    for i in range(ROWS):
        key = _mix(key * _U(0x9E3779B97F4A7C15) + rows[:, i])
    return key


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two shingle sets reach the threshold, in whole numbers."""
    if 100 * min(len(a), len(b)) < LINK_PERCENT * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= LINK_PERCENT * (len(a) + len(b) - both)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        column(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text")
    )


def _sketched(rows: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, set_id, bands`` of every row; ``set_id`` is null for an empty set."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.binary()), ("bands", pa.list_(pa.int64()))]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, marks, bands = [], [], []
            for text in batch.column("text"):
                own = shingle_set(text.as_py())
                sizes.append(len(own))
                full = len(own) > 0
                marks.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if full else None)
                bands.append(band_keys(sketch(own)).view(np.int64) if full else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(marks, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                schema=schema,
            )

    return rows.mapInArrow(work, "doc_id long, n_shingles long, set_id binary, bands array<long>")


def _full_sets(rows: DataFrame) -> DataFrame:
    """``doc_id, n, bits, bands, shingles``: 8 bits of each coordinate, 32 of each band, the whole set."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64())] + [(c, pa.binary()) for c in ("bits", "bands", "shingles")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py()) for t in batch.column("text")]
            bins = [sketch(s) if len(s) else s for s in sets]
            columns = [
                [x.astype(np.uint8).tobytes() for x in bins],
                [band_keys(x).astype(np.uint32).tobytes() if len(x) else b"" for x in bins],
                [s.tobytes() for s in sets],
            ]
            sizes = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), sizes, *(pa.array(c, pa.binary()) for c in columns)], schema=schema
            )

    return rows.mapInArrow(work, "doc_id long, n long, bits binary, bands binary, shingles binary")


@F.pandas_udf(T.BooleanType())
def _linked(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(a, b)], dtype=bool)


def _links_of_block(band: int, outer: list[tuple], inner: list[tuple]) -> list[tuple[int, int]]:
    """Links between outsiders and members of one block that join different components. A pair is left
    to the first band it shares. Rows are (id, component, bits, bands, shingles)."""
    out: list[tuple[int, int]] = []
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    bits = np.stack([np.frombuffer(r[2], np.uint8) for r in inner])
    bands = np.stack([np.frombuffer(r[3], np.uint32) for r in inner])
    groups = np.array([r[1] for r in inner])
    for u, group, own_bits, own_bands, own in outer:
        mine = np.frombuffer(own_bands, np.uint32)
        at = int(np.flatnonzero(mine == np.uint32(band & 0xFFFFFFFF))[0])
        fits = groups != group
        if at:
            fits &= ~(bands[:, :at] == mine[:at]).any(axis=1)
        near = np.flatnonzero(fits)
        if not len(near):
            continue
        same = (bits[near] == np.frombuffer(own_bits, np.uint8)).mean(axis=1)
        estimate = (same - 1 / 256) / (1 - 1 / 256)
        near = near[estimate >= LEAST_ESTIMATE]
        estimate = estimate[estimate >= LEAST_ESTIMATE]
        own_set = np.frombuffer(own, np.uint64)
        for k in near[np.argsort(-estimate, kind="stable")].tolist():
            if root(group) != root(int(groups[k])) and linked(own_set, np.frombuffer(inner[k][4], np.uint64)):
                parent[root(group)] = root(int(groups[k]))
                out.append((u, inner[k][0]))
    return out


def _further_links(rows: DataFrame) -> DataFrame:
    """Links of all blocks, from rows sorted by block and side; a task holds one block at a time."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    names = ["band", "ob", "mb", "side", "doc_id", "component", "bits", "bands", "shingles"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark: tuple | None = None
        sides: tuple[list[tuple], list[tuple]] = ([], [])

        def close() -> pa.RecordBatch:
            found = _links_of_block(mark[0], *sides) if mark and sides[0] and sides[1] else []
            sides[0].clear()
            sides[1].clear()
            a, b = zip(*found) if found else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=schema)

        for batch in batches:
            for band, ob, mb, side, *row in zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names)):
                if (band, ob, mb) != mark:
                    yield close()
                    mark = (band, ob, mb)
                sides[side].append(tuple(row))
        yield close()

    return rows.select(*names).mapInArrow(work, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, one row per input row.

    Words are split at ASCII white space after lower-casing A-Z; a set holds the distinct five-word
    shingles. ``component_id`` is the smallest id reachable over links, ``kept`` marks that row. Null
    and empty texts and texts without words have no shingles and are linked with nothing. Rows that
    share an id are one document. A row without id takes the component of rows with the same set,
    else null, and is linked with no other. Other columns are not read.
    """
    rows = _rows(docs, id_col, text_col)
    sketched = saved(_sketched(rows), "sketches")
    # Equal sets are one vertex: the smallest document that has it. Counted map-side.
    firsts = saved(
        sketched.filter(F.col("set_id").isNotNull()).groupBy("set_id").agg(F.min("doc_id").alias("first")),
        "first-documents",
    )
    vertices = firsts.select(F.col("first").alias("doc_id"), "set_id")
    chosen = sketched.join(vertices, ["doc_id", "set_id"], "left_semi")
    members = chosen.select("doc_id", F.explode("bands").alias("band"))
    leaders = members.groupBy("band").agg(F.min("doc_id").alias("leader"), F.count(F.lit(1)).alias("size"))
    buckets = saved(
        members.join(leaders.filter(F.col("size") > 1), "band").select("band", "doc_id", "leader"), "buckets"
    )
    involved = buckets.select("doc_id").distinct()
    sets = saved(_full_sets(rows.join(involved, "doc_id", "left_semi")), "shingle-sets")

    # First each bucket against its leader: as many pairs as documents, however large the bucket.
    pairs = buckets.filter(F.col("doc_id") != F.col("leader")).select("leader", "doc_id").distinct()
    left = sets.select(F.col("doc_id").alias("leader"), F.col("shingles").alias("_a"), F.col("n").alias("_na"))
    right = sets.select("doc_id", F.col("shingles").alias("_b"), F.col("n").alias("_nb"))
    close = F.least("_na", "_nb") * 100 >= F.greatest("_na", "_nb") * LINK_PERCENT
    with_sizes = pairs.join(left.select("leader", "_na"), "leader").join(right.select("doc_id", "_nb"), "doc_id")
    found = (
        with_sizes.filter(close).select("leader", "doc_id")
        .join(right.select("doc_id", "_b"), "doc_id")
        .join(left.select("leader", "_a"), "leader")
        .filter(_linked("_a", "_b"))
        .select(F.col("leader").alias("a"), F.col("doc_id").alias("b"))
    )
    edges = saved(found, "leader-links")
    first_components = saved(components(edges), "leader-components")

    # Then, in buckets that are still in several components, the documents outside the leader's
    # component against all others, in blocks of bounded size.
    named = first_components.select(F.col("node").alias("doc_id"), "component")
    of_leader = first_components.select(F.col("node").alias("leader"), F.col("component").alias("_lead"))
    placed = buckets.join(named, "doc_id", "left").join(of_leader, "leader", "left").select(
        "band",
        "doc_id",
        F.coalesce("component", "doc_id").alias("component"),
        F.coalesce("_lead", "leader").alias("_lead"),
    ).withColumn("outside", (F.col("component") != F.col("_lead")).cast("int"))
    placed = saved(placed, "placed-buckets")
    mixed = placed.groupBy("band").agg(F.sum("outside").alias("_o"), F.count(F.lit(1)).alias("_m"))
    mixed = mixed.filter(F.col("_o") > 0).select(
        "band",
        F.ceil(F.col("_o") / BLOCK).cast("int").alias("_ob"),
        F.ceil(F.col("_m") / BLOCK).cast("int").alias("_mb"),
    )
    dealt = placed.join(mixed, "band").select("band", "doc_id", "component", "outside", "_ob", "_mb")
    spread = F.xxhash64("doc_id")
    all_of = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    outsiders = dealt.filter(F.col("outside") == 1).select(
        "band", "doc_id", "component", F.lit(0).alias("side"),
        F.pmod(spread, F.col("_ob")).cast("int").alias("ob"), F.explode(all_of("_mb")).alias("mb"),
    )
    others = dealt.select(
        "band", "doc_id", "component", F.lit(1).alias("side"),
        F.explode(all_of("_ob")).alias("ob"), F.pmod(spread, F.col("_mb")).cast("int").alias("mb"),
    )
    blocks = outsiders.unionByName(others).join(sets.drop("n"), "doc_id").repartition("band", "ob", "mb")
    rest = _further_links(blocks.sortWithinPartitions("band", "ob", "mb", "side"))
    more = saved(rest.distinct(), "further-links")
    final = components(edges.unionByName(more))

    reached = firsts.join(final.select(F.col("node").alias("first"), "component"), "first", "left").select(
        "set_id", F.coalesce("component", "first").alias("_component")
    )
    # A hot set is split by adaptive execution; the rows are small and nothing follows the join.
    joined = sketched.drop("bands").join(reached, "set_id", "left")
    component = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("_component"))
    return joined.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
