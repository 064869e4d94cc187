"""Exact nearest neighbours, and the nearest vector outside the own group, by cells around pivots.

Every vector belongs to the cell of its nearest pivot. A vector of another cell that is within some
distance of a query lies behind the plane halfway between the two pivots and inside the cell's radius,
so cells that are too far by either bound are not compared. Vectors are written once in the order of
their cells; every task reads them past its queries in blocks of a bounded number of vectors, so a
crowded cell is many tasks.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage, shared_folder

#: Pivots are broadcast: at most so many bytes of them, and no more than the root of the rows.
PIVOT_BYTES = 16 << 20
#: Vectors of one side in a block of comparisons.
BLOCK_ROWS = 2048
#: Cell bounds are loosened by this share, so that rounding never leaves out a cell.
SLACK = 1e-9
#: Squared distances by a product of matrices are loosened by this share of the squared lengths.
PRODUCT_SLACK = 1e-12
#: Bytes of a row group of the written vectors: a task holds a few.
ROW_GROUP_BYTES = 8 << 20

#: Random groupings that the approximate graph begins with.
GROUPINGS = 3

NEAR = "array<struct<d:double,n:bigint,w:bigint>>"


def matrix(vectors: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of a column of ``array<double>``."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    rows = len(vectors)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(rows, -1) if rows else np.empty((0, 0))


def distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Euclidean distances, the same number for a pair whichever side its vectors are on."""
    squares = np.zeros((len(left), len(right)))
    for a, b in zip(left.T, right.T):
        squares += (a[:, None] - b[None, :]) ** 2
    return np.sqrt(squares)


@dataclass(frozen=True)
class Cells:
    """The pivots, and per cell its radius and number of vectors."""

    pivots: np.ndarray
    radius: np.ndarray
    rows: np.ndarray

    def lower_bounds(self, own: np.ndarray, to_pivots: np.ndarray) -> np.ndarray:
        """Least possible distance of each query to a vector of each cell; 0 for the own cell."""
        between = distances(self.pivots[own], self.pivots)
        own_gap = to_pivots[np.arange(len(own)), own][:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = (to_pivots**2 - own_gap**2) / (2.0 * between)
        plane[between == 0.0] = 0.0
        found = np.maximum(np.maximum(plane, to_pivots - self.radius[None, :]), 0.0)
        found[np.arange(len(own)), own] = 0.0
        found[:, self.rows == 0] = np.inf
        return found * (1.0 - SLACK) - SLACK * own_gap


def in_slices(rows: int, columns: int, cells_at_once: int = 1 << 21) -> Iterator[slice]:
    step = max(1, cells_at_once // max(1, columns))
    for at in range(0, rows, step):
        yield slice(at, at + step)


def dealt_to_cells(vectors: DataFrame, dimension: int) -> tuple[DataFrame, Cells]:
    """``vectors`` (``id, v, weight``) with ``cell``, and the cells. Pivots are the vectors with the
    least hash of their id, so the same ones when a task runs again."""
    total = vectors.count()
    wanted = min(math.isqrt(max(0, total - 1)) + 1, PIVOT_BYTES // (8 * dimension))
    chosen = vectors.orderBy(F.xxhash64("id"), "id").limit(wanted).select("v").toPandas()
    pivots = np.array(chosen["v"].tolist(), dtype="float64").reshape(-1, dimension)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrix(batch.column(1))
            cell, gap = np.empty(len(rows), dtype="int32"), np.empty(len(rows))
            for part in in_slices(len(rows), len(pivots)):
                away = distances(rows[part], pivots)
                cell[part] = away.argmin(axis=1)
                gap[part] = away.min(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell), pa.array(gap)], ["id", "v", "weight", "cell", "gap"]
            )

    placed = cut_lineage(
        vectors.select("id", "v", "weight").mapInArrow(
            place, "id bigint, v array<double>, weight bigint, cell int, gap double"
        )
    )
    radius, rows = np.zeros(len(pivots)), np.zeros(len(pivots), dtype=int)
    # One row per pivot.
    for r in placed.groupBy("cell").agg(F.max("gap").alias("r"), F.count(F.lit(1)).alias("n")).collect():
        radius[r["cell"]], rows[r["cell"]] = r["r"], r["n"]
    return placed, Cells(pivots, radius, rows)


def written_by_cell(members: DataFrame) -> str:
    """A folder that every task can read, with the rows of ``members`` in the order of their cells."""
    folder = f"{shared_folder(members.sparkSession)}/tidemark-vectors-{uuid.uuid4().hex}"
    ordered = members.repartitionByRange("cell", "id").sortWithinPartitions("cell", "id")
    ordered.write.option("parquet.block.size", str(ROW_GROUP_BYTES)).parquet(folder)
    return folder


def read_by_cell(folder: str, first: int, last: int) -> Iterator[pa.RecordBatch]:
    """The written rows, a bounded block at a time, those of cells ``first`` to ``last`` before all others."""
    store, path = fs.FileSystem.from_uri(folder)
    rows = ds.dataset(path, filesystem=store, format="parquet")
    own = (ds.field("cell") >= first) & (ds.field("cell") <= last)
    for part in (own, ~own):
        for batch in rows.to_batches(filter=part, batch_size=BLOCK_ROWS, batch_readahead=1, fragment_readahead=1):
            if batch.num_rows:
                yield batch


def dealt_to_tasks(queries: DataFrame, cells: Cells) -> DataFrame:
    """``queries`` with those of a cell side by side, about a block of them in a task."""
    tasks = max(queries.sparkSession.sparkContext.defaultParallelism, int(cells.rows.sum()) // BLOCK_ROWS + 1)
    return queries.repartitionByRange(tasks, "cell", "id").sortWithinPartitions("cell", "id")


def close_pairs(
    left: np.ndarray, right: np.ndarray, limit: np.ndarray, kinds: tuple[np.ndarray, np.ndarray] | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Numbers (i, j) of all pairs within the left one's ``limit``, with a few that rounding lets through,
    of different ``kinds`` if these are given. The product of matrices is loosened by more than it can be off."""
    loose = 1.0 - PRODUCT_SLACK
    product = (2.0 * left) @ right.T
    product -= (right * right).sum(axis=1)[None, :] * loose
    near = product >= ((left * left).sum(axis=1) * loose - limit * limit)[:, None]
    if kinds is not None:
        near &= kinds[0][:, None] != kinds[1][None, :]
    return np.divmod(np.flatnonzero(near), len(right))


def pair_distances(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The same numbers as those of :func:`distances`, of the given pairs only."""
    squares = np.zeros(len(i))
    for a, b in zip(left.T, right.T):
        squares += (a[i] - b[j]) ** 2
    return np.sqrt(squares)


def _listed(ids: np.ndarray, rows: np.ndarray, own: np.ndarray, cells: Cells, k: int, folder: str) -> pa.RecordBatch:
    """``id, near`` of a block of queries against all written vectors."""
    lower = cells.lower_bounds(own, distances(rows, cells.pivots))
    gap, number = np.full((len(ids), k), np.inf), np.full((len(ids), k), np.iinfo("int64").max)
    weight = np.zeros((len(ids), k), dtype="int64")
    for batch in read_by_cell(folder, int(own.min()), int(own.max())):
        there, cell = matrix(batch["v"]), batch["cell"].to_numpy()
        other, heavy = batch["id"].to_numpy(), batch["weight"].to_numpy()
        end = gap[:, -1]
        asking = np.flatnonzero((lower[:, np.unique(cell)] <= end[:, None]).any(axis=1))
        if not len(asking):
            continue
        limit = end[asking]
        free = np.isinf(limit)
        if free.any() and len(other) > k:
            # One of the k + 1 nearest here may be the query itself.
            limit[free] = np.partition(distances(rows[asking[free]], there), k, axis=1)[:, k]
        i, j = close_pairs(rows[asking], there, limit)
        i = asking[i]
        away = pair_distances(rows, there, i, j)
        kept = (away <= end[i]) & (ids[i] != other[j]) & np.isfinite(away)
        i, j, away = i[kept], j[kept], away[kept]
        if not len(i):
            continue
        touched, at = np.unique(i, return_inverse=True)
        row = np.concatenate([np.repeat(np.arange(len(touched)), k), at])
        every = [
            np.concatenate([gap[touched].ravel(), away]), np.concatenate([number[touched].ravel(), other[j]]),
            np.concatenate([weight[touched].ravel(), heavy[j]]),
        ]
        order = np.lexsort((every[1], every[0], row))
        place = np.arange(len(row)) - np.searchsorted(row[order], row[order])
        order = order[place < k]
        gap[touched], number[touched], weight[touched] = (x[order].reshape(-1, k) for x in every)
    found = np.isfinite(gap)
    ends = np.concatenate([[0], np.cumsum(found.sum(axis=1))]).astype("int32")
    names = ["d", "n", "w"]
    entries = pa.StructArray.from_arrays([pa.array(x[found]) for x in (gap, number, weight)], names)
    return pa.RecordBatch.from_arrays([pa.array(ids), pa.ListArray.from_arrays(pa.array(ends), entries)], ["id", "near"])


def nearest_neighbours(placed: DataFrame, cells: Cells, k: int, queries: DataFrame | None = None) -> DataFrame:
    """``id, near``: the ``k`` nearest other vectors of each, nearest first (ties: the smaller id), all of
    them where there are fewer. Exact: every task reads the vectors past a block of queries, the own
    cells first, and leaves out cells that are farther than the lists reach. Neither queries nor lists
    are copied per cell, and memory does not depend on the rows.
    ``queries`` are the rows of ``placed`` to ask for, by default all."""
    folder = written_by_cell(placed.select("id", "v", "weight", "cell"))
    queries = (placed if queries is None else queries).select("id", "v", "cell")

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(at, BLOCK_ROWS)
                yield _listed(batch["id"].to_numpy(), matrix(batch["v"]), batch["cell"].to_numpy(), cells, k, folder)

    return cut_lineage(dealt_to_tasks(queries, cells).mapInArrow(lists, f"id bigint, near {NEAR}"))


# --- the approximate graph -------------------------------------------------------------------


def _offers(around: pa.Table) -> pa.Table:
    """Pairs of the vectors around one vertex, one of them new there, that are nearer than the end of
    the first one's list."""
    ids, new = around["m"].to_numpy(), around["new"].to_numpy(zero_copy_only=False).astype(bool)
    weight, end = around["weight"].to_numpy(), around["end"].to_numpy()
    away = distances(matrix(around["v"]), matrix(around["v"]))
    wanted = (new[:, None] | new[None, :]) & (ids[:, None] != ids[None, :]) & (away <= end[:, None])
    i, j = np.nonzero(wanted)
    return pa.table({"id": pa.array(ids[i]), "n": pa.array(ids[j]), "d": pa.array(away[i, j]), "w": pa.array(weight[j])})


def neighbour_graph(
    placed: DataFrame, k: int, around: int = 60, least_change: float = 0.002, most_rounds: int = 12
) -> tuple[DataFrame, int]:
    """``id, near`` as :func:`nearest_neighbours`, approximately, and the number of rounds: NN-descent.

    Lists begin with vectors of the same random groups, in several groupings: with one, random or by
    cells, no list would ever lead out of its group. In a round every vertex brings together the vectors that it lists and
    that list it, at most ``around`` of them and those first that came last, and each of these offers
    itself to the others. Rounds end when less than ``least_change`` of all entries are new. Work a
    round is rows x ``around``, whatever the dimension does to the cells; what belongs to a vertex that
    very many list is cut to ``around`` and to ``k`` in the map tasks.
    """
    total = placed.count()
    groups = max(1, total // around)
    random = placed.select(
        F.col("id").alias("m"), "v", "weight", F.lit(True).alias("new"), F.lit(math.inf).alias("end"),
        F.explode(F.array(*[F.lit(g) for g in range(GROUPINGS)])).alias("grouping"),
    )
    random = random.withColumn("at", F.pmod(F.xxhash64("grouping", "m"), F.lit(groups)))
    pairs = "id bigint, n bigint, d double, w bigint"
    nearest = Window.partitionBy("id").orderBy("d", "n")

    def ends_of_lists(every: DataFrame) -> DataFrame:
        return every.withColumn("r", F.row_number().over(nearest)).filter(F.col("r") <= k).drop("r")

    first = random.groupBy("grouping", "at").applyInArrow(_offers, pairs).distinct().withColumn("new", F.lit(True))
    lists = cut_lineage(ends_of_lists(first))
    rounds = 0
    for rounds in range(1, most_rounds + 1):
        both = lists.select(F.col("id").alias("at"), F.col("n").alias("m"), "new").unionByName(
            lists.select(F.col("n").alias("at"), F.col("id").alias("m"), "new")
        )
        both = both.groupBy("at", "m").agg(F.max("new").alias("new"))
        order = Window.partitionBy("at").orderBy(F.desc("new"), F.xxhash64(F.lit(rounds), "m"))
        some = both.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= around).drop("r")
        ends = lists.groupBy("id").agg(F.when(F.count(F.lit(1)) >= k, F.max("d")).alias("end"))
        vectors = placed.select("id", "v", "weight").join(ends, "id", "left").select(
            F.col("id").alias("m"), "v", "weight", F.coalesce("end", F.lit(math.inf)).alias("end")
        )
        offers = some.join(vectors, "m").groupBy("at").applyInArrow(_offers, pairs)
        every = lists.withColumn("new", F.lit(False)).unionByName(offers.withColumn("new", F.lit(True)))
        every = every.groupBy("id", "n").agg(F.min("d").alias("d"), F.max("w").alias("w"), F.min("new").alias("new"))
        lists = cut_lineage(ends_of_lists(every))
        if lists.filter("new").count() < least_change * k * total:
            break
    near = F.array_sort(F.collect_list(F.struct("d", "n", "w")))
    return lists.groupBy("id").agg(near.alias("near")), rounds


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the exact neighbours of ``exact`` that ``found`` lists."""
    both = exact.select("id", F.col("near").alias("want")).join(found, "id", "left")
    hits = F.size(F.array_intersect(F.transform("want", lambda x: x["n"]), F.transform("near", lambda x: x["n"])))
    row = both.agg(F.sum(F.coalesce(hits, F.lit(0))).alias("hits"), F.sum(F.size("want")).alias("all")).first()
    return row["hits"] / row["all"] if row["all"] else 1.0
