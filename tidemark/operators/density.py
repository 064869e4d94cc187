"""Density clustering over all rows: mutual reachability, Borůvka's tree, condensed hierarchy.

Equal vectors are one vertex with a weight. The core distance of a vertex is the distance to its
``min_samples``-th other row, the mutual reachability of two vertices the largest of their distance and
their core distances. Edges are ordered by (reachability, smaller id, larger id), so the minimum
spanning tree is unique and does not depend on how Spark deals out the rows.

Every round of the tree joins each component along its lightest outgoing edge. The edge comes from
the neighbour lists where these prove it: every vector outside a list is at least as far as the list's
end, so an edge below that bound of all vertices of a component is its lightest. Where no component has
such a proof, the cells around pivots are searched for the nearest vector of another component.

The hierarchy is condensed by contraction: a component of fewer than ``min_cluster_size`` rows joins
along its lightest edge, and what remains is a tree of dense groups. Clusters are chosen from it by
excess of mass.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import neighbours as N
from tidemark.session import cut_lineage

#: Neighbours listed per vertex, at least.
LISTED = 15
#: Distances below this count as this, where their inverse is taken.
LEAST_DISTANCE = 1e-9
#: Dense groups, each of at least ``min_cluster_size`` rows, whose tree one process selects clusters from.
MOST_GROUPS = 1_000_000
#: Rounds over at most so many edges are taken on the driver, with the same result: what is left of a
#: graph after a few rounds is too small to be worth jobs of its own.
LOCAL_ROWS = 100_000
NOISE = -1


def vertices(points: DataFrame, vector: str) -> DataFrame:
    """``id, v, weight`` of the distinct vectors of doubles; null vectors are left out."""
    values = F.transform(F.col(vector).cast("array<double>"), lambda c: c + F.lit(0.0))
    rows = points.select(values.alias("v")).filter("v IS NOT NULL")
    distinct = rows.groupBy("v").agg(F.count(F.lit(1)).alias("weight"))
    # Numbered in the order of the vectors, so that ids do not depend on the partitions.
    return cut_lineage(distinct.orderBy("v").withColumn("id", F.monotonically_increasing_id()))


def with_core_distances(placed: DataFrame, listed: DataFrame, k: int, min_samples: int) -> DataFrame:
    """``placed`` with ``near``, ``core`` and ``bound``: no vector outside the list is reached below it."""
    start = F.struct((F.col("weight") - 1).alias("seen"), F.lit(0.0).alias("d"))
    counted = F.aggregate(
        "near", start,
        lambda acc, x: F.when(acc["seen"] >= min_samples, acc).otherwise(
            F.struct((acc["seen"] + x["w"]).alias("seen"), x["d"].alias("d"))
        ),
    )["d"]
    none = F.array().cast(N.NEAR)
    joined = placed.join(listed, "id", "left").withColumn("near", F.coalesce("near", none))
    cored = joined.withColumn("core", counted)
    end = F.when(F.size("near") >= k, F.greatest("core", F.element_at("near", -1)["d"])).otherwise(F.lit(math.inf))
    return cored.withColumn("bound", end)


def listed_edges(nodes: DataFrame) -> DataFrame:
    """``lo, hi, w`` of all pairs in the neighbour lists, once."""
    pairs = nodes.select("id", "core", F.explode("near").alias("x")).select(
        F.col("id").alias("u"), "core", F.col("x.n").alias("other"), F.col("x.d").alias("d")
    )
    cores = nodes.select(F.col("id").alias("other"), F.col("core").alias("other_core"))
    return pairs.join(cores, "other").select(
        F.least("u", "other").alias("lo"), F.greatest("u", "other").alias("hi"),
        F.greatest("d", "core", "other_core").alias("w"),
    ).distinct()


# --- the tree --------------------------------------------------------------------------------


def _lightest(edges: DataFrame) -> DataFrame:
    """``comp, w, lo, hi, other``: the first edge of every component that has one."""
    both = edges.select(F.col("a").alias("comp"), F.struct("w", "lo", "hi", F.col("b").alias("other")).alias("e"))
    both = both.unionByName(
        edges.select(F.col("b").alias("comp"), F.struct("w", "lo", "hi", F.col("a").alias("other")).alias("e"))
    )
    return both.groupBy("comp").agg(F.min("e").alias("e")).select("comp", "e.*")


def _roots(pointers: DataFrame) -> DataFrame:
    """``comp, root`` of components that point to another (``comp, other``). Following lightest edges
    there is no cycle but of two, whose smaller one is the root."""
    back = pointers.select(F.col("comp").alias("other"), F.col("other").alias("again"))
    ends = F.when((F.col("again") == F.col("comp")) & (F.col("comp") < F.col("other")), F.col("comp"))
    state = cut_lineage(
        pointers.join(back, "other", "left").select("comp", F.coalesce(ends, "other").alias("root"))
    )
    while True:
        ahead = state.select(F.col("comp").alias("root"), F.col("root").alias("next"))
        state = cut_lineage(
            state.join(ahead, "root", "left").select(
                "comp", F.coalesce("next", "root").alias("root"),
                (F.coalesce("next", "root") != F.col("root")).alias("moved"),
            )
        )
        if not state.agg(F.max("moved")).first()[0]:
            return state.select("comp", "root")
        state = state.drop("moved")


def _renamed(df: DataFrame, column: str, roots: DataFrame) -> DataFrame:
    """``df`` with the components in ``column`` replaced by their roots."""
    names = roots.select(F.col("comp").alias(column), F.col("root").alias("_root"))
    return df.join(names, column, "left").withColumn(column, F.coalesce("_root", column)).drop("_root")


def _joined(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Edges between the joined components, the first of each pair."""
    moved = _renamed(_renamed(edges, "a", roots), "b", roots).filter("a <> b")
    pair = moved.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pair.agg(F.min(F.struct("w", "lo", "hi")).alias("e")).select("a", "b", "e.*")


def _outward(nodes: DataFrame, comps: DataFrame, cells: N.Cells, edges: DataFrame) -> DataFrame:
    """The lightest edge of every component out of all pairs of vectors (columns of ``_lightest``)."""
    placed = cut_lineage(nodes.select("id", "v", "cell", "core", "bound").join(comps, "id"))
    spans = placed.groupBy("cell").agg(F.min("comp").alias("least"), F.max("comp").alias("most")).collect()
    # One row per pivot: the component of cells that hold a single one.
    pure = np.full(len(cells.pivots), -1, dtype="int64")
    for r in spans:
        if r["least"] == r["most"]:
            pure[r["cell"]] = r["least"]
    # An edge that each component has anyway bounds the search: a listed one, or one to a vector of a
    # mixed cell or to the first vector of another cell.
    firsts = placed.groupBy("cell").agg(F.min_by(F.struct("id", "v", "core", "comp"), "id").alias("f")).collect()
    sample = (
        np.array([r["f"]["v"] for r in firsts], dtype="float64"), np.array([r["f"]["core"] for r in firsts]),
        np.array([r["f"]["comp"] for r in firsts]), np.array([r["f"]["id"] for r in firsts]),
    )

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, cores, kinds, ids = sample
        for whole in batches:
            for part in N.in_slices(whole.num_rows, len(ids)):
                batch = whole.slice(part.start, part.stop - part.start)
                own, core = batch.column(0).to_numpy(), batch.column(2).to_numpy()
                comp = batch.column(3).to_numpy()
                reach = np.maximum(np.maximum(N.distances(N.matrix(batch.column(1)), vectors), core[:, None]), cores)
                reach[comp[:, None] == kinds[None, :]] = np.inf
                best = reach.argmin(axis=1)
                w = reach[np.arange(len(own)), best]
                found = np.isfinite(w)
                own, best, w, comp = own[found], best[found], w[found], comp[found]
                other = ids[best]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (comp, kinds[best], w, np.minimum(own, other), np.maximum(own, other))],
                    ["a", "b", "w", "lo", "hi"],
                )

    probed = placed.select("id", "v", "core", "comp").mapInArrow(probe, "a bigint, b bigint, w double, lo bigint, hi bigint")
    known = edges.select("a", "b", "w", "lo", "hi").unionByName(probed)
    limits = cut_lineage(_lightest(known))
    asking = placed.join(limits.select("comp", F.col("w").alias("reach")), "comp", "left")
    asking = asking.select("id", "v", "cell", "core", "comp", F.coalesce("reach", F.lit(math.inf)).alias("reach"), "bound")
    # Only vertices that an unlisted vector may be that near to.
    asking = asking.filter("bound <= reach").drop("bound")

    folder = N.written_by_cell(placed.select("id", "v", "cell", "core", "comp"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, N.BLOCK_ROWS):
                yield _nearest_outside(whole.slice(at, N.BLOCK_ROWS), cells, pure, folder)

    found = N.dealt_to_tasks(asking, cells).mapInArrow(search, "a bigint, b bigint, w double, lo bigint, hi bigint")
    return cut_lineage(_lightest(known.unionByName(found)))


def _nearest_outside(asking: pa.RecordBatch, cells: N.Cells, pure: np.ndarray, folder: str) -> pa.RecordBatch:
    """The lightest edge (a, b, w, lo, hi) of each component from a block of its vertices, where it is not
    above what the component has anyway."""
    ids, core, comp, own = (asking[c].to_numpy() for c in ("id", "core", "comp", "cell"))
    rows = N.matrix(asking["v"])
    lower = cells.lower_bounds(own, N.distances(rows, cells.pivots))
    lower[pure[None, :] == comp[:, None]] = np.inf
    names, of = np.unique(comp, return_inverse=True)
    limit = np.full(len(names), np.inf)
    np.minimum.at(limit, of, asking["reach"].to_numpy())
    # Per component: the edge so far.
    best = [np.empty(0, dtype=t) for t in ("int64", "float64", "int64", "int64", "int64")]
    for batch in N.read_by_cell(folder, int(own.min()), int(own.max())):
        there, cell = N.matrix(batch["v"]), batch["cell"].to_numpy()
        other, cores, kinds = (batch[c].to_numpy() for c in ("id", "core", "comp"))
        end = limit[of]
        some = np.flatnonzero((lower[:, np.unique(cell)] <= end[:, None]).any(axis=1) & (core <= end))
        light = np.flatnonzero(cores <= limit.max())
        if not len(some) or not len(light):
            continue
        i, j = N.close_pairs(rows[some], there[light], end[some], (comp[some], kinds[light]))
        i, j = some[i], light[j]
        w = np.maximum(np.maximum(N.pair_distances(rows, there, i, j), core[i]), cores[j])
        kept = (w <= end[i]) & np.isfinite(w)
        i, j, w = i[kept], j[kept], w[kept]
        if not len(i):
            continue
        new = (of[i], w, np.minimum(ids[i], other[j]), np.maximum(ids[i], other[j]), kinds[j])
        every = [np.concatenate(x) for x in zip(best, new)]
        order = np.lexsort((every[3], every[2], every[1], every[0]))
        order = order[np.unique(every[0][order], return_index=True)[1]]
        best = [x[order] for x in every]
        limit[best[0]] = best[1]
    a, w, lo, hi, b = best
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (names[a], b, w, lo, hi)], ["a", "b", "w", "lo", "hi"])


class _Sets:
    """Disjoint sets whose name is their smallest member."""

    def __init__(self) -> None:
        self.above: dict[int, int] = {}

    def find(self, i: int) -> int:
        root = i
        while self.above.get(root, root) != root:
            root = self.above[root]
        while self.above.get(i, i) != root:
            self.above[i], i = root, self.above[i]
        return root

    def join(self, i: int, j: int) -> int:
        i, j = sorted((self.find(i), self.find(j)))
        self.above[j] = i
        return i


def _rounds_here(edges: list[tuple], bounds: dict[int, float]) -> tuple[list[tuple], _Sets, list[tuple], dict[int, float]]:
    """Rounds over listed edges (a, b, w, lo, hi) until none is proven: the tree's edges, the sets, and
    the edges and bounds that are left."""
    sets, tree, bounds = _Sets(), set(), dict(bounds)
    while True:
        first: dict[int, tuple] = {}
        for a, b, *e in edges:
            for c in (a, b):
                if c not in first or tuple(e) < first[c]:
                    first[c] = tuple(e)
        sure = {e for c, e in first.items() if e[0] < bounds[c]}
        if not sure:
            return sorted((lo, hi, w) for w, lo, hi in tree), sets, edges, bounds
        ends = {(w, lo, hi): (a, b) for a, b, w, lo, hi in edges}
        for e in sure:
            sets.join(*ends[e])
        tree |= sure
        joined: dict[int, float] = {}
        for c, bound in bounds.items():
            joined[sets.find(c)] = min(bound, joined.get(sets.find(c), math.inf))
        bounds = joined
        edges = [(sets.find(a), sets.find(b), *e) for a, b, *e in edges]
        edges = [e for e in edges if e[0] != e[1]]


def spanning_tree(nodes: DataFrame, cells: N.Cells) -> DataFrame:
    """``lo, hi, w``: the minimum spanning tree of the mutual reachability of all vertices."""
    spark = nodes.sparkSession
    edges = listed_edges(nodes)
    edges = cut_lineage(edges.withColumns({"a": F.col("lo"), "b": F.col("hi")}))
    comps = cut_lineage(nodes.select("id", F.col("id").alias("comp")))
    bounds = cut_lineage(nodes.select(F.col("id").alias("comp"), "bound"))
    tree = None
    while (left := bounds.count()) > 1:
        if max(left, edges.count()) <= LOCAL_ROWS:
            listed = [tuple(r) for r in edges.select("a", "b", "w", "lo", "hi").collect()]
            found, sets, listed, bound = _rounds_here(listed, dict(map(tuple, bounds.collect())))
            found = spark.createDataFrame(found, "lo bigint, hi bigint, w double")
            roots = spark.createDataFrame([(c, sets.find(c)) for c in sets.above], "comp bigint, root bigint")
            edges = spark.createDataFrame(listed, "a bigint, b bigint, w double, lo bigint, hi bigint")
            bounds = spark.createDataFrame(list(bound.items()), "comp bigint, bound double")
            tree = found if tree is None else tree.unionByName(found)
            comps = cut_lineage(_renamed(comps, "comp", roots))
            if len(bound) == 1:
                break
            sure = _outward(nodes, comps, cells, edges)
        else:
            sure = cut_lineage(_lightest(edges).join(bounds, "comp").filter("w < bound").drop("bound"))
            if sure.isEmpty():
                sure = _outward(nodes, comps, cells, edges)
        found = sure.select("lo", "hi", "w").distinct()
        tree = cut_lineage(found if tree is None else tree.unionByName(found))
        roots = _roots(sure.select("comp", "other"))
        edges = cut_lineage(_joined(edges, roots))
        comps = cut_lineage(_renamed(comps, "comp", roots))
        bounds = cut_lineage(_renamed(bounds, "comp", roots).groupBy("comp").agg(F.min("bound").alias("bound")))
    return tree if tree is not None else edges.select("lo", "hi", "w").limit(0)


# --- the hierarchy ---------------------------------------------------------------------------


def dense_groups(nodes: DataFrame, tree: DataFrame, min_cluster_size: int) -> tuple[DataFrame, DataFrame]:
    """Vertices with the dense group they belong to (``id, weight, comp, left_at``) and the tree between
    groups (``a, b, w``). ``left_at`` is the distance at which a vertex's component reaches
    ``min_cluster_size`` rows; vertices that never do have none."""
    edges = tree.withColumns({"a": F.col("lo"), "b": F.col("hi")})
    if nodes.count() <= LOCAL_ROWS:
        return _dense_groups_here(nodes, edges, min_cluster_size)
    alone = F.when(F.col("weight") >= min_cluster_size, F.col("core"))
    members = cut_lineage(nodes.select("id", "weight", F.col("id").alias("comp"), alone.alias("left_at")))
    sizes = cut_lineage(members.select("comp", F.col("weight").alias("size")))
    edges = cut_lineage(edges)
    while True:
        if sizes.count() <= LOCAL_ROWS:
            # Few enough are left: as vertices that weigh what they hold. Dense ones keep what they have.
            left = sizes.select(F.col("comp").alias("id"), F.col("size").alias("weight"), F.lit(None).cast("double").alias("core"))
            rest, between = _dense_groups_here(left, edges, min_cluster_size)
            rest = rest.select(F.col("id").alias("comp"), F.col("comp").alias("root"), F.col("left_at").alias("dense_at"))
            joined = members.join(rest, "comp").select(
                "id", "weight", F.col("root").alias("comp"), F.coalesce("left_at", "dense_at").alias("left_at")
            )
            return cut_lineage(joined), between
        small = _lightest(edges).join(sizes, "comp").filter(F.col("size") < min_cluster_size)
        small = cut_lineage(small.select("comp", "other", "w", "size"))
        if small.isEmpty():
            return members, edges.select("a", "b", "w")
        # Following lightest edges, small components end at a dense one or at two that face each other.
        ends = _roots(small.select("comp", "other"))
        size_of = lambda name: sizes.select(F.col("comp").alias(name), F.col("size").alias(f"{name}_size"))
        pairs = small.join(ends.filter("comp = root"), "comp").withColumnRenamed("other", "partner")
        pairs = pairs.join(size_of("partner"), "partner").select(
            "root", "partner", (F.col("size") + F.col("partner_size")).alias("both")
        )
        steps = small.join(ends, "comp").join(size_of("root"), "root").join(pairs, "root", "left")
        # What ends at a dense one is alone until its own edge, then joins that; where the two that face
        # each other stay small, they alone join.
        dense = F.coalesce("both", "root_size") >= min_cluster_size
        facing = F.coalesce((F.col("comp") == F.col("root")) | (F.col("comp") == F.col("partner")), F.lit(False))
        moves = cut_lineage(
            steps.filter(dense | facing).select("comp", "root", F.when(dense, F.col("w")).alias("dense_at"))
        )
        step = moves.select("comp", "root", "dense_at")
        members = cut_lineage(
            members.join(step, "comp", "left").select(
                "id", "weight", F.coalesce("root", "comp").alias("comp"), F.coalesce("left_at", "dense_at").alias("left_at")
            )
        )
        roots = moves.filter("comp <> root").select("comp", "root")
        sizes = cut_lineage(_renamed(sizes, "comp", roots).groupBy("comp").agg(F.sum("size").alias("size")))
        edges = cut_lineage(_renamed(_renamed(edges, "a", roots), "b", roots).filter("a <> b"))


def _dense_groups_here(nodes: DataFrame, edges: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """The same in one process: edges by weight; a set of fewer than ``least`` rows joins the group at
    the other end of its edge."""
    spark = nodes.sparkSession
    rows = nodes.select("id", "weight", "core").collect()
    groups, wholes = _Sets(), _Sets()
    size = {r["id"]: r["weight"] for r in rows}
    left_at = {r["id"]: r["core"] if r["weight"] >= least else None for r in rows}
    waiting = {r["id"]: [r["id"]] for r in rows if r["weight"] < least}
    joins = []
    for w, _, _, lo, hi in sorted((r["w"], r["lo"], r["hi"], r["a"], r["b"]) for r in edges.collect()):
        a, b = wholes.find(lo), wholes.find(hi)
        total = size[a] + size[b]
        if size[a] >= least and size[b] >= least:
            joins.append((lo, hi, w))
        else:
            small = waiting.pop(a, []) + waiting.pop(b, [])
            groups.join(lo, hi)
            if total >= least:
                for i in small:
                    left_at[i] = w
            else:
                waiting[min(a, b)] = small
        size[wholes.join(a, b)] = total
    members = [(r["id"], r["weight"], groups.find(r["id"]), left_at[r["id"]]) for r in rows]
    between = [(groups.find(lo), groups.find(hi), w) for lo, hi, w in joins]
    return (
        spark.createDataFrame(members, "id bigint, weight bigint, comp bigint, left_at double"),
        spark.createDataFrame(between, "a bigint, b bigint, w double"),
    )


@dataclass
class GroupTree:
    """Dense groups 0.. and, after them, what they join to: parents, and the distance of each join."""

    names: dict[int, int]
    parent: np.ndarray
    split: np.ndarray

    @classmethod
    def of(cls, groups: list[int], joins: list[tuple[float, int, int]]) -> GroupTree:
        names = {g: i for i, g in enumerate(sorted(groups))}
        size = 2 * len(names) - 1
        parent, split = np.full(size, -1), np.zeros(size)
        top = list(range(len(names)))

        def find(i: int) -> int:
            while top[i] != i:
                top[i] = top[top[i]]
                i = top[i]
            return i

        at = {i: i for i in top}
        for k, (w, a, b) in enumerate(sorted(joins)):
            node = len(names) + k
            x, y = find(names[a]), find(names[b])
            parent[at[x]] = parent[at[y]] = node
            split[node] = w
            top[y] = x
            at[x] = node
        return cls(names, parent, split)

    def place(self, group: np.ndarray, left_at: np.ndarray) -> np.ndarray:
        """The node in which each vertex leaves: the one that its group has become at that distance."""
        node = group.copy()
        while True:
            up = self.parent[node]
            move = (up >= 0) & (self.split[up] <= left_at)
            if not move.any():
                return node
            node = np.where(move, up, node)

    def chosen(self, rows: np.ndarray, density: np.ndarray) -> np.ndarray:
        """Per node the chosen node at or above it, -1 for none. ``rows`` and ``density`` are what leaves
        in each node: its rows and the sum of their 1 / distance."""
        count = len(self.parent)
        size, below = rows.astype("float64"), np.zeros(count)
        birth = np.where(self.parent >= 0, 1.0 / np.maximum(self.split[self.parent], LEAST_DISTANCE), 0.0)
        own = density.astype("float64")
        # Children come before their parents.
        for i in range(count):
            up = self.parent[i]
            own[i] -= birth[i] * size[i]
            if up >= 0:
                size[up] += size[i]
                own[up] += size[i] / max(self.split[up], LEAST_DISTANCE)
        best, keep = np.zeros(count), np.zeros(count, dtype=bool)
        for i in range(count):
            keep[i] = self.parent[i] >= 0 and own[i] >= below[i]
            best[i] = own[i] if keep[i] else below[i]
            if self.parent[i] >= 0:
                below[self.parent[i]] += best[i]
        found = np.full(count, NOISE)
        for i in range(count - 1, -1, -1):
            up = self.parent[i]
            found[i] = found[up] if up >= 0 and found[up] >= 0 else (i if keep[i] else NOISE)
        return found


def density_clusters(points: DataFrame, vector: str, min_cluster_size: int, min_samples: int) -> DataFrame:
    """``points`` with ``cluster_id``: -1 for noise, else 0.. by falling number of rows.

    A cluster is chosen where its rows stay together over a longer range of densities than those of
    the clusters it splits into; the whole is never one. Points without a vector are noise. Nothing is
    sampled, and equal vectors have one cluster.
    """
    spark = points.sparkSession
    nodes, cells = graph(points, vector, min_samples)
    if nodes is None:
        return points.withColumn("cluster_id", F.lit(NOISE))
    members, joins = dense_groups(nodes, spanning_tree(nodes, cells), min_cluster_size)
    groups = members.filter("left_at IS NOT NULL").select("comp").distinct()
    if groups.count() > MOST_GROUPS:
        raise ValueError(f"more than {MOST_GROUPS} dense groups: min_cluster_size is too small for these points")
    names = [r["comp"] for r in groups.collect()]
    if len(names) < 2:
        return points.withColumn("cluster_id", F.lit(NOISE))
    tree = GroupTree.of(names, [(r["w"], r["a"], r["b"]) for r in joins.collect()])
    group_of = pd.Series(tree.names)

    @F.pandas_udf("int")
    def leaves_in(comp: pd.Series, left_at: pd.Series) -> pd.Series:
        return pd.Series(tree.place(group_of[comp].to_numpy(), left_at.to_numpy()), dtype="int32")

    placed = members.filter("left_at IS NOT NULL").withColumn("node", leaves_in("comp", "left_at"))
    rows, density = np.zeros(len(tree.parent)), np.zeros(len(tree.parent))
    inverse = 1.0 / F.greatest("left_at", F.lit(LEAST_DISTANCE))
    sums = placed.groupBy("node").agg(F.sum("weight").alias("n"), F.sum(F.col("weight") * inverse).alias("s"))
    for r in sums.collect():
        rows[r["node"]], density[r["node"]] = r["n"], r["s"]
    found = tree.chosen(rows, density)
    total = pd.Series(rows).groupby(found).sum().drop(NOISE, errors="ignore")
    order = {c: i for i, c in enumerate(sorted(total.index, key=lambda c: (-total[c], c)))}
    numbers = [(i, order.get(c, NOISE)) for i, c in enumerate(found)]
    # At most two rows per dense group.
    table = spark.createDataFrame(numbers, "node int, cluster_id int")
    labels = placed.join(F.broadcast(table), "node").select("id", "cluster_id")
    by_vector = nodes.select("id", "v").join(labels, "id").select(F.col("v").alias("_v"), "cluster_id")
    return _labelled(points, vector, by_vector, F.coalesce("cluster_id", F.lit(NOISE)).alias("cluster_id"))


def graph(points: DataFrame, vector: str, min_samples: int) -> tuple[DataFrame | None, N.Cells | None]:
    """Vertices with neighbour lists and core distances, and their cells; nothing without points."""
    distinct = vertices(points, vector)
    first = distinct.select(F.size("v").alias("d")).first()
    if first is None:
        return None, None
    k = max(LISTED, min_samples)
    placed, cells = N.dealt_to_cells(distinct, first["d"])
    return cut_lineage(with_core_distances(placed, N.nearest_neighbours(placed, cells, k), k, min_samples)), cells


def _labelled(points: DataFrame, vector: str, by_vector: DataFrame, *columns: Column) -> DataFrame:
    values = F.transform(F.col(vector).cast("array<double>"), lambda c: c + F.lit(0.0))
    return points.withColumn("_v", values).join(by_vector, "_v", "left").select(*points.columns, *columns)


def density_components(points: DataFrame, vector: str, reach: float, min_samples: int) -> DataFrame:
    """``points`` with ``core_distance``, ``is_core`` and ``component``: the cut of the tree at ``reach``.

    A point is core if ``min_samples`` other rows are within ``reach``. Core points within ``reach`` of
    each other have one component, numbered by the smallest of its vertices; others have none."""
    nodes, cells = graph(points, vector, min_samples)
    if nodes is None:
        empty = [F.lit(None).cast(t).alias(c) for c, t in (("core_distance", "double"), ("is_core", "boolean"), ("component", "bigint"))]
        return points.select(*points.columns, *empty)
    cores = nodes.filter(F.col("core") <= reach)
    near = spanning_tree(nodes, cells).filter(F.col("w") <= reach)
    edges = cut_lineage(near.withColumns({"a": F.col("lo"), "b": F.col("hi")}))
    comps = cut_lineage(cores.select("id", F.col("id").alias("comp")))
    while not edges.isEmpty():
        roots = _roots(_lightest(edges).select("comp", "other"))
        comps = cut_lineage(_renamed(comps, "comp", roots))
        edges = cut_lineage(_joined(edges, roots))
    least = comps.groupBy("comp").agg(F.min("id").alias("component"))
    named = comps.join(least, "comp").select("id", "component")
    by_vector = nodes.select("id", F.col("v").alias("_v"), "core").join(named, "id", "left").drop("id")
    return _labelled(
        points, vector, by_vector, F.col("core").alias("core_distance"), F.col("component").isNotNull().alias("is_core"), "component"
    )
