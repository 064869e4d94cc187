"""Whitening of embeddings on an integer grid.

The covariance is summed in whole numbers, so it does not depend on how Spark deals out the rows or
on tasks that run twice. Only matrices of the vectors' dimension reach the driver: the pivoted
Cholesky factor of the centred scatter is taken there and one-sided Jacobi rotations turn its columns
against each other until they are orthogonal; their lengths are the square roots of the eigenvalues,
their directions the components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, saved

#: Grid steps per unit.
GRID = 256
#: Entries are finite and below this, so that grid values and their distances to a centre are longs.
LARGEST = float(2**54)
#: Components returned.
COMPONENTS = 4
#: Bits of the parts that exact products are made of, and rows multiplied at once: 2 * 20 + 13 = 53.
PART_BITS, ROWS_AT_ONCE = 20, 1 << 13
#: Bits of the digits in which tasks hand over whole numbers of any size.
DIGIT_BITS = 30
MAX_SWEEPS = 60

DIGITS = "row int, digit int, numbers array<bigint>"
OUT = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
    "identity_error double, deviation_exact string"
)


def on_grid(vector: Column) -> Column:
    """Grid values of a vector; null where the vector or an entry is null, not finite or too large."""
    usable = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(LARGEST)))
    grid = F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(GRID))))
    return F.when(usable, grid)


# --- exact sums inside tasks -----------------------------------------------------------------


def _matrix(values: pa.Array, dimension: int) -> np.ndarray:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _parts(matrix: np.ndarray, bits: int) -> list[np.ndarray]:
    """The matrix as a sum of parts, part k times 2 ** (k * bits); all but the last are not negative."""
    parts = []
    while np.abs(matrix).max(initial=0) >= 1 << bits:
        parts.append(matrix & ((1 << bits) - 1))
        matrix = matrix >> bits
    return [*parts, matrix]


class ExactProducts:
    """Sum of z z' over rows z of longs, in whole numbers of any size."""

    def __init__(self, dimension: int):
        self.shape = (dimension, dimension)
        self.total = np.zeros(self.shape, dtype=object)
        self.open: dict[int, np.ndarray] = {}
        self.added = 0

    def add(self, rows: np.ndarray) -> None:
        for at in range(0, len(rows), ROWS_AT_ONCE):
            parts = [p.astype("float64") for p in _parts(rows[at : at + ROWS_AT_ONCE], PART_BITS)]
            for i, left in enumerate(parts):
                for j, right in enumerate(parts):
                    # Products of at most 2 ** 53 are exact in doubles.
                    product = (left.T @ right).astype("int64")
                    self.open[i + j] = self.open.get(i + j, np.zeros(self.shape, "int64")) + product
            self.added += len(parts)
            if self.added >= 256:
                self.close()

    def close(self) -> np.ndarray:
        for power, sums in self.open.items():
            self.total = self.total + sums.astype(object) * (1 << PART_BITS * power)
        self.open, self.added = {}, 0
        return self.total


def _digits(row: int, numbers: list[int]) -> Iterator[tuple[int, int, list[int]]]:
    """Whole numbers as signed digits, one tuple per digit that any of them needs."""
    signs = [-1 if v < 0 else 1 for v in numbers]
    left = [abs(int(v)) for v in numbers]
    digit = 0
    while any(left):
        yield row, digit, [s * (v & ((1 << DIGIT_BITS) - 1)) for s, v in zip(signs, left)]
        left = [v >> DIGIT_BITS for v in left]
        digit += 1


def _digit_batch(found: list[tuple[int, int, list[int]]]) -> pa.RecordBatch:
    rows, digits, numbers = zip(*found) if found else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(rows, pa.int32()), pa.array(digits, pa.int32()), pa.array(numbers, pa.list_(pa.int64()))],
        ["row", "digit", "numbers"],
    )


def _summed(partial: DataFrame, rows: int, dimension: int) -> np.ndarray:
    """The digits of all tasks added up by Spark, as whole numbers: rows x dimension."""
    cells = partial.repartition("row").select("row", "digit", F.posexplode("numbers").alias("at", "v"))
    total = np.zeros((rows, dimension), dtype=object)
    # At most rows x dimension x digits numbers, whatever the number of vectors.
    for r in cells.groupBy("row", "digit", "at").agg(F.sum("v").alias("v")).collect():
        total[r["row"], r["at"]] += r["v"] << DIGIT_BITS * r["digit"]
    return total


def vector_sums(fit: DataFrame, dimension: int) -> tuple[int, list[int]]:
    """Number of the vectors in ``x`` and their sum, exactly."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dimension, dtype=object)
        for batch in batches:
            rows = _matrix(batch.column(0), dimension)
            n += len(rows)
            for k, part in enumerate(_parts(rows, PART_BITS)):
                total = total + part.sum(axis=0).astype(object) * (1 << PART_BITS * k)
        yield _digit_batch([*_digits(0, list(total)), *_digits(1, [n] + [0] * (dimension - 1))])

    found = _summed(fit.select("x").mapInArrow(count, DIGITS), 2, dimension)
    return int(found[1, 0]), [int(v) for v in found[0]]


def centred_scatter(fit: DataFrame, centre: list[int]) -> np.ndarray:
    """Sum of (x - centre)(x - centre)' over the vectors in ``x``, exactly."""
    dimension = len(centre)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products = ExactProducts(dimension)
        middle = np.array(centre, dtype="int64")
        for batch in batches:
            products.add(_matrix(batch.column(0), dimension) - middle)
        total = products.close()
        for i in range(dimension):
            found = list(_digits(i, list(total[i])))
            if found:
                yield _digit_batch(found)

    return _summed(fit.select("x").mapInArrow(multiply, DIGITS), dimension, dimension)


# --- the decomposition -----------------------------------------------------------------------


def pivoted_cholesky(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower triangular ``f`` and order ``p`` with matrix[p][:, p] = f f'; as many columns as the
    matrix has rank. The largest remaining diagonal entry comes next (ties: the smaller index)."""
    size = len(matrix)
    left, order = matrix.astype("float64").copy(), np.arange(size)
    factor = np.zeros((size, size))
    least = size * np.finfo("float64").eps * max(float(left.diagonal().max(initial=0.0)), 0.0)
    for k in range(size):
        best = k + int(np.argmax(left.diagonal()[k:]))
        if left[best, best] <= least:
            return factor[:, :k], order
        for swapped in (left, left.T, factor, order):
            swapped[[k, best]] = swapped[[best, k]]
        factor[k:, k] = left[k:, k] / np.sqrt(left[k, k])
        left[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return factor, order


def orthogonal_columns(factor: np.ndarray) -> np.ndarray:
    """The columns of ``factor``, one per row, turned in pairs until all are orthogonal.

    Each round turns disjoint pairs, so that the pairs of a sweep come in rounds as in a tournament."""
    columns = factor.T.copy()
    count = len(columns)
    seats = np.arange(count + count % 2)
    half = len(seats) // 2
    tolerance = 4 * np.finfo("float64").eps
    for _ in range(MAX_SWEEPS):
        worst = 0.0
        for _ in range(max(0, len(seats) - 1)):
            p, q = seats[:half], seats[half:][::-1]
            playing = (p < count) & (q < count)
            p, q = p[playing], q[playing]
            x, y = columns[p], columns[q]
            xx, yy, xy = (x * x).sum(axis=1), (y * y).sum(axis=1), (x * y).sum(axis=1)
            cosine = np.abs(xy) / np.sqrt(np.where(xx * yy > 0, xx * yy, 1.0))
            worst = max(worst, float(cosine.max(initial=0.0)))
            turn = cosine > tolerance
            ratio = (yy[turn] - xx[turn]) / (2.0 * xy[turn])
            tangent = np.where(ratio >= 0, 1.0, -1.0) / (np.abs(ratio) + np.sqrt(1.0 + ratio * ratio))
            c = (1.0 / np.sqrt(1.0 + tangent * tangent))[:, None]
            s = c * tangent[:, None]
            columns[p[turn]], columns[q[turn]] = c * x[turn] - s * y[turn], s * x[turn] + c * y[turn]
            seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])
        if worst <= tolerance:
            break
    return columns


@dataclass(frozen=True)
class Whitening:
    """What whitens a vector of grid values; everything but the exact sums in doubles."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float

    def project(self, rows: np.ndarray) -> np.ndarray:
        """Whitened coordinates; a row's result does not depend on the rows beside it."""
        centred = rows - np.array([s / self.n for s in self.sums])
        scaled = self.components / np.sqrt(self.eigenvalues)[:, None]
        return np.stack([(centred * c).sum(axis=1) for c in scaled], axis=1)

    def deviation(self, rows: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S) ** 2, exactly."""
        reach = self.n * int(np.abs(rows).max(initial=0)) + max(map(abs, self.sums))
        if reach >= 1 << 62:
            away = rows.astype(object) * self.n - np.array(self.sums, dtype=object)
            return [int(v) for v in (away * away).sum(axis=1)]
        parts = _parts(rows * self.n - np.array(self.sums, dtype="int64"), PART_BITS)
        total = np.zeros(len(rows), dtype=object)
        for i, left in enumerate(parts):
            for j, right in enumerate(parts):
                total = total + (left * right).sum(axis=1).astype(object) * (1 << PART_BITS * (i + j))
        return [int(v) for v in total]


def decompose(n: int, sums: list[int], centre: list[int], scatter: np.ndarray, wanted: int) -> Whitening:
    """Leading components of the covariance; ``scatter`` is the sum of products around ``centre``."""
    off = np.array([s - n * c for s, c in zip(sums, centre)], dtype=object)
    whole = scatter * n - np.outer(off, off)
    covariance = np.array([[v / (n * n) for v in row] for row in whole], dtype="float64")
    factor, order = pivoted_cholesky(covariance)
    turned = orthogonal_columns(factor)
    lengths = np.sqrt((turned * turned).sum(axis=1))
    best = np.argsort(-lengths, kind="stable")[:wanted]
    components = np.zeros((len(best), len(sums)))
    components[:, order] = turned[best] / lengths[best, None]
    largest = np.abs(components).argmax(axis=1) if len(best) else np.empty(0, dtype=int)
    components *= np.sign(components[np.arange(len(best)), largest])[:, None]
    trace = sum(int(whole[i, i]) for i in range(len(sums))) / (n * n)
    return Whitening(n, sums, lengths[best] ** 2, components, trace)


# --- the operator ----------------------------------------------------------------------------


def fit_whitening(vectors: DataFrame, vec_col: str = "embedding", components: int = COMPONENTS) -> tuple[Whitening, DataFrame] | None:
    """The whitening of the distinct usable vectors, and those vectors as ``x``; None without any."""
    grid = vectors.select(on_grid(column(vec_col)).alias("x")).filter(F.size("x") > 0)
    distinct = saved(grid.groupBy("x").agg(F.count(F.lit(1)).alias("copies")), "grid-vectors")
    lengths = distinct.groupBy(F.size("x").alias("d")).agg(F.sum("copies").alias("rows"))
    common = lengths.orderBy(F.desc("rows"), F.desc("d")).first()
    if common is None:
        return None
    fit = distinct.filter(F.size("x") == common["d"]).select("x")
    n, sums = vector_sums(fit, common["d"])
    centre = [(2 * s + n) // (2 * n) for s in sums]
    return decompose(n, sums, centre, centred_scatter(fit, centre), components), fit


def identity_error(model: Whitening, fit: DataFrame) -> float:
    """Largest entry of the covariance of the whitened vectors less the identity."""
    k = len(model.components)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.project(_matrix(batch.column(0), len(model.sums)))
            yield pa.RecordBatch.from_arrays([pa.array(found[:, i]) for i in range(k)], [f"w{i}" for i in range(k)])

    whitened = fit.mapInArrow(project, ", ".join(f"w{i} double" for i in range(k)))
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    # Spark keeps central moments and merges those of the tasks.
    found = whitened.agg(*[F.covar_pop(f"w{i}", f"w{j}").alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error, deviation_exact`` per
    usable vector and leading component.

    Entries become grid values x = floor(256 * entry). The fit list has each distinct x once, however
    often it occurs; ``n`` is its size. Components are numbered by falling eigenvalue, the largest
    entry of each is positive.

    Rows whose vector is null, empty or holds a null, a NaN, an infinity or an entry of 2 ** 54 or
    more are left out, and so are vectors whose length is not that of most usable rows (ties: the
    longer). Null and repeated ids are kept, row by row. Components of eigenvalue zero have no whitened
    value: if the distinct vectors span fewer dimensions than components are wanted there are fewer,
    and with one distinct vector, or none, the result is empty. ``deviation`` is null where it does
    not fit a long; ``deviation_exact`` has all digits. Further columns are ignored.

    The distinct vectors are shuffled once, with copies combined in the map tasks. Sums come back as
    one matrix per task, added up by Spark; the driver gets a matrix of dimension x dimension.
    """
    spark = vectors.sparkSession
    fitted = fit_whitening(vectors, vec_col, components)
    if fitted is None or not len(fitted[0].components):
        return spark.createDataFrame([], OUT)
    model, fit = fitted
    error = identity_error(model, fit)
    dimension, k = len(model.sums), len(model.components)
    explained = model.eigenvalues / model.trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column(1), dimension)
            size = len(rows)
            away = np.array(model.deviation(rows), dtype=object).repeat(k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.arange(size).repeat(k))),
                    pa.array(np.tile(np.arange(1, k + 1), size), pa.int32()),
                    pa.array(np.full(size * k, model.n), pa.int64()),
                    pa.array([v if v < 1 << 63 else None for v in away], pa.int64()),
                    pa.array(model.project(rows).reshape(-1)),
                    pa.array(np.tile(explained, size)),
                    pa.array(np.full(size * k, error)),
                    pa.array([str(v) for v in away], pa.string()),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"],
            )

    usable = vectors.select(column(id_col).cast("long").alias("vec_id"), on_grid(column(vec_col)).alias("x"))
    return usable.filter(F.size("x") == dimension).mapInArrow(project, OUT)
