"""Whitening of vectors by the leading components of their covariance.

Entries become integers, so their sums and each vector's difference from the mean, times
the number of vectors, are exact; only those differences are multiplied. Every task adds
up its part of the covariance, rows of the parts meet by row number, and the driver gets
one matrix of dimensions by dimensions. There it is made tridiagonal by Householder
reflections; bisection on Sturm counts gives the leading eigenvalues, inverse iteration
their vectors, those of close eigenvalues made orthogonal to each other after every step.
The components are broadcast, and every vector is projected in one more pass.

Defined cases: rows whose vector is NULL, or holds NULL, NaN or infinity, are dropped; NULL
ids and repeated rows are kept, one result each; other columns are ignored. Components
whose eigenvalue is zero to double precision are left out, so there may be fewer than
asked for, and none (no rows) if all vectors are equal. Equal eigenvalues: any orthonormal
basis, the same in every run on the same partitions. An empty table gives no rows. Vectors
of different lengths, longer than ``MOST_DIMENSIONS``, or with entries that do not fit are
an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skymeter.llm.batches import in_text_batches
from skymeter.session import materialize, scratch

# What a component of a vector is multiplied with, and what is added to it.
SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
# The covariance of so many dimensions takes 128 MB.
MOST_DIMENSIONS = 4096
# Entries up to here keep sums of 10^8 vectors and the differences within 64 bits.
LARGEST_ENTRY = 1 << 36

SEED = 3
# Inverse iteration: steps, and the part of the norm up to which eigenvalues are close.
STEPS = 5
CLOSE = 1e-3

EPSILON = np.finfo(float).eps


def integer_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, x``: the vectors that take part, their entries as integers."""
    chosen = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("c")
    )
    finite = F.forall("c", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = F.transform("c", lambda c: F.floor(c * SCALE).cast("long") + OFFSET)
    return chosen.filter(F.col("c").isNotNull() & finite).select("vec_id", x.alias("x"))


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def vector_sums(vectors: DataFrame) -> tuple[int, np.ndarray]:
    """Number of vectors and sums of each dimension, exact."""
    size = F.size("x")
    shape = vectors.agg(
        F.count(F.lit(1)).alias("n"),
        F.min(size).alias("least"),
        F.max(size).alias("most"),
        F.max(F.greatest(F.abs(F.coalesce(F.array_min("x"), F.lit(0))), F.abs(F.coalesce(F.array_max("x"), F.lit(0))))).alias("largest"),
    ).first()
    if not shape["n"]:
        return 0, np.zeros(0, np.int64)
    if shape["least"] != shape["most"]:
        raise ValueError(f"vectors have {shape['least']} to {shape['most']} entries")
    if shape["most"] > MOST_DIMENSIONS:
        raise ValueError(f"vectors have {shape['most']} entries, more than {MOST_DIMENSIONS}")
    if shape["largest"] > LARGEST_ENTRY:
        raise ValueError(f"an entry is {shape['largest']}, beyond {LARGEST_ENTRY}")
    dimensions = shape["most"]
    if not dimensions:
        return shape["n"], np.zeros(0, np.int64)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dimensions, np.int64)
        for batch in batches:
            total += _matrix(batch.column(0), dimensions).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(dimensions), pa.int32()), pa.array(total)], ["d", "s"])

    parts = vectors.select("x").mapInArrow(added, "d int, s long")
    rows = parts.groupBy("d").agg(F.sum("s").alias("s")).collect()
    return shape["n"], np.array([r["s"] for r in sorted(rows)], np.int64)


def differences(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - sums``, exact: Python's integers where 64 bits might not do."""
    largest = max(int(np.abs(x).max(initial=0)) * n, int(np.abs(sums).max(initial=0)))
    if largest < 1 << 62:
        return x * n - sums
    return x.astype(object) * n - sums.astype(object)


def deviations(difference: np.ndarray) -> np.ndarray:
    """Sums of squares of each row, exact; beyond 64 bits an error."""
    largest = int(np.abs(difference).max(initial=0))
    if largest * largest * max(1, difference.shape[1]) < 1 << 63:
        return (difference * difference).sum(axis=1).astype(np.int64)
    exact = (difference.astype(object) ** 2).sum(axis=1)
    return np.array([int(v) for v in exact], np.int64)


def _united(parts: DataFrame, dimensions: int) -> np.ndarray:
    """A symmetric matrix from the tasks' parts of its rows, ``i, task, row``, added in the order of tasks."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None
        for batch in batches:
            rows = batch.column(1).to_numpy(zero_copy_only=False)
            for i, row in zip(batch.column(0).to_pylist(), rows, strict=True):
                if i != at and at is not None:
                    yield _row(at, total)
                total = np.array(row) if i != at else total + row
                at = i
        if at is not None:
            yield _row(at, total)

    def _row(i: int, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([total])], ["i", "row"])

    dealt = parts.repartition("i").sortWithinPartitions("i", "task").select("i", "row")
    matrix = np.zeros((dimensions, dimensions))
    for i, row in dealt.mapInArrow(added, "i int, row array<double>").collect():
        matrix[i] = row
    return (matrix + matrix.T) / 2


def _products(batches: Iterator[np.ndarray], dimensions: int) -> Iterator[pa.RecordBatch]:
    """The rows of a task's sum of products of centred vectors."""
    total = np.zeros((dimensions, dimensions))
    for centred in batches:
        total += centred.T @ centred
    task = TaskContext.get().partitionId()
    columns = [
        pa.array(range(dimensions), pa.int32()),
        pa.array([task] * dimensions, pa.int32()),
        pa.ListArray.from_arrays(np.arange(0, dimensions * dimensions + 1, dimensions, dtype=np.int32), total.ravel()),
    ]
    yield pa.RecordBatch.from_arrays(columns, ["i", "task", "row"])


PARTS = "i int, task int, row array<double>"


def covariance(vectors: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """The covariance of the vectors, centred before anything is multiplied."""
    dimensions = len(sums)

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = (differences(_matrix(b.column(0), dimensions), n, sums) for b in batches)
        yield from _products(((d / n).astype(float) for d in exact), dimensions)

    return _united(vectors.select("x").mapInArrow(multiplied, PARTS), dimensions) / n


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the unit vectors of the Householder reflections."""
    a = matrix.copy()
    size = len(a)
    reflections = []
    for k in range(size - 2):
        x = a[k + 1 :, k]
        v = x.copy()
        v[0] += np.copysign(np.linalg.norm(x), x[0])
        length = np.linalg.norm(v)
        v = v / length if length > 0 else np.zeros_like(v)
        reflections.append(v)
        rest = a[k + 1 :, k + 1 :]
        p = 2 * (rest @ v)
        p -= v * (v @ p)
        rest -= np.outer(v, p) + np.outer(p, v)
        a[k + 1 :, k] -= 2 * v * (v @ a[k + 1 :, k])
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, points: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each point."""
    smallest = np.finfo(float).tiny / EPSILON
    squares = np.append(0.0, off * off)
    counts = np.zeros(len(points), np.int64)
    pivot = np.ones(len(points))
    for d, square in zip(diagonal, squares, strict=True):
        pivot = d - points - square / pivot
        pivot = np.where(np.abs(pivot) < smallest, -smallest, pivot)
        counts += pivot < 0
    return counts


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, most: int) -> np.ndarray:
    """The largest eigenvalues, falling, each by bisection until its bounds meet."""
    size = len(diagonal)
    reach = np.append(np.abs(off), 0.0) + np.append(0.0, np.abs(off))
    low, high = (diagonal - reach).min(), (diagonal + reach).max()
    slack = 2 * EPSILON * size * max(abs(low), abs(high))
    wanted = size - np.arange(min(most, size))
    lows, highs = np.full(len(wanted), low - slack), np.full(len(wanted), high + slack)
    while True:
        middle = lows + (highs - lows) / 2
        open_ = (middle > lows) & (middle < highs)
        if not open_.any():
            return middle
        # The k-th smallest is below a point that has k eigenvalues below it.
        above = sturm_counts(diagonal, off, middle) >= wanted
        highs = np.where(open_ & above, middle, highs)
        lows = np.where(open_ & ~above, middle, lows)


def _solved(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, least: float) -> np.ndarray:
    """Solution of the shifted tridiagonal system, by elimination with row exchanges."""
    size = len(diagonal)
    d, b = diagonal - shift, right.copy()
    above, second, below = np.append(off, 0.0), np.zeros(size), off.copy()
    for i in range(size - 1):
        if abs(below[i]) > abs(d[i]):
            d[i], below[i] = below[i], d[i]
            above[i], d[i + 1] = d[i + 1], above[i]
            second[i], above[i + 1] = above[i + 1], second[i]
            b[i], b[i + 1] = b[i + 1], b[i]
        if abs(d[i]) < least:
            d[i] = least
        factor = below[i] / d[i]
        d[i + 1] -= factor * above[i]
        above[i + 1] -= factor * second[i]
        b[i + 1] -= factor * b[i]
    if abs(d[-1]) < least:
        d[-1] = least
    x = np.zeros(size + 2)
    for i in range(size - 1, -1, -1):
        x[i] = (b[i] - above[i] * x[i + 1] - second[i] * x[i + 2]) / d[i]
    return x[:size]


def eigenvectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of a tridiagonal matrix, one column each, by inverse iteration.

    After every step a vector is made orthogonal to the others of its cluster, those
    whose eigenvalues are close. Equal eigenvalues are moved apart a little for the
    iteration. Where the matrix falls apart, vectors still start in all of its parts.
    """
    size = len(diagonal)
    norm = (np.abs(diagonal) + np.append(np.abs(off), 0.0) + np.append(0.0, np.abs(off))).max()
    rng = np.random.default_rng(SEED)
    found = np.zeros((size, len(values)))
    first, last = 0, np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLOSE * norm:
            first = k
        shift = value
        if k > first and last - shift < 10 * EPSILON * norm:
            shift = last - 10 * EPSILON * norm
        last = shift
        x = rng.uniform(-1, 1, size)
        for _ in range(STEPS):
            x /= np.abs(x).max()
            x = _solved(diagonal, off, shift, x, EPSILON * norm)
            for _ in range(2):  # once more, since the first time leaves what cancels
                x -= found[:, first:k] @ (found[:, first:k].T @ x)
            x /= np.linalg.norm(x)
        found[:, k] = x
    return found


def leading_components(matrix: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns.

    Those that are zero to double precision are left out.
    """
    if not len(matrix):
        return np.zeros(0), np.zeros((0, 0))
    scale = np.abs(matrix).max()
    if scale == 0:
        return np.zeros(0), np.zeros((len(matrix), 0))
    diagonal, off, reflections = tridiagonal(matrix / scale)
    values = leading_eigenvalues(diagonal, off, most)
    values = values[values > EPSILON * len(matrix) * np.abs(values).max(initial=0)]
    vectors = eigenvectors(diagonal, off, values)
    for k in range(len(reflections) - 1, -1, -1):
        v = reflections[k]
        vectors[k + 1 :] -= 2 * np.outer(v, v @ vectors[k + 1 :])
    return values * scale, vectors


def _projected(vectors: DataFrame, n: int, sums: np.ndarray, weights: np.ndarray) -> DataFrame:
    """``vec_id, deviation, whitened``: each vector on all components."""
    spark: SparkSession = vectors.sparkSession
    shared = spark.sparkContext.broadcast(weights)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dimensions, components = shared.value.shape
        for batch in batches:
            difference = differences(_matrix(batch.column(1), dimensions), n, sums)
            whitened = (difference / n).astype(float) @ shared.value
            offsets = np.arange(0, whitened.size + 1, components, dtype=np.int32)
            columns = [
                batch.column(0),
                pa.array(deviations(difference)),
                pa.ListArray.from_arrays(offsets, np.ascontiguousarray(whitened).ravel()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "deviation", "whitened"])

    return vectors.mapInArrow(project, "vec_id long, deviation long, whitened array<double>")


def identity_error(projected: DataFrame, n: int, components: int) -> float:
    """Largest entry of the covariance of ``whitened`` minus the identity."""
    means = projected.select(F.posexplode("whitened")).groupBy("pos").agg(F.sum("col").alias("s")).collect()
    mean = np.array([r["s"] for r in sorted(means)]) / n

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _products((_matrix(b.column(0), components) - mean for b in batches), components)

    found = _united(projected.select("whitened").mapInArrow(multiplied, PARTS), components) / n
    return float(np.abs(found - np.eye(components)).max())


WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row per vector and leading component: its whitened value, and how well the whole came out."""
    spark = vectors.sparkSession
    with scratch(spark) as area:
        # Long vectors make large batches, so these have few rows.
        stored = in_text_batches(materialize(integer_vectors(vectors, vec_id, embedding), "integer-vectors"))
        n, sums = vector_sums(stored)
        if not len(sums):
            return spark.createDataFrame([], WHITENED)
        matrix = covariance(stored, n, sums)
        values, found = leading_components(matrix, components)
        if not len(values):
            return spark.createDataFrame([], WHITENED)
        projected = area.result(_projected(stored, n, sums, found / np.sqrt(values)), "whitened")
        error = identity_error(projected, n, len(values))
    explained = F.array(*[F.lit(float(v)) for v in values / np.trace(matrix)])
    rows = projected.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, "at").alias("explained"),
        F.lit(error).alias("identity_error"),
    )
