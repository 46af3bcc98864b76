"""Exact top-k search by inner product with a pivot-distance index.

The components are turned into integers, so that scores are exact. A vector gets one
more coordinate that makes all of them equally long (``sqrt(M - |x|^2)``, with the
largest squared length ``M``); the distance from a query then falls as the inner product
grows, and the triangle inequality bounds it: ``|d(q, p) - d(x, p)|`` for any pivot ``p``.

The index keys every vector by its nearest pivot and the distance to it. Ranges of these
keys are cut into slices of bounded size, so a slice is a few annuli around one pivot; a
salt parts rows with equal keys. A block of queries first searches the innermost slice of
its own pivot, which gives every query a score to beat; then it goes to the pivots, and
of each to the slices, that may hold better ones. Within a slice a query expands from its
own distance outwards, annulus by annulus, and stops when the bound of the next annulus
cannot beat its tenth score. Pivots grow with the square root of the rows and are fitted
on a bounded sample of rows, which only affects speed.

Defined cases: vectors that are NULL or hold NULL or non-finite components take no part,
nor do rows without an id; components missing in shorter vectors count as 0; ties go to
the smaller id; rows with one id are candidates each, and never of a query with that id;
an empty table gives no rows. Scores are exact integers; vectors so long that they might
not fit in 64 bits are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skymeter.session import materialize, scratch

SCALE = 1024
TOP = 10
# Pivots: at least, for each square root of the rows, and at most.
LEAST_PIVOTS, PIVOTS_PER_ROOT, MOST_PIVOTS = 32, 1 / 8, 1_024
# Rows that pivots are fitted on, at most.
SAMPLE = 4_000
SLICE_ROWS = 4_096
# A slice's number is that of its partition above its own there.
SLICE_BITS = 24
# Slices of a partition, and partitions whose slices are listed together.
PARTITION_SLICES, LISTED_PARTITIONS = 16, 64
BLOCK_QUERIES = 256
ANNULUS_ROWS = 256
SEED = 11
# A score that any other reaches.
NO_SCORE = -(1 << 63)
# Squared lengths from which on products are added as integers, and those too large for that.
EXACT_IN_DOUBLE, MOST_SQUARED = 1 << 52, 1 << 62
# Distances are rounded; bounds give way by this much, relative to the longest vector.
SLACK = 1e-6


def integer_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, vector``: components as integers, valid rows only."""
    numbers = F.transform(F.col(embedding), lambda x: x.cast("double"))
    valid = F.forall(numbers, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(x))
    return vectors.filter(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & valid).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.transform(numbers, lambda x: F.floor(x * SCALE).cast("long")).alias("vector"),
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


class Pivots:
    """Pivots in the lengthened space, and how far vectors are from them."""

    def __init__(self, sample: np.ndarray, longest: int, count: int = LEAST_PIVOTS, seed: int = SEED):
        self.longest = float(longest)
        rng = np.random.default_rng(seed)
        points = self.lengthened(sample)
        distinct = np.unique(points, axis=0)
        self.points = distinct[rng.permutation(len(distinct))[:count]]
        for _ in range(5):  # a few rounds of k-means
            nearest = self.distances(points).argmin(axis=1)
            self.points = np.array(
                [points[nearest == i].mean(axis=0) if (nearest == i).any() else p for i, p in enumerate(self.points)]
            )

    def lengthened(self, vectors: np.ndarray) -> np.ndarray:
        values = vectors.astype(np.float64)
        rest = np.sqrt(np.maximum(self.longest - (values * values).sum(axis=1), 0))
        return np.concatenate([values, rest[:, None]], axis=1)

    def distances(self, points: np.ndarray) -> np.ndarray:
        squared = (points**2).sum(axis=1)[:, None] + (self.points**2).sum(axis=1) - 2 * points @ self.points.T
        return np.sqrt(np.maximum(squared, 0))

    def query_distances(self, queries: np.ndarray) -> np.ndarray:
        """From queries, whose further coordinate is 0."""
        values = queries.astype(np.float64)
        return self.distances(np.concatenate([values, np.zeros((len(values), 1))], axis=1))

    def scores(self, queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Exact inner products."""
        if self.longest < EXACT_IN_DOUBLE:
            return (queries.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)
        return queries @ vectors.T


def upper_bounds(
    queries: np.ndarray, to_pivot: np.ndarray, inner: np.ndarray, outer: np.ndarray, longest: float
) -> np.ndarray:
    """What no candidate of each annulus, between two distances from the pivot, scores more than."""
    squared = (queries.astype(np.float64) ** 2).sum(axis=1)
    slack = SLACK * (np.sqrt(longest) + np.sqrt(squared))
    far = to_pivot[:, None]
    nearest = np.maximum(np.maximum(inner - far, far - outer) - slack[:, None], 0)
    reach = squared[:, None] + longest
    return (reach - nearest**2) / 2 + 1e-9 * reach


def search_slice(
    queries: np.ndarray,
    query_ids: np.ndarray,
    to_pivot: np.ndarray,
    least: np.ndarray,
    vectors: np.ndarray,
    ids: np.ndarray,
    distances: np.ndarray,
    pivots: Pivots,
    top: int,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each query's best candidates of a slice sorted by distance: its number, ids and scores.

    ``least``: scores that candidates must reach.
    """
    starts = np.arange(0, len(ids), ANNULUS_ROWS)
    stops = np.minimum(starts + ANNULUS_ROWS, len(ids))
    bound = upper_bounds(queries, to_pivot, distances[starts], distances[stops - 1], pivots.longest)
    order = np.argsort(-bound, axis=1, kind="stable")
    best: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in queries]
    least = least.copy()
    # All queries take their next annulus; those that go to the same one go together.
    active = np.arange(len(queries))
    for step in range(len(starts)):
        annulus = order[active, step]
        go_on = bound[active, annulus] >= least[active]
        active, annulus = active[go_on], annulus[go_on]
        if not len(active):
            break
        for number in np.unique(annulus):
            rows = active[annulus == number]
            part = slice(starts[number], stops[number])
            scores = pivots.scores(queries[rows], vectors[part])
            for row, found in zip(rows, scores, strict=True):
                fit = (found >= least[row]) & (ids[part] != query_ids[row])
                if fit.any():
                    best[row].append((found[fit], ids[part][fit]))
                    kept_scores = np.concatenate([s for s, _ in best[row]])
                    kept_ids = np.concatenate([i for _, i in best[row]])
                    chosen = np.lexsort((kept_ids, -kept_scores))[:top]
                    best[row] = [(kept_scores[chosen], kept_ids[chosen])]
                    if len(chosen) == top:
                        least[row] = max(least[row], kept_scores[chosen[-1]])
    for row, found in enumerate(best):
        if found:
            yield row, found[0][1], found[0][0]


KEYED = "vec_id long, vector array<long>, pivot int, distance double"
SLICES = "slice long, pivot int, inner double, outer double, ids binary, distances binary, vectors binary"
BLOCKS = "pivot int, slice long, query_ids binary, queries binary"
CONCERNED = "pivot int, query_ids binary, queries binary, to_pivot binary, least binary"
VISITS = "slice long, query_ids binary, queries binary, to_pivot binary, least binary"
FOUND = "query_id long, vec_id long, score long"


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def _row(schema: str, *values: int | float | np.ndarray) -> pa.RecordBatch:
    """One row of numbers and arrays, these as bytes."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    columns = []
    for field, value in zip(schema.split(", "), values, strict=True):
        plain = value.tobytes() if isinstance(value, np.ndarray) else value
        columns.append(pa.array([plain], kinds[field.split()[1]]))
    return pa.RecordBatch.from_arrays(columns, _names(schema))


def _rows(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[dict]:
    """Rows one by one, their bytes seen as arrays where they lie."""
    kinds = {"distances": float, "to_pivot": float}
    for batch in batches:
        for i in range(batch.num_rows):
            row = {}
            for name, column in zip(batch.schema.names, batch.columns):
                if not pa.types.is_binary(column.type):
                    row[name] = column[i].as_py()
                elif column[i].is_valid:
                    values = np.frombuffer(column[i].as_buffer(), kinds.get(name, np.int64))
                    row[name] = values.reshape(-1, width) if name in ("vectors", "queries") else values
                else:
                    row[name] = None
            yield row


def _search(row: dict, least: np.ndarray, to_pivot: np.ndarray, pivots: Pivots, top: int):
    known = row["vectors"], row["ids"], row["distances"]
    return search_slice(row["queries"], row["query_ids"], to_pivot, least, *known, pivots, top)


class Index:
    """Slices of the vectors by pivot and distance, stored in the shared folder."""

    def __init__(self, vectors: DataFrame, pivots: Pivots, width: int):
        self.width = width
        self.shared = vectors.sparkSession.sparkContext.broadcast(pivots)
        # Stored with the salt, so that every later reading has the same.
        salted = self._keyed(vectors).withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
        keyed = materialize(salted, "pivot-keys")
        self.slices = materialize(self._sliced(keyed, keyed.count()), "pivot-slices")
        # One row per pivot.
        ends = self.slices.groupBy("pivot").agg(F.min("inner"), F.max("outer"), F.min("slice")).collect()
        self.rings = {r[0]: (r[1], r[2], r[3]) for r in ends}
        listed = F.shiftright("slice", SLICE_BITS) / LISTED_PARTITIONS
        directory = self.slices.groupBy("pivot", F.floor(listed).alias("list")).agg(
            F.collect_list(F.struct("slice", "inner", "outer")).alias("slices")
        )
        self.directory = materialize(directory.select("pivot", "slices"), "pivot-directory")

    def _keyed(self, vectors: DataFrame) -> DataFrame:
        shared, width = self.shared, self.width

        def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                pivots = shared.value
                far = pivots.distances(pivots.lengthened(_matrix(batch.column(1), width)))
                nearest = far.argmin(axis=1)
                columns = [*batch.columns, pa.array(nearest.astype(np.int32)), pa.array(far.min(axis=1))]
                yield pa.RecordBatch.from_arrays(columns, _names(KEYED))

        return vectors.mapInArrow(key, KEYED)

    def _sliced(self, keyed: DataFrame, rows: int) -> DataFrame:
        width = self.width

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number = TaskContext.get().partitionId() << SLICE_BITS
            held: list[pa.RecordBatch] = []

            def slice_of() -> pa.RecordBatch:
                rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held.clear()
                far = rows.column("distance").to_numpy()
                vectors = _matrix(rows.column("vector"), width).astype(np.int64)
                pivot = rows.column("pivot")[0].as_py()
                return _row(SLICES, number, pivot, far[0], far[-1], rows.column("vec_id").to_numpy(), far, vectors)

            for batch in batches:
                begin = 0
                pivots = batch.column("pivot").to_numpy()
                while begin < batch.num_rows:
                    if held and (held[0].column("pivot")[0].as_py() != pivots[begin] or sum(map(len, held)) >= SLICE_ROWS):
                        yield slice_of()
                        number += 1
                    room = SLICE_ROWS - sum(map(len, held))
                    end = begin + int(np.argmin(np.append(pivots[begin : begin + room] == pivots[begin], False)))
                    held.append(batch.slice(begin, end - begin))
                    begin = end
            if held:
                yield slice_of()

        parts = max(1, -(-rows // (SLICE_ROWS * PARTITION_SLICES)))
        placed = keyed.repartitionByRange(parts, "pivot", "distance", "salt")
        return placed.sortWithinPartitions("pivot", "distance", "salt").drop("salt").mapInArrow(cut, SLICES)

    def _blocks(self, queries: DataFrame) -> DataFrame:
        """Queries in blocks of one nearest pivot, due at its innermost slice."""
        shared, width, rings = self.shared, self.width, self.rings
        used = np.array(sorted(rings))

        def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, list[tuple[int, np.ndarray]]] = {}
            for batch in batches:
                vectors = _matrix(batch.column(1), width)
                homes = used[shared.value.query_distances(vectors)[:, used].argmin(axis=1)].tolist()
                for home, *row in zip(homes, batch.column(0).to_pylist(), vectors, strict=True):
                    rows = held.setdefault(home, [])
                    rows.append(tuple(row))
                    if len(rows) == BLOCK_QUERIES:
                        yield pack(home, held.pop(home))
            for home, rows in held.items():
                yield pack(home, rows)

        def pack(home: int, rows: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
            ids, vectors = (np.array(v, np.int64) for v in zip(*rows, strict=True))
            return _row(BLOCKS, home, rings[home][2], ids, vectors)

        return queries.mapInArrow(gather, BLOCKS)

    def _concerned(self, blocks: DataFrame, top: int) -> DataFrame:
        """The pivots that may hold better scores than a block's first slice, with the queries concerned."""
        shared, width, rings = self.shared, self.width, self.rings

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _rows(batches, width):
                ids, queries, pivots = row["query_ids"], row["queries"], shared.value
                far = pivots.query_distances(queries)
                least = np.full(len(ids), NO_SCORE)
                # Without that slice, no score is known to beat.
                if row["vectors"] is not None:
                    for number, found, scores in _search(row, least, far[:, row["pivot"]], pivots, top):
                        if len(found) == top:
                            least[number] = scores[-1]
                for pivot, (inner, outer, _) in rings.items():
                    ends = np.array([inner]), np.array([outer])
                    bound = upper_bounds(queries, far[:, pivot], *ends, pivots.longest)
                    some = np.flatnonzero(bound[:, 0] >= least)
                    if len(some):
                        yield _row(CONCERNED, pivot, ids[some], queries[some], far[some, pivot], least[some])

        first = self.slices.select("slice", "ids", "distances", "vectors")
        return blocks.join(first, "slice", "left").mapInArrow(search, CONCERNED)

    def visits(self, queries: DataFrame, top: int = TOP) -> DataFrame:
        """The slices that may hold better scores than a block's first slice, with the queries concerned."""
        shared, width = self.shared, self.width

        def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _rows(batches, width):
                ends = (np.array([s[end] for s in row["slices"]]) for end in ("inner", "outer"))
                bounds = upper_bounds(row["queries"], row["to_pivot"], *ends, shared.value.longest)
                for at, found in enumerate(row["slices"]):
                    some = np.flatnonzero(bounds[:, at] >= row["least"])
                    if len(some):
                        parts = (row[c][some] for c in ("query_ids", "queries", "to_pivot", "least"))
                        yield _row(VISITS, found["slice"], *parts)

        concerned = self._concerned(self._blocks(queries), top)
        return concerned.join(self.directory, "pivot").mapInArrow(chosen, VISITS)

    def top(self, queries: DataFrame, top: int = TOP) -> DataFrame:
        """``query_id, rank, vec_id, score`` of every query ``vec_id, vector``."""
        shared, width = self.shared, self.width

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _rows(batches, width):
                for number, found, scores in _search(row, row["least"], row["to_pivot"], shared.value, top):
                    ids = np.full(len(found), row["query_ids"][number])
                    columns = [pa.array(ids), pa.array(found), pa.array(scores)]
                    yield pa.RecordBatch.from_arrays(columns, _names(FOUND))

        return ranked(self.visits(queries, top).join(self.slices, "slice").mapInArrow(search, FOUND), top)


def ranked(found: DataFrame, top: int) -> DataFrame:
    """The best of all slices: higher scores first, then smaller ids."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, queries: Column, top: int = TOP, vec_id: str = "vec_id", embedding: str = "embedding"):
    """``query_id, rank, vec_id, score``: the ``top`` candidates of every row that is a query.

    ``queries`` is a condition on ``vec_id``.
    """
    spark = vectors.sparkSession
    valid = integer_vectors(vectors, vec_id, embedding)
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    seen = valid.agg(F.count(F.lit(1)), F.max(F.size("vector")), F.max(squares)).first()
    if not seen[0]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rows, width, longest = seen[0], max(1, seen[1]), seen[2]
    if longest >= MOST_SQUARED:
        raise ValueError(f"a vector has the squared length {longest:.3g}: scores might not fit in 64 bits")
    # Rows, not ids: an id may hold any number of them.
    sampled = valid.sample(min(1.0, 2 * SAMPLE / rows), SEED).limit(SAMPLE)
    held = [r[0] for r in sampled.select("vector").collect()]
    sample = np.zeros((max(1, len(held)), width), np.int64)
    for at, vector in enumerate(held):
        sample[at, : len(vector)] = vector
    count = min(MOST_PIVOTS, max(LEAST_PIVOTS, round(PIVOTS_PER_ROOT * rows**0.5)))
    with scratch(spark) as area:
        index = Index(valid, Pivots(sample, longest, count), width)
        return area.result(index.top(valid.filter(queries), top), "nearest")
