from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skymeter.llm import nearest
from skymeter.llm.nearest import top_k

SCHEMA = "vec_id long, embedding array<float>, score string, rank string, pivot string"


def plain(rows, top=10, step=100):
    vectors = [
        (i, [math.floor(1024 * float(np.float32(x))) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    found = set()
    for query, q in vectors:
        if query % step == 0:
            scores = [(-sum(a * b for a, b in zip(q, v, strict=False)), i) for i, v in vectors if i != query]
            found |= {(query, i, -s) for s, i in sorted(scores)}
    return {
        (q, rank, i, s)
        for q in {f[0] for f in found}
        for rank, (s, i) in enumerate(ordered(found, q, top), 1)
    }


def ordered(found, query, top):
    return [(-s, i) for s, i in sorted((-s, i) for q, i, s in found if q == query)[:top]]


def check(spark, rows, top=10):
    df = spark.createDataFrame([(i, v, "x", "y", "z") for i, v in rows], SCHEMA)
    got = {tuple(r) for r in top_k(df, F.col("vec_id") % 100 == 0, top).select("query_id", "rank", "vec_id", "score").collect()}
    assert got == plain(rows, top)


@pytest.mark.parametrize("small", [False, True])
def test_random_vectors_equal_comparing_all(spark, monkeypatch, small):
    """Also with slices, blocks and annuli so small that there are many."""
    if small:
        for name, value in (("SLICE_ROWS", 20), ("BLOCK_QUERIES", 2), ("ANNULUS_ROWS", 4), ("LEAST_PIVOTS", 5), ("SAMPLE", 50),
                            ("PARTITION_SLICES", 3), ("LISTED_PARTITIONS", 2)):
            monkeypatch.setattr(nearest, name, value)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 12))
    vectors = centres[rng.integers(6, size=700)] + 0.2 * rng.normal(size=(700, 12))
    vectors *= rng.uniform(0.2, 3, size=(700, 1))
    check(spark, [(i, v.tolist()) for i, v in enumerate(vectors)], 10)


def test_ties_copies_and_few_candidates(spark):
    same = [0.5, -0.25, 1.0]
    check(spark, [(i, same) for i in range(0, 130)])
    check(spark, [(0, same), (100, [0.0, 0.0, 0.0]), (7, [-1.0, 0.0, 0.1])])
    check(spark, [(0, same)])


def test_edge_cases(spark):
    rows = [
        (0, [1.0, 2.0]), (100, [1.0]), (200, []), (-300, [0.5, 0.5, 0.5]), (1, None), (2, [1.0, None]),
        (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (None, [1.0, 1.0]), (5, [-1e-9, 3.0]), (400, [None]),
    ]
    check(spark, rows)
    assert top_k(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 100 == 0).count() == 0
    invalid = spark.createDataFrame([(1, None, "", "", "")], SCHEMA)
    assert top_k(invalid, F.col("vec_id") % 100 == 0).count() == 0


def test_bounds_hold_for_every_candidate():
    rng = np.random.default_rng(2)
    vectors, queries = rng.integers(-2000, 2000, (300, 8)), rng.integers(-2000, 2000, (20, 8))
    pivots = nearest.Pivots(vectors[:100], int((vectors**2).sum(axis=1).max()), 4)
    far = pivots.distances(pivots.lengthened(vectors))
    to_pivots = pivots.query_distances(queries)
    for p in range(len(pivots.points)):
        bound = nearest.upper_bounds(queries, to_pivots[:, p], far[:, p], far[:, p], pivots.longest)
        assert (queries @ vectors.T <= bound).all()


def test_repeated_rows_are_candidates_each(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [0.5, 0.0])]
    df = spark.createDataFrame([(i, v, "", "", "") for i, v in rows], SCHEMA)
    got = [tuple(r) for r in top_k(df, F.col("vec_id") % 100 == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 1024 * 1024), (0, 2, 1, 1024 * 1024), (0, 3, 2, 1024 * 512)]


def repeated_id_table(spark, monkeypatch):
    """Most rows have one id, and one pivot has several slices."""
    for name, value in (("SLICE_ROWS", 20), ("LEAST_PIVOTS", 1), ("PARTITION_SLICES", 2), ("ANNULUS_ROWS", 4)):
        monkeypatch.setattr(nearest, name, value)
    rng = np.random.default_rng(4)
    rows = [(7, v.tolist()) for v in rng.normal(size=(400, 6))]
    rows += [(i, v.tolist()) for i, v in zip((0, 100, 200, 1, 2), rng.normal(size=(5, 6)), strict=True)]
    return rows, spark.createDataFrame([(i, v, "", "", "") for i, v in rows], SCHEMA)


def plain_top(rows, query, top=10):
    whole = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows]
    q = dict(whole)[query]
    scores = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), i) for i, v in whole if i != query)
    return [(rank, i, -s) for rank, (s, i) in enumerate(scores[:top], 1)]


def test_rows_of_a_very_common_id_are_dealt_evenly(spark, monkeypatch):
    rows, df = repeated_id_table(spark, monkeypatch)
    vectors = nearest.integer_vectors(df)
    sample = np.array([r.vector for r in vectors.limit(50).collect()])
    longest = max((np.array(r.vector) ** 2).sum() for r in vectors.collect())
    index = nearest.Index(vectors, nearest.Pivots(sample, int(longest), 1), 6)
    sizes = [r[0] // 8 for r in index.slices.select(F.length("ids")).collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= nearest.SLICE_ROWS
    got = top_k(df, F.col("vec_id") % 100 == 0).collect()
    for query in (0, 100, 200):
        assert sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == query) == plain_top(rows, query)
    # A block whose first slice has no rows visits the others.
    first = index.rings[0][2]
    index.slices = index.slices.filter(f"slice <> {first}")
    assert {r.query_id for r in index.top(vectors.filter("vec_id % 100 = 0")).collect()} == {0, 100, 200}


def test_slices_are_ranges_of_distance(spark, monkeypatch):
    rows, df = repeated_id_table(spark, monkeypatch)
    vectors = nearest.integer_vectors(df)
    longest = max((np.array(r.vector) ** 2).sum() for r in vectors.collect())
    index = nearest.Index(vectors, nearest.Pivots(np.array([rows_of(vectors)[0]]), int(longest), 1), 6)
    slices = index.slices.orderBy("pivot", "inner").collect()
    assert len(slices) >= len(rows) // nearest.SLICE_ROWS
    assert all(a.outer <= b.inner for a, b in zip(slices, slices[1:]) if a.pivot == b.pivot)
    listed = [s for r in index.directory.collect() for s in r.slices]
    assert sorted((s.slice, s.inner, s.outer) for s in listed) == sorted((s.slice, s.inner, s.outer) for s in slices)


def rows_of(vectors):
    return [r.vector for r in vectors.limit(5).collect()]


def test_clustered_vectors_need_few_slices(spark, monkeypatch):
    for name, value in (("SLICE_ROWS", 50), ("LEAST_PIVOTS", 40), ("ANNULUS_ROWS", 10), ("PARTITION_SLICES", 8)):
        monkeypatch.setattr(nearest, name, value)
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(40, 16))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    values = centres[rng.integers(40, size=4000)] + 0.01 * rng.normal(size=(4000, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(values)]
    df = spark.createDataFrame([(i, v, "", "", "") for i, v in rows], SCHEMA)
    visited = []
    visits = nearest.Index.visits

    def counted(self, queries, top=10):
        found = visits(self, queries, top)
        pairs = sum(len(r.query_ids) // 8 for r in found.collect())
        visited.append(pairs / (queries.count() * self.slices.count()))
        return found

    monkeypatch.setattr(nearest.Index, "visits", counted)
    check(spark, rows)
    assert len(visited) == 1 and visited[0] < 0.2
    assert top_k(df, F.col("vec_id") == 0).count() == 10


def test_the_sample_is_bounded_though_one_id_has_most_rows(spark, monkeypatch):
    monkeypatch.setattr(nearest, "SAMPLE", 100)
    sizes = []
    start = nearest.Pivots.__init__

    def seen(self, sample, *rest):
        sizes.append(len(sample))
        start(self, sample, *rest)

    monkeypatch.setattr(nearest.Pivots, "__init__", seen)
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, 7, id) AS vec_id", "array(sin(id), cos(id)) AS embedding")
    assert top_k(rows, F.col("vec_id") == 100).count() == 10
    assert 50 <= sizes[0] <= 100


@pytest.mark.parametrize("size", [2.0**14, 2.0**19])
def test_large_components_stay_exact(spark, size):
    rng = np.random.default_rng(6)
    rows = [(i, [float(np.float32(x)) for x in size * rng.uniform(0.9, 1, 4)]) for i in range(150)]
    check(spark, rows)


def test_too_large_components_are_an_error(spark):
    df = spark.createDataFrame([(i, [2.0**21 + i, 1.0], "", "", "") for i in range(3)], SCHEMA)
    with pytest.raises(ValueError, match="64 bits"):
        top_k(df, F.col("vec_id") == 0)
