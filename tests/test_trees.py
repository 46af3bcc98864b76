"""The tree models, proven split by split with grouped sums in DuckDB, and their results recomputed in SQL."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas
import pytest
from pyspark.sql import functions as F

from skymeter.operators import regression
from skymeter.operators.regression import LABEL, fit_features, fit_models, predict
from skymeter.plans import prediction

FOLDER = "/root/testdata/sf0.001"
KEY = prediction.KEY
DEPTH = 5

pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="test tables not present")


class Node:
    """A node of a fitted tree: its condition as SQL, and its children."""

    def __init__(self, java, features, depth=0):
        self.prediction, self.depth, self.condition = java.prediction(), depth, None
        self.stats = list(java.impurityStats().stats())
        if java.getClass().getSimpleName() == "InternalNode":
            split = java.split()
            self.feature = features[split.featureIndex()]
            if split.getClass().getSimpleName() == "ContinuousSplit":
                self.condition = f"{self.feature} <= {split.threshold()!r}"
            else:
                left = ", ".join(str(c) for c in split.leftCategories())
                self.condition = f"{self.feature} IN ({left})"
            self.gain = java.gain()
            self.left = Node(java.leftChild(), features, depth + 1)
            self.right = Node(java.rightChild(), features, depth + 1)

    def sql(self):
        if self.condition is None:
            return repr(self.prediction)
        return f"CASE WHEN {self.condition} THEN {self.left.sql()} ELSE {self.right.sql()} END"

    def walk(self, path="true"):
        yield self, path
        if self.condition is not None:
            yield from self.left.walk(f"{path} AND {self.condition}")
            yield from self.right.walk(f"{path} AND NOT ({self.condition})")


@pytest.fixture(scope="module")
def fitted(spark):
    train, test = (side.persist() for side in prediction._split(spark, FOLDER))
    index = fit_features(train)
    models = fit_models(train, index, ["decision_tree", "random_forest"])
    duck = duckdb.connect()
    for name, side in (("train", train), ("test", test)):
        rows = index.transform(side).select(KEY, F.col("datetime").cast("string").alias("datetime"), "station", LABEL, *index.columns)
        duck.register(name, rows.toPandas())
    trees = {
        "decision_tree": [Node(models["decision_tree"]._call_java("rootNode"), index.columns)],
        "random_forest": [Node(t._call_java("rootNode"), index.columns) for t in models["random_forest"].trees],
    }
    yield duck, index, models, trees, train, test
    train.unpersist()
    test.unpersist()


def best_gain(duck, index, path):
    """Largest fall of the variance by any split of a node, and its rows, variance and mean.

    Values of a numeric feature are tried in their order, categories in that of their mean
    label, which holds the best of all ways to part them.
    """
    tries = []
    for feature in index.columns:
        order = "s / n" if feature.removesuffix("_index") in index.tables else "v"
        tries.append(f"SELECT n, s, q, row_number() OVER (ORDER BY {order}, v) AS place, '{feature}' AS feature FROM (" + (
            f"SELECT {feature} AS v, count(*) AS n, sum({LABEL}) AS s, sum({LABEL} * {LABEL}) AS q FROM node GROUP BY 1)"
        ))
    return duck.execute(f"""
        WITH node AS (SELECT * FROM train WHERE {path}),
        bins AS ({" UNION ALL ".join(tries)}),
        lefts AS (SELECT sum(n) OVER w AS n, sum(s) OVER w AS s, sum(q) OVER w AS q
                  FROM bins WINDOW w AS (PARTITION BY feature ORDER BY place)),
        whole AS (SELECT count(*) AS n, sum({LABEL}) AS s, sum({LABEL} * {LABEL}) AS q FROM node),
        gains AS (SELECT (w.s - l.s) * (w.s - l.s) / (w.n - l.n) + l.s * l.s / l.n - w.s * w.s / w.n AS gain
                  FROM lefts l, whole w WHERE l.n < w.n)
        SELECT coalesce((SELECT max(gain) FROM gains), 0) / n, n, q / n - s * s / n / n, s / n FROM whole""").fetchone()


def test_every_split_of_the_tree_is_the_best_one(fitted):
    duck, index, _, trees, _, _ = fitted
    inner = 0
    for node, path in trees["decision_tree"][0].walk():
        best, n, variance, mean = best_gain(duck, index, path)
        assert node.prediction == pytest.approx(mean, rel=1e-9)
        if node.condition is None:
            assert node.depth == DEPTH or n == 1 or best < 1e-9 * max(1.0, variance)
            continue
        inner += 1
        chosen = duck.execute(f"""
            SELECT (SELECT var_pop({LABEL}) FROM train WHERE {path})
              - (SELECT sum(n * v) / sum(n) FROM (SELECT count(*) AS n, var_pop({LABEL}) AS v FROM train
                 WHERE {path} GROUP BY {node.condition}))""").fetchone()[0]
        assert chosen == pytest.approx(best, rel=1e-6, abs=1e-9) and node.gain == pytest.approx(best, rel=1e-6, abs=1e-9)
    assert inner >= 10


@pytest.fixture(scope="module")
def bagged(spark, fitted):
    """The training rows in their layout, with how often each tree of the forest has drawn them."""
    _, index, _, trees, train, _ = fitted
    columns = [LABEL, *index.columns]
    laid = regression.in_stable_layout(index.transform(train).select(*columns, "features"), columns).select(*columns)
    parts = laid.rdd.glom().collect()
    rows = []
    for number, part in enumerate(parts):
        # The library draws for every row in turn, for every tree, with a seed for each partition.
        poisson = spark._jvm.org.apache.commons.math3.distribution.PoissonDistribution(1.0)
        poisson.reseedRandomGenerator(regression.SEED + number + 1)
        rows += [(*row, *(poisson.sample() for _ in trees["random_forest"])) for row in part]
    names = [*columns, *(f"w{i}" for i in range(len(trees["random_forest"])))]
    own = duckdb.connect()
    own.register("bagged", pandas.DataFrame(rows, columns=names))
    return own


def test_every_split_of_the_forest_is_the_best_of_its_feature(fitted, bagged):
    """On the rows that a tree has drawn. Which features a node may choose from is random, so only the chosen one counts."""
    _, index, _, trees, _, _ = fitted
    inner = 0
    for i, tree in enumerate(trees["random_forest"]):
        sums = f"sum(w{i}) AS n, sum(w{i} * {LABEL}) AS s, sum(w{i} * {LABEL} * {LABEL}) AS q"
        for node, path in tree.walk():
            n, total, squares = bagged.execute(f"SELECT {sums} FROM bagged WHERE {path}").fetchone()
            assert node.stats[:3] == pytest.approx([n, total, squares], rel=1e-9)
            assert node.prediction == pytest.approx(total / n, rel=1e-9)
            if node.condition is None:
                continue
            inner += 1
            order = "s / n" if node.feature.removesuffix("_index") in index.tables else "v"
            best = bagged.execute(f"""
                WITH bins AS (SELECT {node.feature} AS v, {sums} FROM bagged WHERE {path} AND w{i} > 0 GROUP BY 1),
                lefts AS (SELECT sum(n) OVER w AS n, sum(s) OVER w AS s FROM bins WINDOW w AS (ORDER BY {order}, v))
                SELECT max(({total} - s) * ({total} - s) / ({n} - n) + s * s / n - {total} * {total} / {n}) / {n}
                FROM lefts WHERE n < {n}""").fetchone()[0]
            assert node.gain == pytest.approx(best, rel=1e-6, abs=1e-6)
    assert inner >= 200


def test_trees_of_the_forest_add_up(fitted):
    """Each node's bootstrap rows are those of its children, and splits lower the variance."""
    duck, _, _, trees, _, _ = fitted
    rows = duck.execute("SELECT count(*) FROM train").fetchone()[0]
    roots = [tree.stats[0] for tree in trees["random_forest"]]
    assert len(roots) == 20 and len(set(roots)) > 1
    assert sum(roots) / len(roots) == pytest.approx(rows, rel=0.05)
    for tree in trees["random_forest"]:
        for node, _ in tree.walk():
            assert node.depth <= DEPTH
            if node.condition is not None:
                sides = [side.stats[:3] for side in (node.left, node.right)]
                assert [sum(v) for v in zip(*sides)] == pytest.approx(node.stats[:3]) and node.gain > 0


def predicted(trees):
    return f"({' + '.join(t.sql() for t in trees)}) / {len(trees)}"


def test_errors_and_examples_equal_sql(spark, fitted):
    duck, index, models, trees, _, test = fitted
    errors = {}
    for name in ("decision_tree", "random_forest"):
        sql = f"SELECT sqrt(avg(pow({LABEL} - {predicted(trees[name])}, 2))) FROM test"
        errors[name] = duck.execute(sql).fetchone()[0]
        query = {"decision_tree": "dt_rmse", "random_forest": "rf_rmse"}[name]
        assert prediction.QUERIES[query](spark, FOLDER).collect() == [(name, pytest.approx(errors[name], abs=1e-4))]
    compared = {r.model: r.rmse for r in prediction.QUERIES["model_comparison"](spark, FOLDER).collect()}
    assert {n: compared[n] for n in errors} == pytest.approx(errors, abs=1e-4)

    examples = prediction.QUERIES["prediction_examples"](spark, FOLDER).withColumn("datetime", F.col("datetime").cast("string"))
    expected = duck.execute(f"""
        SELECT datetime, station, {LABEL}, round({predicted(trees["decision_tree"])}, 6) FROM test
        ORDER BY datetime DESC, {KEY} LIMIT 20""").fetchall()
    assert [tuple(r) for r in examples.collect()] == [(*r[:3], pytest.approx(r[3], abs=1e-6)) for r in expected]


def test_each_prediction_equals_sql(fitted):
    duck, index, models, trees, _, test = fitted
    rows = predict(test, index, models).select(KEY, *models).collect()
    sql = ", ".join(f"{predicted(trees[n])} AS {n}" for n in models)
    expected = {r[0]: r[1:] for r in duck.execute(f"SELECT {KEY}, {sql} FROM test").fetchall()}
    assert len(rows) == len(expected) > 50
    assert all(tuple(r)[1:] == pytest.approx(expected[r[KEY]], rel=1e-9) for r in rows)
