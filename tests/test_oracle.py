"""Every registered query against its SQL in DuckDB, and what must hold for all of them."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from pyspark.sql import functions as F

from skymeter.plans import prediction

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = contract.queries()
ORACLE = contract.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def comparable(rows, order):
    def text(v):
        return "" if v is None else f"{type(v).__name__} {v + 0.0 if isinstance(v, float) else v}"

    return sorted([text(row[i]) for i in order] for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    result = duck.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    got = comparable([tuple(r) for r in df.collect()], [df.columns.index(c) for c in sorted(columns)])
    expected = comparable(result.fetchall(), [columns.index(c) for c in sorted(columns)])
    assert got == expected


# Corpus queries without SQL are compared with plain versions in tests of their own.
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - set(contract.CORPUS_QUERIES)))
def test_query_without_sql_beats_the_mean_and_repeats(spark, name):
    """Models whose errors SQL cannot compute: on two runs the same, and no worse than the mean label."""
    _, test = prediction._split(spark, FOLDER)
    spread = test.agg(F.stddev_pop("pm25")).first()[0]
    runs = [sorted(map(tuple, QUERIES[name](spark, FOLDER).collect()), key=str) for _ in range(2)]
    assert runs[0] and runs[0] == runs[1]
    for row in runs[0]:
        if name == "prediction_examples":
            assert len(runs[0]) == 20
        else:
            assert 0 < row[1] <= 1.1 * spread


def test_every_sql_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_no_query_uses_python_rows_or_cross_joins(spark):
    for name in sorted(set(QUERIES) - set(contract.CORPUS_QUERIES)):
        plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
            assert word not in plan, (name, word)


def test_scans_read_only_the_columns_of_the_query(spark):
    plan = QUERIES["top_index_lines"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "l_returnflag" not in plan
    plan = QUERIES["graph_edges"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "l_returnflag" not in plan
