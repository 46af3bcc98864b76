from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from skymeter.operators.composite import anomaly_threshold, column_ranges, composite_index
from skymeter.operators.incremental import (
    append_state,
    index_state,
    merged_state,
    ranges_of,
    read_states,
    state_schema,
    threshold_of,
)

MEASURES = ("pm25", "pm10", "co")
SCHEMA = "id long, pm25 double, pm10 string, co double"


@pytest.fixture(scope="module")
def rows(spark):
    pm10 = F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 31 == 0, "text").otherwise((F.col("id") * 37 % 101).cast("string"))
    pm25 = F.when(F.col("id") % 11 == 0, float("nan")).otherwise(1000.0 + F.col("id") % 53)
    return spark.range(600).select("id", pm25.alias("pm25"), pm10.alias("pm10"), F.lit(5.0).alias("co"))


def whole(df):
    return tuple(column_ranges(df, MEASURES).first()), tuple(anomaly_threshold(composite_index(df, MEASURES)).first())


def of_state(state):
    return tuple(ranges_of(state, MEASURES).first()), tuple(threshold_of(state, MEASURES).first())


def grown(spark, parts, folder):
    for name, part in parts.items():
        append_state(index_state(part, MEASURES), folder, name)
    return merged_state(read_states(spark, folder, MEASURES), MEASURES)


def assert_equal(got, expected):
    assert got[0] == expected[0] and got[1] == pytest.approx(expected[1], rel=1e-8, abs=1e-10)


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_batches_add_up_to_the_whole(spark, rows, tmp_path, parts):
    """Also where a later batch widens the ranges."""
    split = {f"b{i}": rows.filter(F.floor(F.col("id") * parts / 600) == i) for i in range(parts)}
    state = grown(spark, split, str(tmp_path / "states"))
    assert_equal(of_state(state), whole(rows))
    assert state.first().n == composite_index(rows, MEASURES).filter("pollution_index IS NOT NULL").count()


def test_a_batch_that_comes_again_replaces_itself(spark, rows, tmp_path):
    folder = str(tmp_path / "states")
    halves = {"a": rows.filter("id < 300"), "b": rows.filter("id >= 300")}
    grown(spark, halves, folder)
    state = grown(spark, {"b": halves["b"]}, folder)
    assert_equal(of_state(state), whole(rows))
    assert read_states(spark, folder, MEASURES).count() == 2


def test_small_and_empty_batches(spark, rows, tmp_path):
    parts = {"none": rows.filter("false"), "one": rows.filter("id = 5"), "text": rows.filter("id = 31"), "two": rows.filter("id IN (8, 9)")}
    state = grown(spark, parts, str(tmp_path / "states"))
    assert_equal(of_state(state), whole(rows.filter("id IN (5, 31, 8, 9)")))
    for part in ("none", "one", "text"):
        alone = merged_state(index_state(parts[part], MEASURES), MEASURES)
        assert_equal(of_state(alone), whole(parts[part]))
    nothing = merged_state(spark.createDataFrame([], state_schema(MEASURES)), MEASURES)
    assert of_state(nothing) == ((0.0,) * 6, (0.0, 0.0, 0.0))


def test_a_state_is_one_scan_without_a_shuffle_of_rows(rows):
    plan = index_state(rows, MEASURES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Exchange SinglePartition" in plan
