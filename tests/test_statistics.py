from __future__ import annotations

import math
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skymeter.operators.composite import (
    RANGE_EPSILON,
    anomalies,
    anomaly_count,
    anomaly_threshold,
    column_ranges,
    composite_index,
    min_max_normalize,
    top_rows,
)
from skymeter.operators.stats import by_key, group_stats, mean_by, ranked_by_mean, stats_by_each

NAN = float("nan")
RELAXED = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@pytest.fixture
def readings(spark):
    rows = [("a", 1.0), ("a", 3.0), ("a", NAN), ("a", None), ("b", 2.0), ("c", 5.0), ("d", None)]
    return spark.createDataFrame(rows, "station string, pm25 double")


def test_group_stats_skip_null_and_nan(readings, collected):
    got = collected(group_stats(readings, "station", "pm25", ("mean", "max", "min", "count")))
    assert got == [
        ("a", 2.0, 3.0, 1.0, 2), ("b", 2.0, 2.0, 2.0, 1), ("c", 5.0, 5.0, 5.0, 1), ("d", None, None, None, 0)
    ]


def test_ranking_breaks_ties_by_key_and_puts_unknown_means_last(readings):
    got = [tuple(r) for r in ranked_by_mean(readings, "station", "pm25", 20, ("mean", "max")).collect()]
    assert got == [("c", 5.0, 5.0), ("a", 2.0, 3.0), ("b", 2.0, 2.0), ("d", None, None)]
    assert ranked_by_mean(readings, "station", "pm25", 1).collect()[0].station == "c"


def test_mean_by_is_in_key_order(readings):
    assert [r.station for r in mean_by(readings, "station", "pm25", 3).collect()] == ["a", "b", "c"]


def test_missing_becomes_zero_and_malformed_becomes_null(spark, collected):
    rows = [(1, "0"), (2, "10"), (3, None), (4, "NA"), (5, "NaN"), (6, "5")]
    df = spark.createDataFrame(rows, "i int, pm10 string")
    got = collected(min_max_normalize(df, ["pm10"]), "i", "pm10_norm")
    top = 10 / (10 + RANGE_EPSILON)
    assert got == [(1, 0.0), (2, top), (3, 0.0), (4, None), (5, 0.0), (6, 5 / (10 + RANGE_EPSILON))]
    assert top < 1


def test_constant_and_empty_measures(spark, collected):
    df = spark.createDataFrame([(4.0, None), (4.0, None)], "x double, y double")
    assert tuple(column_ranges(df, ["x", "y"]).first()) == (4.0, 4.0, 0.0, 0.0)
    scored = composite_index(df, ["x", "y"])
    assert collected(scored, "x_norm", "y_norm", "pollution_index") == [(0.0, 0.0, 0.0)] * 2


def test_index_divides_by_the_number_of_measures(spark):
    df = spark.createDataFrame([(0.0, None), (10.0, None)], "x double, y double")
    assert composite_index(df, ["x", "y"]).agg(F.max("pollution_index")).first()[0] == pytest.approx(0.5)


def test_malformed_measure_nulls_the_index_and_sorts_last(spark):
    df = spark.createDataFrame([(1, "1"), (2, "NA"), (3, "2")], "i int, x string")
    scored = composite_index(df, ["x"])
    assert [r.i for r in top_rows(scored, "pollution_index", ["i"], 3).collect()] == [3, 1, 2]
    assert 2 not in [r.i for r in anomalies(scored, sigmas=-10.0).collect()]


def test_threshold_of_one_row_or_none(spark):
    one = spark.createDataFrame([(0.5,)], "pollution_index double")
    assert tuple(anomaly_threshold(one).first()) == (0.5, 0.0, 0.5)
    assert anomalies(one).count() == 0
    assert tuple(anomaly_threshold(one.filter("false")).first()) == (0.0, 0.0, 0.0)
    assert tuple(anomaly_count(one.filter("false")).first()) == (0, 0)


values = st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6), st.just(NAN)), min_size=2, max_size=40)


@RELAXED
@given(xs=values)
def test_normalised_values_and_anomalies_match_plain_python(spark, xs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double").repartition(3)
    scored = composite_index(df, ["x"])
    got = {r.i: r.pollution_index for r in scored.collect()}
    known = [x for x in xs if x is not None and not math.isnan(x)]
    low, high = (min(known), max(known)) if known else (0.0, 0.0)
    for i, x in enumerate(xs):
        missing = x is None or math.isnan(x)
        assert got[i] == pytest.approx(0.0 if missing else (x - low) / (high - low + RANGE_EPSILON))
        assert 0 <= got[i] <= 1
    limit = statistics.mean(got.values()) + 1.0 * statistics.stdev(got.values())
    found = {r.i for r in anomalies(scored, sigmas=1.0).collect()}
    clear = {i for i, v in got.items() if abs(v - limit) > 1e-9}
    assert found & clear == {i for i in clear if got[i] > limit}
    assert anomaly_count(scored, sigmas=1.0).first().n_anomalies == len(found)


def test_index_needs_no_join_and_scans_three_times(spark, tmp_path):
    path = str(tmp_path / "x")
    spark.range(100).select("id", F.rand(1).alias("x"), F.rand(2).alias("unused")).write.parquet(path)
    found = anomalies(composite_index(spark.read.parquet(path), ["x"])).select("id")
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")
    assert "Join" not in plan and "Cartesian" not in plan
    assert "unused" not in plan
    assert plan.count("ReusedSubquery") > 0 and len(final) > 1


def test_stats_by_each_equals_separate_groupings_in_one_scan(spark, collected, tmp_path):
    rows = [("a", 1, 1.0), ("a", 2, 3.0), (None, 1, 5.0), ("b", None, NAN), ("b", 1, None)]
    path = str(tmp_path / "x")
    spark.createDataFrame(rows, "station string, hour int, pm25 double").write.parquet(path)
    df = spark.read.parquet(path)
    stats = stats_by_each(df, ["station", "hour"], "pm25")
    for key in ("station", "hour"):
        expected = collected(group_stats(df, key, "pm25", ("mean", "max")))
        assert collected(by_key(stats, key, "pm25", ("mean", "max"))) == expected
    assert stats._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_listings_keep_every_group(spark):
    years = spark.range(30).select((F.col("id") + 1990).alias("year"), F.lit(1.0).alias("pm25"))
    assert [r.year for r in mean_by(years, "year", "pm25").collect()] == list(range(1990, 2020))
    hours = spark.range(26).select((F.col("id") - 1).alias("hour"), F.col("id").cast("double").alias("pm25"))
    assert [r.hour for r in mean_by(hours, "hour", "pm25").collect()] == list(range(-1, 25))
    assert ranked_by_mean(hours, "hour", "pm25").count() == 26
