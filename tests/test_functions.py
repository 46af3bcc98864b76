from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skymeter.functions import (
    hash_bucket,
    hour_category,
    is_weekend,
    parse_decimal_comma,
    parse_number,
    reading_time,
    season,
)

TEXTS = ["12.5", "NA", "", "1NA2", "NaN", " 7 ", "abc", None, "-3", "1e2"]


def evaluate(spark, values, schema, expr):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {schema}")
    return [r.x for r in df.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


def test_parse_number_removes_the_marker_anywhere_and_never_throws(spark):
    got = evaluate(spark, TEXTS, "string", parse_number)
    assert got == [12.5, None, None, 12.0, None, 7.0, None, None, -3.0, 100.0]


def test_strict_parse_accepts_only_numbers(spark):
    got = evaluate(spark, TEXTS, "string", lambda c: parse_number(c, strict=True))
    assert got == [12.5, None, None, None, None, 7.0, None, None, -3.0, 100.0]


def test_parse_number_of_a_number(spark):
    assert evaluate(spark, [1.5, float("nan"), None], "double", parse_number) == [1.5, None, None]


def test_decimal_comma(spark):
    got = evaluate(spark, ["12,5", "1.234", "1,2,3", None, "x", "NaN"], "string", parse_decimal_comma)
    assert got[:5] == [12.5, 1.234, None, None, None]
    assert got[5] != got[5]


def test_season_of_every_month(spark):
    got = evaluate(spark, [*range(1, 13), None], "int", season)
    winter, spring, summer, autumn = ["winter"], ["spring"], ["summer"], ["autumn"]
    assert got == winter * 2 + spring * 3 + summer * 3 + autumn * 3 + winter + autumn


@pytest.mark.parametrize(
    "hour, part",
    [(0, "night"), (5, "night"), (6, "morning"), (11, "morning"), (12, "afternoon"), (17, "afternoon"),
     (18, "evening"), (23, "evening"), (None, "evening")],
)
def test_hour_category(spark, hour, part):
    assert evaluate(spark, [hour], "int", hour_category) == [part]


def _time(c):
    return reading_time(F.lit(2013), F.lit(3), c, F.lit(4))


def test_reading_time_and_impossible_dates(spark):
    got = evaluate(spark, [1, 31, 32, 0, None], "int", _time)
    assert got == [dt.datetime(2013, 3, 1, 4), dt.datetime(2013, 3, 31, 4), None, None, None]
    february = evaluate(spark, [30], "int", lambda c: reading_time(F.lit(2013), F.lit(2), c, F.lit(3)))
    assert february == [None]


def test_reading_time_ignores_the_session_zone(spark):
    """02:00 on 10 March 2013 does not exist in New York, but the station's clock showed it."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = evaluate(spark, [10], "int", lambda c: reading_time(F.lit(2013), F.lit(3), c, F.lit(2)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [dt.datetime(2013, 3, 10, 2)]


def test_weekend_from_friday_to_monday(spark):
    assert evaluate(spark, [1, 2, 3, 4, None], "int", lambda c: is_weekend(_time(c))) == [0, 1, 1, 0, 0]


def test_hash_bucket_depends_on_seed_and_key_only(spark):
    df = spark.range(1000)
    bucket = hash_bucket([F.col("id")], 10, 42)
    first = {r.id: r.b for r in df.select("id", bucket.alias("b")).collect()}
    again = {r.id: r.b for r in df.repartition(7).select("id", bucket.alias("b")).collect()}
    other = {r.id: r.b for r in df.select("id", hash_bucket([F.col("id")], 10, 1).alias("b")).collect()}
    assert first == again != other
    assert set(first.values()) == set(range(10))
