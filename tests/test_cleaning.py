from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skymeter.operators.cleaning import assess_readings, clean_readings, dedupe, quality_report
from skymeter.operators.features import ingest_time_parts, preview, temporal_features, time_parts
from skymeter.sources import connections_table, read_readings, split_malformed
from skymeter.sources.readings import column_names

SCHEMA = "year string, month string, day string, hour string, pm25_raw string, station string"
ROWS = [
    ("2013", "3", "1", "0", "10.5", "a"),
    ("2013", "3", "1", "0", "10.5", "a"),
    ("2013", "3", "1", "1", "NA", "a"),
    ("2013", "3", "2", "1", "1NA2", "a"),
    ("2013", "3", "2", "1", "NaN", "a"),
    ("NA", "3", "2", "1", "5", "a"),
    (None, "3", "2", "1", "5", "a"),
    ("2013", "3", "2", "NA", "5", "a"),
    ("2013", "2", "30", "3", "6", None),
]


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_clean_readings(raw, collected):
    got = collected(clean_readings(raw), "year", "month", "day", "hour", "pm25_clean", "station")
    assert got == [(2013, 2, 30, 3, 6.0, None), (2013, 3, 1, 0, 10.5, "a"), (2013, 3, 2, 1, 12.0, "a")]


def test_strict_cleaning_drops_glued_markers(raw):
    assert clean_readings(raw, strict=True).count() == 2


def test_quality_report_equals_separate_counts(raw):
    """Rows are compared after typing: years NA and NULL make the same row."""
    got = quality_report(raw).first()
    assert (got.raw_rows, got.distinct_rows, got.clean_rows) == (9, 7, clean_readings(raw).count())
    empty = quality_report(raw.filter("false")).first()
    assert tuple(empty) == (0, 0, 0)


def test_row_number_defeats_whole_row_dedupe_but_not_a_subset(raw):
    numbered = raw.withColumn("no", F.monotonically_increasing_id())
    assert dedupe(numbered).count() == len(ROWS)
    assert dedupe(numbered, raw.columns).count() == len(ROWS) - 1


def test_subset_dedupe_does_not_depend_on_the_partitioning(spark, collected):
    df = spark.range(500).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"), F.lit("x").alias("w"))
    expected = [(k, k, "x") for k in range(7)]
    for n in (1, 3, 8):
        assert collected(dedupe(df.repartition(n), ["k"])) == expected


def test_hot_copies_collapse_before_the_shuffle(spark):
    """A row that makes up most of the table must reach the shuffle once per task."""
    df = spark.range(0, 40_000, 1, 4).select(F.when(F.col("id") % 10 < 9, 0).otherwise(F.col("id")).alias("v"))
    plan = dedupe(df)._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hash")
    assert plan.count("HashAggregate") == 2 and "HashAggregate" in plan[exchange:]
    assert dedupe(df).count() == 4000 + 1


def test_missing_column_is_an_error(raw):
    with pytest.raises(ValueError, match="month"):
        clean_readings(raw.drop("month"))


def test_temporal_features(raw, collected):
    features = temporal_features(clean_readings(raw))
    got = collected(features, "datetime", "season", "is_weekend", "hour_category", "pm25")
    assert got == [
        (None, "winter", 0, "night", 6.0),
        (dt.datetime(2013, 3, 1, 0), "spring", 0, "night", 10.5),
        (dt.datetime(2013, 3, 2, 1), "spring", 1, "night", 12.0),
    ]


def test_preview_is_the_same_for_every_partitioning(spark):
    df = spark.range(100)
    for n in (1, 5):
        assert [r.id for r in preview(df.repartition(n), ["id"], ["id"], 3).collect()] == [0, 1, 2]


def test_time_parts(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 5, 6, 7, 8),)], "ts timestamp_ntz")
    assert tuple(time_parts(df, "ts").select("hour", "day", "month").first()) == (7, 6, 5)
    stamped = ingest_time_parts(spark.range(3))
    got = stamped.agg(F.count_distinct("timestamp").alias("n"), F.max("month").alias("month")).first()
    assert got.n == 1 and 1 <= got.month <= 12


HEADER = "No,year,month,day,hour,PM2.5,PM10,station\n"


def write(folder, name, text):
    path = folder / name
    path.write_text(text)
    return str(path)


def test_csv_files_are_united_and_typed_late(spark, tmp_path, collected):
    a = write(tmp_path, "a.csv", HEADER + "1,2013,3,1,0,NA,5,Dongsi\n2,2013,3,1,1,,6,Dongsi\n")
    b = write(tmp_path, "b.csv", HEADER + "1,2013,3,1,0,7.5,NA,Shunyi\n")
    df = read_readings(spark, [a, b])
    assert df.columns == ["no", "year", "month", "day", "hour", "pm25_raw", "pm10", "station"]
    assert collected(df, "station", "pm25_raw", "pm10") == [
        ("Dongsi", None, "6"), ("Dongsi", "NA", "5"), ("Shunyi", "7.5", "NA")
    ]
    assert clean_readings(df).count() == 1


def test_csv_schema_can_be_inferred(spark, tmp_path):
    path = write(tmp_path, "a.csv", HEADER + "1,2013,3,1,0,NA,5,Dongsi\n")
    types = dict(read_readings(spark, path, infer_schema=True).dtypes)
    assert (types["year"], types["pm25_raw"], types["pm10"]) == ("int", "string", "int")


def test_csv_file_with_other_columns_is_an_error(spark, tmp_path):
    a = write(tmp_path, "a.csv", "year,pm10\n2013,5\n")
    b = write(tmp_path, "b.csv", "pm10,year\n5,2013\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_readings(spark, [a, b]).collect()


def test_connections_table(spark, collected):
    assert collected(connections_table(spark, [("a", "b"), ("b", "c")])) == [("a", "b"), ("b", "c")]


def test_subset_keeps_the_reading_of_a_group_with_missing_ones(spark, collected):
    rows = [("2013", "3", "1", "0", None, "a", 1), ("2013", "3", "1", "0", "7.5", "a", 2)]
    df = spark.createDataFrame(rows, f"{SCHEMA}, no int")
    key = ["year", "month", "day", "hour", "station"]
    assert collected(clean_readings(df, dedupe_on=key), "pm25_clean", "no") == [(7.5, 2)]
    assert collected(assess_readings(df, dedupe_on=key), "pm25_clean", "copies", "usable") == [(7.5, 2, True)]
    assert tuple(quality_report(df, dedupe_on=key).first()) == (2, 1, 1)
    assert tuple(quality_report(df).first()) == (2, 2, 1)


def test_subset_counts_equal_the_cleaned_rows(raw):
    key = ["year", "month", "day", "station"]
    assert quality_report(raw, dedupe_on=key).first().clean_rows == clean_readings(raw, dedupe_on=key).count()


def test_integral_time_parts_written_as_decimals_are_kept(spark, collected):
    rows = [("2013.0", "3", "1", "0", "5", "a"), ("2013.5", "3", "1", "0", "5", "a"), ("x", "3", "1", "0", "5", "a")]
    assert collected(clean_readings(spark.createDataFrame(rows, SCHEMA)), "year") == [(2013,)]


def test_header_names_ignore_case_and_must_stay_distinct():
    assert column_names(["No", "pm2.5", "PM10", " Station "]) == ["no", "pm25_raw", "pm10", "station"]
    assert column_names(["PM2.5", "O3"]) == ["pm25_raw", "o3"]
    with pytest.raises(ValueError, match="PM10.*PM1.0"):
        column_names(["PM10", "PM1.0"])


LINES = (
    "1,2013,3,1,0,NA,5,Dongsi\n2,2013,3,1\n3,2013,3,1,1,7.5,6,Shunyi,more\nx,2013,3,1,2,8.5,6,Shunyi\n"
    "4,2013,3,1,3,8.5,6,Shunyi\n4,2013,3,1,3,8.5,6,Shunyi\n"
)
LINES_SCHEMA = "No int, year int, month int, day int, hour int, `PM2.5` string, PM10 string, station string"


@pytest.mark.parametrize("schema", [LINES_SCHEMA, None])
def test_malformed_lines_have_a_channel(spark, tmp_path, collected, schema):
    paths = [write(tmp_path, f"{n}.csv", HEADER + LINES) for n in "ab"]
    given = None if schema is None else spark.createDataFrame([], schema).schema
    df = read_readings(spark, paths, schema=given, malformed="malformed")
    good, bad = split_malformed(df)
    assert good.columns == ["no", "year", "month", "day", "hour", "pm25_raw", "pm10", "station"]
    lines = LINES.splitlines()
    broken = lines[1:3] + lines[3:4] * (schema is not None)  # any text is right without a schema
    assert collected(bad, "line") == sorted((line,) for line in broken * 2)
    assert {r.file.rsplit("/", 1)[1] for r in bad.collect()} == {"a.csv", "b.csv"}
    assert good.count() == 2 * (6 - len(broken))
    report = quality_report(df, malformed="malformed").first()
    assert (report.raw_rows, report.malformed_rows) == (2 * (6 - len(broken)), 2 * len(broken))
    key = ["station", "year", "month", "day", "hour"]
    by_key = quality_report(df, dedupe_on=key, malformed="malformed").first()
    assert (by_key.raw_rows, by_key.malformed_rows) == (report.raw_rows, report.malformed_rows)
    assert by_key.clean_rows == clean_readings(good, dedupe_on=key).count()


def test_malformed_channel_with_inferred_types_and_a_taken_name(spark, tmp_path):
    path = write(tmp_path, "a.csv", HEADER + "1,2013,3,1,0,NA,5,Dongsi\n2,2013\n")
    df = read_readings(spark, path, infer_schema=True, malformed="malformed")
    assert dict(df.dtypes)["year"] == "int" and split_malformed(df)[1].first().line == "2,2013"
    with pytest.raises(Exception, match="(?i)station"):
        read_readings(spark, path, malformed="station").collect()


def test_report_by_key_does_not_sort(raw):
    plan = quality_report(raw, dedupe_on=["station", "hour"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Sort [" not in plan and "HashAggregate" in plan
