"""Queries: CSV scan, cleaning, temporal features."""

from __future__ import annotations

from pyspark.sql import functions as F

from skymeter.operators.cleaning import clean_readings, dedupe, quality_of, quality_report
from skymeter.operators.features import PREVIEW_COLUMNS, ingest_time_parts, preview, time_parts
from skymeter.plans.adapters import (
    CLEAN_EVENTS,
    EVENT_FEATURES,
    ORDER_FEATURES,
    RAW_COLUMNS,
    RAW_EVENTS,
    clean_events,
    event_features,
    order_features,
    raw_events,
)
from skymeter.plans.report import stored_features
from skymeter.session import own, work_path
from skymeter.sources import load_table, read_readings, split_malformed

CLEAN_COLUMNS = ["event_id", "station", "year", "month", "day", "hour", "pm25_raw", "pm25_clean"]
FEATURE_COLUMNS = [
    "event_id", "station", "year", "month", "day", "hour", "pm25", "datetime", "season",
    "is_weekend", "hour_category",
]
# The columns of the two previews.
PREVIEW = [*PREVIEW_COLUMNS, "pm25", "station"]
CLEAN_PREVIEW = ["year", "month", "day", "hour", "pm25_clean", "station"]

# What identifies a reading where copies differ in a row number.
READING_KEY = ["station", "site", "day", "hour"]
# The time of arrival in the registered query, as text both sides read.
INGEST_TIME = "2025-03-09 17:45:30"
CSV_SCHEMA = "event_id long, station string, site string, year int, month int, day int, hour int, pm25_raw string, pm10_raw string"


def _csv(spark, folder):
    """The raw events as CSV files with the header of the raw files."""
    path = work_path(spark, "readings-csv")
    raw_events(spark, folder).withColumnRenamed("pm25_raw", "PM2.5").write.option("header", True).csv(path)
    return own(spark, path)


def csv_scan(spark, folder):
    return read_readings(spark, _csv(spark, folder)).select(*RAW_COLUMNS)


def csv_scan_inferred(spark, folder):
    """Columns typed by their values: integers, except for the two dirty measures."""
    return read_readings(spark, _csv(spark, folder), infer_schema=True).select(*RAW_COLUMNS)


def csv_scan_schema(spark, folder):
    """Columns of a given schema, whose names are those of the header."""
    given = spark.createDataFrame([], CSV_SCHEMA).withColumnRenamed("pm25_raw", "PM2.5").schema
    return read_readings(spark, _csv(spark, folder), schema=given).select(*RAW_COLUMNS)


def _line() -> str:
    """SQL of a CSV line of a raw event. One in a hundred has too few fields, too many, or no number."""
    values = [f"coalesce({c}, '')" for c in RAW_COLUMNS[1:]]
    whole = f"concat_ws(',', event_id, {', '.join(values)})"
    return f"""CASE WHEN event_id % 300 = 7 THEN concat_ws(',', event_id, station)
        WHEN event_id % 300 = 107 THEN concat_ws(',', {whole}, 'extra')
        WHEN event_id % 300 = 207 THEN concat_ws('', 'No', {whole}) ELSE {whole} END"""


def _broken_csv(spark, folder):
    """The raw events as CSV lines, some of them broken; read again with their schema and the channel for those."""
    path = work_path(spark, "readings-lines")
    header = ",".join(["PM2.5" if c == "pm25_raw" else c for c in RAW_COLUMNS])
    lines = raw_events(spark, folder).select(F.expr(_line()).alias(header))
    # One column of whole lines: no separator occurs in it, so nothing is quoted.
    lines.write.option("header", True).option("sep", "\u0001").csv(path)
    own(spark, path)
    given = spark.createDataFrame([], CSV_SCHEMA).withColumnRenamed("pm25_raw", "PM2.5").schema
    return read_readings(spark, path, schema=given, malformed="malformed")


def csv_malformed(spark, folder):
    """Row counts of files with broken lines."""
    return quality_report(_broken_csv(spark, folder), malformed="malformed")


def csv_malformed_lines(spark, folder):
    """The broken lines, set aside."""
    return split_malformed(_broken_csv(spark, folder))[1].select("line")


def csv_beside_malformed(spark, folder):
    """The readings of files with broken lines."""
    return split_malformed(_broken_csv(spark, folder))[0].select(*RAW_COLUMNS)


def ingest_parts(spark, folder):
    at = F.lit(INGEST_TIME).cast("timestamp_ntz")
    stamped = ingest_time_parts(load_table(spark, folder, "events").select("event_id"), at=at)
    return stamped.select("event_id", "timestamp", "hour", "day", "month")


def clean_subset(spark, folder):
    return clean_readings(raw_events(spark, folder), dedupe_on=READING_KEY).select(*CLEAN_COLUMNS)


def report_quality(spark, folder):
    """The counts that come out of the report's stored features."""
    return stored_features(raw_events(spark, folder))[1]


def stored_parts(spark, folder):
    return time_parts(load_table(spark, folder, "events").select("event_id", "ts"), "ts")


QUERIES = {
    "csv_scan": csv_scan,
    "csv_scan_inferred": csv_scan_inferred,
    "csv_scan_schema": csv_scan_schema,
    "csv_malformed": csv_malformed,
    "csv_malformed_lines": csv_malformed_lines,
    "csv_beside_malformed": csv_beside_malformed,
    "dedupe": lambda s, d: dedupe(raw_events(s, d)),
    "dedupe_subset": lambda s, d: dedupe(
        raw_events(s, d).select("station", "day", "hour", "event_id", "pm25_raw"), ["station", "day", "hour"]
    ),
    "clean_readings": lambda s, d: clean_events(s, d).select(*CLEAN_COLUMNS),
    "clean_readings_subset": clean_subset,
    "quality_report": lambda s, d: quality_report(raw_events(s, d)),
    "quality_report_subset": lambda s, d: quality_report(raw_events(s, d), dedupe_on=READING_KEY),
    "report_quality": report_quality,
    "temporal_features": lambda s, d: event_features(s, d).select(*FEATURE_COLUMNS),
    "temporal_features_years": lambda s, d: order_features(s, d).select(
        "o_orderkey", "datetime", "season", "is_weekend", "hour_category"
    ),
    "time_parts": stored_parts,
    "ingest_time_parts": ingest_parts,
    "preview_clean": lambda s, d: preview(
        clean_events(s, d), CLEAN_PREVIEW, ["event_id"]
    ),
    "preview_features": lambda s, d: preview(event_features(s, d), PREVIEW, ["event_id"]),
}

_QUALITY = f"""WITH {CLEAN_EVENTS}
        SELECT (SELECT count(*) FROM raw) AS raw_rows, (SELECT count(*) FROM typed) AS distinct_rows,
               (SELECT count(*) FROM clean) AS clean_rows"""
_TYPED_CSV = f"""WITH {RAW_EVENTS}
        SELECT event_id, station, site, CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month,
               CAST(day AS INTEGER) AS day, CAST(hour AS INTEGER) AS hour,
               nullif(pm25_raw, '') AS pm25_raw, pm10_raw FROM raw"""

_BROKEN = "event_id % 100 = 7"
ORACLE = {
    "csv_malformed": f"""WITH {CLEAN_EVENTS}
        SELECT (SELECT count(*) FROM raw WHERE NOT {_BROKEN}) AS raw_rows,
               (SELECT count(*) FROM typed WHERE NOT {_BROKEN}) AS distinct_rows,
               (SELECT count(*) FROM clean WHERE NOT {_BROKEN}) AS clean_rows,
               (SELECT count(*) FROM raw WHERE {_BROKEN}) AS malformed_rows""",
    "csv_malformed_lines": f"WITH {RAW_EVENTS} SELECT {_line()} AS line FROM raw WHERE {_BROKEN}",
    "csv_beside_malformed": f"{_TYPED_CSV} WHERE NOT {_BROKEN}",
    "csv_scan_inferred": _TYPED_CSV.replace("SELECT event_id,", "SELECT CAST(event_id AS INTEGER) AS event_id,"),
    "csv_scan_schema": _TYPED_CSV,
    "clean_readings_subset": f"""WITH {CLEAN_EVENTS},
        placed AS (SELECT *, row_number() OVER (PARTITION BY {", ".join(READING_KEY)}
                   ORDER BY event_id, year, month, pm25_raw, pm10_raw NULLS FIRST) AS n FROM clean)
        SELECT {', '.join(CLEAN_COLUMNS)} FROM placed WHERE n = 1""",
    "quality_report_subset": f"""WITH {CLEAN_EVENTS}, keys AS (SELECT DISTINCT {", ".join(READING_KEY)} FROM typed)
        SELECT (SELECT count(*) FROM raw) AS raw_rows, (SELECT count(*) FROM keys) AS distinct_rows,
               (SELECT count(*) FROM (SELECT DISTINCT {", ".join(READING_KEY)} FROM clean)) AS clean_rows""",
    "report_quality": _QUALITY,
    "ingest_time_parts": f"""SELECT event_id, TIMESTAMP '{INGEST_TIME}' AS timestamp, 17 AS hour, 9 AS day, 3 AS month
        FROM events""",
    # Every column of a CSV file is text, and an empty field is a missing one.
    "csv_scan": f"""WITH {RAW_EVENTS}
        SELECT CAST(event_id AS VARCHAR) AS event_id, station, site, year, month, day, hour,
               nullif(pm25_raw, '') AS pm25_raw, pm10_raw FROM raw""",
    "dedupe": f"WITH {RAW_EVENTS} SELECT DISTINCT {', '.join(RAW_COLUMNS)} FROM raw",
    "dedupe_subset": f"""WITH {RAW_EVENTS},
        ranked AS (SELECT station, day, hour, event_id, pm25_raw,
                          row_number() OVER (PARTITION BY station, day, hour ORDER BY event_id, pm25_raw) AS n
                   FROM raw)
        SELECT station, day, hour, event_id, pm25_raw FROM ranked WHERE n = 1""",
    "clean_readings": f"WITH {CLEAN_EVENTS} SELECT {', '.join(CLEAN_COLUMNS)} FROM clean",
    "quality_report": _QUALITY,
    "temporal_features": f"WITH {EVENT_FEATURES} SELECT {', '.join(FEATURE_COLUMNS)} FROM features",
    "temporal_features_years": f"""WITH {ORDER_FEATURES}
        SELECT o_orderkey, datetime, season, is_weekend, hour_category FROM features""",
    "time_parts": """SELECT event_id, ts, CAST(hour(ts) AS INTEGER) AS hour, CAST(day(ts) AS INTEGER) AS day,
        CAST(month(ts) AS INTEGER) AS month FROM events""",
    "preview_clean": f"""WITH {CLEAN_EVENTS}
        SELECT {", ".join(CLEAN_PREVIEW)} FROM clean ORDER BY event_id LIMIT 10""",
    "preview_features": f"""WITH {EVENT_FEATURES}
        SELECT {", ".join(PREVIEW)} FROM features ORDER BY event_id LIMIT 10""",
}
