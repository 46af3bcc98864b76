"""Queries: threshold alerts on a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skymeter.session import discard, load, own, work_path
from skymeter.streaming import (
    alert_readings,
    flag_readings,
    read_batches,
    read_reading_stream,
    write_batches,
    write_stream,
)

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def _flagged_stream(spark: SparkSession, folder: str) -> DataFrame:
    stream = read_reading_stream(spark, f"{folder}/events.parquet*", EVENT_SCHEMA)
    readings = stream.select(
        "event_id",
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("station"),
        F.col("value").alias("pm25"),
    )
    return flag_readings(readings)


def _run(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path, state = work_path(spark, name), work_path(spark, f"{name}-state")
    write_stream(df, path, state).awaitTermination()
    discard(spark, state)
    return load(spark, own(spark, path), df.schema)


def _run_batches(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path, state = work_path(spark, name), work_path(spark, f"{name}-state")
    write_batches(df, path, state).awaitTermination()
    discard(spark, state)
    return read_batches(spark, own(spark, path), df.schema)


QUERIES = {
    "stream_flag": lambda s, d: _run(_flagged_stream(s, d), "flagged"),
    "stream_alerts": lambda s, d: _run(alert_readings(_flagged_stream(s, d)), "alerts"),
    "stream_alert_batches": lambda s, d: _run_batches(alert_readings(_flagged_stream(s, d)), "alert-batches"),
}

_FLAGGED = """SELECT event_id, ts AS timestamp, event_type AS station, value AS pm25,
    value > 150.0 AS is_anomaly FROM events"""

ORACLE = {
    "stream_flag": _FLAGGED,
    "stream_alerts": f"SELECT * FROM ({_FLAGGED}) WHERE is_anomaly",
    "stream_alert_batches": f"SELECT * FROM ({_FLAGGED}) WHERE is_anomaly",
}
