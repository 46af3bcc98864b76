"""Threshold alerts, the same for streams and for batches.

Both steps look at one row at a time: no state, no watermark, no shuffle. The
throughput of a stream grows with the number of tasks reading its files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

# Fixed value: a reading above it is an alert.
ALERT_THRESHOLD = 150.0


def read_reading_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    source_format: str = "parquet",
    max_files_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Files arriving under ``path`` as a stream. The schema is explicit: a stream infers none."""
    reader = spark.readStream.format(source_format).schema(schema).options(**options)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def flag_readings(
    df: DataFrame, value: str = "pm25", threshold: float = ALERT_THRESHOLD, output: str = "is_anomaly"
) -> DataFrame:
    """Adds whether the reading lies strictly above the threshold; NaN readings are dropped."""
    return df.filter(F.col(value).isNull() | ~F.isnan(value)).withColumn(
        output, F.col(value) > F.lit(threshold)
    )


def alert_readings(df: DataFrame, flag: str = "is_anomaly") -> DataFrame:
    """Flagged rows only."""
    return df.filter(F.col(flag))


def write_stream(
    df: DataFrame, path: str, checkpoint: str, available_now: bool = True, sink_format: str = "parquet"
) -> StreamingQuery:
    """Appends the stream to a table of files, each row exactly once across restarts.

    With ``available_now`` it processes what is there, in as many batches as the
    source's rate limit asks for, and stops; otherwise it runs until stopped.
    """
    writer = df.writeStream.format(sink_format).outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)
