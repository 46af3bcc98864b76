"""Temporal features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skymeter.functions import hour_category, is_weekend, reading_time, season
from skymeter.operators.cleaning import TIME_PARTS, require_columns

PREVIEW_COLUMNS = ("datetime", "season", "is_weekend", "hour_category")


def temporal_features(df: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """Adds ``datetime, season, is_weekend, hour_category`` to rows with integer time parts."""
    renames = {"pm25_clean": "pm25"} if renames is None else renames
    require_columns(df, [*TIME_PARTS, *renames])
    year, month, day, hour = (F.col(c) for c in TIME_PARTS)
    timed = df.withColumnsRenamed(renames).withColumn("datetime", reading_time(year, month, day, hour))
    return timed.withColumns(
        {
            "season": season(month),
            "is_weekend": is_weekend(F.col("datetime")),
            "hour_category": hour_category(hour),
        }
    )


def time_parts(df: DataFrame, time: str) -> DataFrame:
    """Adds ``hour, day, month`` of a stored time."""
    t = F.col(time)
    return df.withColumns({"hour": F.hour(t), "day": F.dayofmonth(t), "month": F.month(t)})


def ingest_time_parts(df: DataFrame, output: str = "timestamp", at: Column | None = None) -> DataFrame:
    """Stamps rows with a time, by default the query's start, and its ``hour, day, month``."""
    return time_parts(df.withColumn(output, F.current_timestamp() if at is None else at), output)


def preview(df: DataFrame, columns: list[str], order_by: list[str], n: int = 10) -> DataFrame:
    """First ``n`` rows by a key, so that two runs show the same ones."""
    return df.orderBy(*order_by).limit(n).select(*columns)
