"""Enrichment of line readings with statistics of their station and line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skymeter.functions import nan_to_null, parse_decimal_comma
from skymeter.operators.features import ingest_time_parts
from skymeter.operators.stats import group_stats, stat_columns
from skymeter.session import BROADCAST_BYTES, stored_for_join

STATS = ("mean", "max", "min")


def parse_pollution(df: DataFrame, measure: str = "pollution_raw", output: str = "pollution") -> DataFrame:
    """Adds the measure as a double; a decimal comma counts as a point."""
    return df.withColumn(output, parse_decimal_comma(F.col(measure)))


def reading_pairs(
    df: DataFrame, station: str = "station", value: str = "pollution", drop_null: bool = False
) -> DataFrame:
    """``(station_rdd, pollution_rdd)`` of every reading that is not NaN.

    A NULL reading counts as 0.0; ``drop_null`` leaves it out.
    """
    pairs = df.select(F.col(station).alias("station_rdd"), _reading(value, drop_null).alias("pollution_rdd"))
    return pairs.filter(F.col("pollution_rdd").isNotNull() & ~F.isnan("pollution_rdd"))


def station_stats(df: DataFrame, value: str = "pollution", station: str = "station") -> DataFrame:
    return group_stats(df, station, value, STATS, suffix="_station")


def line_stats(df: DataFrame, value: str = "pollution", line: str = "line") -> DataFrame:
    return group_stats(df, line, value, STATS, suffix="_line")


def attach_stats(
    df: DataFrame, stats: DataFrame, key: str, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Left join of group statistics to the rows they come from; a NULL key gets NULLs.

    The statistics are stored and counted first. Few, they are broadcast and the rows
    are not shuffled at all; otherwise it is a shuffle join whose hot keys AQE splits.
    """
    return df.join(stored_for_join(stats, f"stats-{key}", broadcast_bytes), [key], "left")


def _reading(value: str, drop_null: bool) -> Column:
    return F.col(value) if drop_null else F.coalesce(F.col(value), F.lit(0.0))


def partner_columns(value: str = "pollution", drop_null: bool = False) -> list[Column]:
    """Aggregates over the readings that :func:`reading_pairs` lists for a station."""
    partner = nan_to_null(_reading(value, drop_null))
    return [
        F.count(partner).alias("partner_count"),
        F.sum(partner).alias("partner_sum"),
        F.avg(partner).alias("partner_mean"),
        F.max(partner).alias("partner_max"),
        F.min(partner).alias("partner_min"),
    ]


def _no_partner(df: DataFrame) -> DataFrame:
    return df.withColumn("partner_count", F.coalesce("partner_count", F.lit(0).cast("bigint")))


def fanout_summary(
    df: DataFrame,
    station: str = "station",
    value: str = "pollution",
    drop_null: bool = False,
) -> DataFrame:
    """Every row with a summary of all readings of its station, its own included.

    This is the join of rows to the readings of the same station, aggregated per
    row: number, sum, mean, maximum and minimum of the partners. A station with n
    readings has n*n pairs; none is formed here, because the summary depends on the
    station only and is computed once per station.
    """
    summary = df.groupBy(station).agg(*partner_columns(value, drop_null))
    return _no_partner(attach_stats(df, summary, station))


def enrich(
    df: DataFrame,
    measure: str = "pollution_raw",
    station: str = "station",
    line: str = "line",
    value: str = "pollution",
    at: Column | None = None,
) -> DataFrame:
    """The whole enrichment: parsed measure, ingest time, station and line statistics, partners.

    ``at`` is the ingest time, by default the query's start. Two aggregations over the rows, one per key, and two joins.
    """
    parsed = ingest_time_parts(parse_pollution(df, measure, value), at=at)
    by_station = parsed.groupBy(station).agg(*stat_columns(value, STATS, "_station"), *partner_columns(value))
    with_station = _no_partner(attach_stats(parsed, by_station, station))
    return attach_stats(with_station, line_stats(parsed, value, line), line)
