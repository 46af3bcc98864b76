"""Queries: line readings with station and line statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from skymeter.operators.enrich import (
    attach_stats,
    enrich,
    fanout_summary,
    line_stats,
    parse_pollution,
    reading_pairs,
    station_stats,
)
from skymeter.plans.adapters import CUSTOMER_LINES, customer_lines


def _lines(spark, folder):
    return parse_pollution(customer_lines(spark, folder))


def _rounded(df):
    means = [c for c in df.columns if "_mean" in c or c == "partner_sum"]
    return df.withColumns({c: F.round(c, 6) for c in means})


# The time of arrival in the registered query.
INGEST_TIME = "2025-03-09 17:45:30"


def enriched(spark, folder):
    at = F.lit(INGEST_TIME).cast("timestamp_ntz")
    return _rounded(enrich(customer_lines(spark, folder), at=at))


QUERIES = {
    "enrich": enriched,
    "decimal_comma": lambda s, d: _lines(s, d).select("c_custkey", "pollution_raw", "pollution"),
    "rdd_branch": lambda s, d: reading_pairs(_lines(s, d)),
    "station_stats": lambda s, d: _rounded(station_stats(_lines(s, d))),
    "line_stats": lambda s, d: _rounded(line_stats(_lines(s, d))),
    "station_stats_join": lambda s, d: _rounded(
        attach_stats(_lines(s, d), station_stats(_lines(s, d)), "station")
    ),
    "line_stats_join": lambda s, d: _rounded(attach_stats(_lines(s, d), line_stats(_lines(s, d)), "line")),
    "station_fanout_join": lambda s, d: _rounded(fanout_summary(_lines(s, d))),
}

_VALID = "CASE WHEN NOT isnan(pollution) THEN pollution END"


def _stats_sql(key: str) -> str:
    return f"""stats AS (
        SELECT {key}, round(avg({_VALID}), 6) AS pollution_mean_{key},
               max({_VALID}) AS pollution_max_{key}, min({_VALID}) AS pollution_min_{key}
        FROM lines GROUP BY {key})"""


def _join_sql(key: str) -> str:
    return f"""WITH {CUSTOMER_LINES}, {_stats_sql(key)}
        SELECT lines.*, pollution_mean_{key}, pollution_max_{key}, pollution_min_{key}
        FROM lines LEFT JOIN stats ON lines.{key} = stats.{key}"""


_PAIRS = """pairs AS (
        SELECT station AS station_rdd, coalesce(pollution, 0.0) AS pollution_rdd FROM lines
        WHERE pollution IS NULL OR NOT isnan(pollution))"""

ORACLE = {
    "enrich": f"""WITH {CUSTOMER_LINES}, {_PAIRS}, by_{_stats_sql('station')}, lined AS (
        SELECT line AS key, round(avg({_VALID}), 6) AS pollution_mean_line,
               max({_VALID}) AS pollution_max_line, min({_VALID}) AS pollution_min_line
        FROM lines GROUP BY line),
        partners AS (
        SELECT station_rdd, count(*) AS partner_count, round(sum(pollution_rdd), 6) AS partner_sum,
               round(avg(pollution_rdd), 6) AS partner_mean, max(pollution_rdd) AS partner_max,
               min(pollution_rdd) AS partner_min FROM pairs GROUP BY station_rdd)
        SELECT lines.*, TIMESTAMP '{INGEST_TIME}' AS timestamp, 17 AS hour, 9 AS day, 3 AS month,
               pollution_mean_station, pollution_max_station, pollution_min_station,
               coalesce(partner_count, 0) AS partner_count, partner_sum, partner_mean, partner_max, partner_min,
               pollution_mean_line, pollution_max_line, pollution_min_line
        FROM lines LEFT JOIN by_stats ON by_stats.station = lines.station
             LEFT JOIN partners ON station_rdd = lines.station LEFT JOIN lined ON lined.key = lines.line""",
    "decimal_comma": f"WITH {CUSTOMER_LINES} SELECT c_custkey, pollution_raw, pollution FROM lines",
    "rdd_branch": f"WITH {CUSTOMER_LINES}, {_PAIRS} SELECT station_rdd, pollution_rdd FROM pairs",
    "station_stats": f"WITH {CUSTOMER_LINES}, {_stats_sql('station')} SELECT * FROM stats",
    "line_stats": f"WITH {CUSTOMER_LINES}, {_stats_sql('line')} SELECT * FROM stats",
    "station_stats_join": _join_sql("station"),
    "line_stats_join": _join_sql("line"),
    # Forms every pair, as the check of the summary that does not.
    "station_fanout_join": f"""WITH {CUSTOMER_LINES}, {_PAIRS}
        SELECT c_custkey, station, line, pollution_raw, pollution,
               count(pollution_rdd) AS partner_count, round(sum(pollution_rdd), 6) AS partner_sum,
               round(avg(pollution_rdd), 6) AS partner_mean, max(pollution_rdd) AS partner_max,
               min(pollution_rdd) AS partner_min
        FROM lines LEFT JOIN pairs ON station = station_rdd
        GROUP BY c_custkey, station, line, pollution_raw, pollution""",
}
