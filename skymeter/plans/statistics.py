"""Queries: grouped statistics and rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from skymeter.operators.stats import mean_by, ranked_by_mean, stats_by_each
from skymeter.plans.adapters import EVENT_FEATURES, ORDER_FEATURES, event_features, order_features, raw_events
from skymeter.plans.report import grouped_tables, stored_features


# Digits compared with SQL; fewer for the large order prices, whose means carry
# the rounding of the summation order into the later digits.
EVENT_DIGITS = 8
ORDER_DIGITS = 4


def _rounded(df, digits=EVENT_DIGITS):
    return df.withColumn("pm25_mean", F.round("pm25_mean", digits))


def _order_means(df):
    return _rounded(df, ORDER_DIGITS)


def report_grouped(spark, folder):
    """All groups of every key, on the report's path: one shuffle of the raw rows, stored features."""
    features, _ = stored_features(raw_events(spark, folder))
    return _rounded(grouped_tables(features)["grouped"])


QUERIES = {
    "report_grouped": report_grouped,
    "mean_by_station": lambda s, d: _rounded(ranked_by_mean(event_features(s, d), "station", "pm25", 20)),
    "mean_by_hour": lambda s, d: _rounded(mean_by(event_features(s, d), "hour", "pm25")),
    "mean_by_month": lambda s, d: _order_means(mean_by(order_features(s, d), "month", "pm25")),
    "mean_by_year": lambda s, d: _order_means(mean_by(order_features(s, d), "year", "pm25")),
    "stations_most_exposed": lambda s, d: _rounded(
        ranked_by_mean(event_features(s, d), "site", "pm25", 20, ("mean", "max"))
    ),
    "peak_hours": lambda s, d: _rounded(
        ranked_by_mean(event_features(s, d), "hour", "pm25", stats=("mean", "max"))
    ),
    "stats_by_each": lambda s, d: _rounded(
        stats_by_each(event_features(s, d), ["station", "hour", "day"], "pm25")
    ),
    "critical_seasons": lambda s, d: _order_means(ranked_by_mean(order_features(s, d), "season", "pm25")),
}


def _sql(features: str, key: str, order: str, limit: int | None = None, extra: str = "") -> str:
    digits = EVENT_DIGITS if features is EVENT_FEATURES else ORDER_DIGITS
    return f"""WITH {features},
        means AS (SELECT {key}, avg(pm25) AS mean{extra} FROM features GROUP BY {key}
                  ORDER BY {order}{"" if limit is None else f" LIMIT {limit}"})
        SELECT {key}, round(mean, {digits}) AS pm25_mean{", pm25_max" if extra else ""} FROM means"""


_MAX = ", max(pm25) AS pm25_max"

_KEYS = ("station", "hour", "month", "year", "season")
_GROUPED_BY = " ".join(f"WHEN grouping({k}) = 0 THEN '{k}'" for k in _KEYS)

ORACLE = {
    "report_grouped": f"""WITH {EVENT_FEATURES}
        SELECT CASE {_GROUPED_BY} END AS grouped_by, {", ".join(_KEYS)},
               round(avg(pm25), {EVENT_DIGITS}) AS pm25_mean, max(pm25) AS pm25_max
        FROM features GROUP BY GROUPING SETS ({", ".join(f"({k})" for k in _KEYS)})""",
    "mean_by_station": _sql(EVENT_FEATURES, "station", "mean DESC, station", 20),
    "mean_by_hour": _sql(EVENT_FEATURES, "hour", "hour"),
    "mean_by_month": _sql(ORDER_FEATURES, "month", "month"),
    "mean_by_year": _sql(ORDER_FEATURES, "year", "year"),
    "stations_most_exposed": _sql(EVENT_FEATURES, "site", "mean DESC, site", 20, _MAX),
    "peak_hours": _sql(EVENT_FEATURES, "hour", "mean DESC, hour", extra=_MAX),
    "stats_by_each": f"""WITH {EVENT_FEATURES}
        SELECT CASE WHEN grouping(station) = 0 THEN 'station' WHEN grouping(hour) = 0 THEN 'hour' ELSE 'day' END
               AS grouped_by, station, hour, day, round(avg(pm25), {EVENT_DIGITS}) AS pm25_mean,
               max(pm25) AS pm25_max
        FROM features GROUP BY GROUPING SETS ((station), (hour), (day))""",
    "critical_seasons": _sql(ORDER_FEATURES, "season", "mean DESC, season"),
}
