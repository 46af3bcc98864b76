"""Queries: normalisation, composite index, anomalies."""

from __future__ import annotations

from pyspark.sql import functions as F

from skymeter.operators.composite import (
    anomalies,
    anomaly_count,
    anomaly_threshold,
    column_ranges,
    composite_index,
    min_max_normalize,
    top_rows,
)
from skymeter.operators.incremental import (
    append_state,
    index_state,
    merged_state,
    ranges_of,
    read_states,
    threshold_of,
)
from skymeter.plans.adapters import (
    EVENT_FEATURES,
    LINE_MEASURES,
    LINE_READINGS,
    event_features,
    line_readings,
    stored_event_features,
)
from skymeter.session import own, work_path

EVENT_MEASURES = ("pm25", "pm10")
EVENT_COLUMNS = ["event_id", "datetime", "station", "pm25", "pm10", "pollution_index"]
LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "station", "datetime", *LINE_MEASURES]
LINE_COLUMNS = [*LINE_KEYS, "pollution_index"]


def _scored_events(spark, folder):
    return composite_index(stored_event_features(spark, folder), EVENT_MEASURES)


def _scored_lines(spark, folder):
    return composite_index(line_readings(spark, folder), LINE_MEASURES)


def _rounded(df, columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _index_only(df, columns):
    return _rounded(df.select(*columns), ["pollution_index"])


def _grown_state(spark, folder):
    """State of the events after their days have come in one week after the other."""
    features, path = stored_event_features(spark, folder), work_path(spark, "index-states")
    weeks = [r.week for r in features.select(F.ceil(F.col("day") / 7).alias("week")).distinct().collect()]
    for week in weeks:
        batch = features.filter(F.ceil(F.col("day") / 7) == week)
        append_state(index_state(batch, EVENT_MEASURES), path, f"week{week}")
    own(spark, path)
    return features, merged_state(read_states(spark, path, EVENT_MEASURES), EVENT_MEASURES)


def grown_ranges(spark, folder):
    return ranges_of(_grown_state(spark, folder)[1], EVENT_MEASURES)


def grown_threshold(spark, folder):
    found = threshold_of(_grown_state(spark, folder)[1], EVENT_MEASURES)
    return _rounded(found, ["mean_idx", "std_idx", "threshold"], 8)


def grown_anomalies(spark, folder):
    """Anomalies by the merged state: one scan, of the rows themselves."""
    features, state = _grown_state(spark, folder)
    scored = composite_index(features, EVENT_MEASURES, ranges=ranges_of(state, EVENT_MEASURES))
    found = anomalies(scored, threshold=threshold_of(state, EVENT_MEASURES))
    return _index_only(found, EVENT_COLUMNS)


QUERIES = {
    "grown_ranges": grown_ranges,
    "grown_threshold": grown_threshold,
    "grown_anomalies": grown_anomalies,
    "column_ranges": lambda s, d: column_ranges(event_features(s, d), EVENT_MEASURES),
    "min_max_normalize": lambda s, d: _rounded(
        min_max_normalize(stored_event_features(s, d), EVENT_MEASURES).select(
            "event_id", "pm25_norm", "pm10_norm"
        ),
        ["pm25_norm", "pm10_norm"],
    ),
    "pollution_index": lambda s, d: _index_only(_scored_events(s, d), ["event_id", "pollution_index"]),
    "pollution_index_lines": lambda s, d: _index_only(_scored_lines(s, d), LINE_COLUMNS),
    "top_index": lambda s, d: _index_only(
        top_rows(_scored_events(s, d), "pollution_index", ["event_id"], 20), EVENT_COLUMNS
    ),
    "top_index_lines": lambda s, d: _index_only(
        top_rows(_scored_lines(s, d), "pollution_index", LINE_KEYS, 20), LINE_COLUMNS
    ),
    "anomaly_threshold": lambda s, d: _rounded(
        anomaly_threshold(_scored_events(s, d)), ["mean_idx", "std_idx", "threshold"], 8
    ),
    "anomalies": lambda s, d: _index_only(anomalies(_scored_events(s, d)), EVENT_COLUMNS),
    "anomalies_lines": lambda s, d: _index_only(anomalies(_scored_lines(s, d)), LINE_COLUMNS),
    "anomaly_count": lambda s, d: anomaly_count(_scored_events(s, d)),
    "anomaly_count_lines": lambda s, d: anomaly_count(_scored_lines(s, d)),
    "top_anomalies": lambda s, d: _index_only(
        top_rows(anomalies(_scored_events(s, d)), "pollution_index", ["event_id"], 50), EVENT_COLUMNS
    ),
}


def _scored_sql(source: str, table: str, measures: tuple[str, ...]) -> str:
    number = "TRY_CAST({m} AS DOUBLE)"
    ranges = ", ".join(
        f"coalesce({fn}({number.format(m=m)}), 0.0) AS {m}_{fn}" for m in measures for fn in ("min", "max")
    )
    norms = ", ".join(
        f"CASE WHEN {m} IS NULL THEN 0.0 ELSE ({number.format(m=m)} - {m}_min)"
        f" / ({m}_max - {m}_min + 1e-9) END AS {m}_norm"
        for m in measures
    )
    total = " + ".join(f"{m}_norm" for m in measures)
    return f"""{source},
        ranges AS (SELECT {ranges} FROM {table}),
        normed AS (SELECT {table}.*, {norms} FROM {table}, ranges),
        scored AS (SELECT *, ({total}) / {len(measures)} AS idx FROM normed),
        stats AS (SELECT coalesce(avg(idx), 0.0) AS mean_idx, coalesce(stddev_samp(idx), 0.0) AS std_idx
                  FROM scored),
        limits AS (SELECT *, mean_idx + 3.0 * std_idx AS threshold FROM stats)"""


_EVENTS = _scored_sql(EVENT_FEATURES, "features", EVENT_MEASURES)
_LINES = _scored_sql(LINE_READINGS, "readings", LINE_MEASURES)
_IDX = "round(idx, 6) AS pollution_index"
_EVENT_SELECT = f"SELECT {', '.join(EVENT_COLUMNS[:-1])}, {_IDX} FROM scored"
_LINE_SELECT = f"SELECT {', '.join(LINE_KEYS)}, {_IDX} FROM scored"
_ANOMALOUS = "WHERE idx > (SELECT threshold FROM limits)"
_COUNTS = f"""SELECT (SELECT count(*) FROM scored) AS n_rows,
    (SELECT count(*) FROM scored {_ANOMALOUS}) AS n_anomalies"""

ORACLE = {
    "column_ranges": f"WITH {_EVENTS} SELECT pm25_min, pm25_max, pm10_min, pm10_max FROM ranges",
    "min_max_normalize": f"""WITH {_EVENTS}
        SELECT event_id, round(pm25_norm, 6) AS pm25_norm, round(pm10_norm, 6) AS pm10_norm FROM scored""",
    "pollution_index": f"WITH {_EVENTS} SELECT event_id, {_IDX} FROM scored",
    "pollution_index_lines": f"WITH {_LINES} {_LINE_SELECT}",
    "top_index": f"WITH {_EVENTS} {_EVENT_SELECT} ORDER BY idx DESC NULLS LAST, event_id LIMIT 20",
    "top_index_lines": f"""WITH {_LINES} {_LINE_SELECT}
        ORDER BY idx DESC NULLS LAST, {", ".join(LINE_KEYS)} LIMIT 20""",
    "anomaly_threshold": f"""WITH {_EVENTS}
        SELECT round(mean_idx, 8) AS mean_idx, round(std_idx, 8) AS std_idx, round(threshold, 8) AS threshold
        FROM limits""",
    "anomalies": f"WITH {_EVENTS} {_EVENT_SELECT} {_ANOMALOUS}",
    "anomalies_lines": f"WITH {_LINES} {_LINE_SELECT} {_ANOMALOUS}",
    "anomaly_count": f"WITH {_EVENTS} {_COUNTS}",
    "anomaly_count_lines": f"WITH {_LINES} {_COUNTS}",
    "top_anomalies": f"""WITH {_EVENTS} {_EVENT_SELECT} {_ANOMALOUS}
        ORDER BY idx DESC NULLS LAST, event_id LIMIT 50""",
}
ORACLE |= {
    "grown_ranges": ORACLE["column_ranges"],
    "grown_threshold": ORACLE["anomaly_threshold"],
    "grown_anomalies": ORACLE["anomalies"],
}
