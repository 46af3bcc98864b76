"""The end-to-end report: raw readings in, one table per result out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skymeter.operators.cleaning import assess_readings, quality_of
from skymeter.operators.composite import (
    INDEX_MEASURES,
    anomalies,
    anomaly_count,
    anomaly_threshold,
    column_ranges,
    composite_index,
    top_rows,
)
from skymeter.operators.features import PREVIEW_COLUMNS, preview, temporal_features
from skymeter.operators.graph import label_by_key, pagerank, propagate, station_edges, station_vertices
from skymeter.operators.regression import (
    ESTIMATORS,
    LABEL,
    fit_features,
    fit_models,
    predict,
    score_models,
    train_test_split,
    training_rows,
)
from skymeter.operators.stats import by_key, highest_first, in_key_order, stats_by_each
from skymeter.session import discard, materialize, scratch
from skymeter.sources import split_malformed

ORDER = ["station", "datetime"]
ROW_COLUMNS = ["datetime", "station", "pm25", "pm10", "no2", "o3", "pollution_index"]


class Report(dict[str, DataFrame]):
    """Results by name, and the stored tables they read."""

    def __init__(self, tables: dict[str, DataFrame], spark: SparkSession, paths: Sequence[str]):
        super().__init__(tables)
        self.spark, self.paths = spark, list(paths)

    def close(self) -> None:
        """Deletes the stored tables; the results cannot be read any more."""
        while self.paths:
            discard(self.spark, self.paths.pop())


def stored_features(raw: DataFrame, dedupe_on: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Features of the clean readings, and the quality report of the raw ones.

    Both read one stored table, written from a single shuffle of the raw rows. It is
    partitioned by usability, so features never read an unusable row and the report
    reads only the numbers of copies.
    """
    assessed = materialize(temporal_features(assess_readings(raw, dedupe_on=dedupe_on)), "readings", partition_by=["usable"])
    return assessed.filter("usable").drop("copies", "usable"), quality_of(assessed)


def readings_report(
    raw: DataFrame,
    connections: DataFrame,
    measures: Sequence[str] = INDEX_MEASURES,
    dedupe_on: Sequence[str] | None = None,
    malformed: str | None = None,
) -> Report:
    """All results for raw readings and station connections, by name.

    The features are cleaned and stored once, as a columnar table from which each
    result reads only its columns. Ranges, threshold, grouped statistics and graph are
    small and stored as well, so no result computes them again. ``dedupe_on`` names the
    columns that identify a reading, for files whose rows carry a number. ``malformed``
    names the column of lines that could not be read (see ``read_readings``): they are set
    aside as ``malformed_lines`` and counted in the quality report.

    The stored tables belong to the report: ``close`` deletes them, the end of the session
    at the latest.
    """
    with scratch(raw.sparkSession) as area:
        if malformed is None:
            tables = _tables(raw, connections, measures, dedupe_on)
        else:
            readings, lines = split_malformed(raw, malformed)
            lines = materialize(lines, "malformed-lines")
            tables = {"malformed_lines": lines, **_tables(readings, connections, measures, dedupe_on)}
            count = lines.agg(F.count(F.lit(1))).scalar()
            tables["quality_report"] = tables["quality_report"].withColumn("malformed_rows", count)
        return Report(tables, raw.sparkSession, area.keep_all())


def _tables(
    raw: DataFrame, connections: DataFrame, measures: Sequence[str], dedupe_on: Sequence[str] | None
) -> dict[str, DataFrame]:
    features, quality = stored_features(raw, dedupe_on)
    ranges = materialize(column_ranges(features, measures), "ranges")
    scored = composite_index(features, measures, ranges=ranges)
    threshold = materialize(anomaly_threshold(scored), "threshold")
    unusual = anomalies(scored, threshold=threshold)
    row_columns = [c for c in ROW_COLUMNS if c in scored.columns]
    tables = {
        "quality_report": quality,
        "preview_features": preview(features, [*PREVIEW_COLUMNS, "pm25", "station"], ORDER),
        "top_index": top_rows(scored, "pollution_index", ORDER, 20).select(*row_columns),
        "anomaly_threshold": threshold,
        "anomaly_count": anomaly_count(scored, threshold=threshold),
        "top_anomalies": top_rows(unusual, "pollution_index", ORDER, 50).select(*row_columns),
    }
    return {
        **tables,
        **grouped_tables(features),
        **_graph_tables(features, connections),
        **_model_tables(features),
    }


def grouped_tables(features: DataFrame) -> dict[str, DataFrame]:
    """All groups of every key from one scan of the features, and seven tables of them."""
    keys = ["station", "hour", "month", "year", "season"]
    stats = materialize(stats_by_each(features, keys, "pm25"), "grouped")
    both = ("mean", "max")
    return {
        "grouped": stats,
        "mean_by_station": highest_first(by_key(stats, "station", "pm25"), "station", "pm25", 20),
        "mean_by_hour": in_key_order(by_key(stats, "hour", "pm25"), "hour"),
        "mean_by_month": in_key_order(by_key(stats, "month", "pm25"), "month"),
        "mean_by_year": in_key_order(by_key(stats, "year", "pm25"), "year"),
        "stations_most_exposed": highest_first(
            by_key(stats, "station", "pm25", both), "station", "pm25", 20
        ),
        "peak_hours": highest_first(by_key(stats, "hour", "pm25", both), "hour", "pm25"),
        "critical_seasons": highest_first(by_key(stats, "season", "pm25"), "season", "pm25"),
    }


def _graph_tables(features: DataFrame, connections: DataFrame) -> dict[str, DataFrame]:
    vertices = materialize(station_vertices(features), "vertices")
    edges = materialize(station_edges(vertices, connections), "edges")
    ids = edges.select(F.col("src_id").alias("src"), F.col("dst_id").alias("dst"))
    ranks = pagerank(vertices, ids, key="id")
    return {
        "graph_vertices": vertices,
        "graph_edges": edges,
        "pagerank": label_by_key(ranks, vertices).orderBy(F.desc("rank"), "id"),
        "propagate": propagate(vertices, edges).orderBy(F.desc("received"), "station"),
    }


def _model_tables(features: DataFrame) -> dict[str, DataFrame]:
    train, test = train_test_split(training_rows(features))
    index = fit_features(train)
    names = list(ESTIMATORS)
    predicted = predict(test, index, fit_models(train, index, names))
    examples = top_rows(predicted, "datetime", ["station", LABEL], 20)
    return {
        "model_comparison": score_models(predicted, names),
        "prediction_examples": examples.select(
            "datetime", "station", LABEL, F.col("decision_tree").alias("prediction")
        ),
    }


def write_report(report: Report, folder: str) -> None:
    """Writes every result as a parquet table ``folder/<name>`` and closes the report, however it ends."""
    try:
        for name, table in report.items():
            table.write.mode("overwrite").parquet(f"{folder}/{name}")
    finally:
        report.close()
