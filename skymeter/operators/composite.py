"""Composite index of several measures, and anomalies by the sigma rule.

One-row results (value ranges, threshold) enter row expressions as scalar
subqueries: no join, no round trip through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skymeter.functions import nan_to_null

# Measures of the index, the guard in the denominator, the sigma rule.
INDEX_MEASURES = ("pm25", "pm10", "so2", "no2", "co", "o3")
RANGE_EPSILON = 1e-9
SIGMAS = 3.0


def _number(measure: str) -> Column:
    return F.col(measure).try_cast("double")


def column_ranges(df: DataFrame, measures: Sequence[str] = INDEX_MEASURES) -> DataFrame:
    """One row with ``<m>_min`` and ``<m>_max`` of every measure, from one pass.

    A measure without any number has the range 0..0.
    """
    extremes = {"min": F.min, "max": F.max}
    return df.agg(
        *[
            F.coalesce(fn(nan_to_null(_number(m))), F.lit(0.0)).alias(f"{m}_{name}")
            for m in measures
            for name, fn in extremes.items()
        ]
    )


def min_max_normalize(
    df: DataFrame, measures: Sequence[str] = INDEX_MEASURES, ranges: DataFrame | None = None
) -> DataFrame:
    """Adds ``<m>_norm``: 0 at the minimum of the measure and just below 1 at its maximum.

    A missing value (NULL or NaN) becomes 0. Text that is no number becomes NULL.
    """
    ranges = column_ranges(df, measures) if ranges is None else ranges

    def norm(m: str) -> Column:
        low, high = F.col(f"_ranges.{m}_min"), F.col(f"_ranges.{m}_max")
        missing = F.col(m).isNull() | F.isnan(_number(m))
        return F.when(missing, 0.0).otherwise((_number(m) - low) / (high - low + RANGE_EPSILON))

    ranged = df.withColumn("_ranges", ranges.select(F.struct("*")).scalar())
    return ranged.withColumns({f"{m}_norm": norm(m) for m in measures}).drop("_ranges")


def composite_index(
    df: DataFrame,
    measures: Sequence[str] = INDEX_MEASURES,
    output: str = "pollution_index",
    ranges: DataFrame | None = None,
) -> DataFrame:
    """Mean of the normalised measures; NULL if one of them is NULL."""
    total = reduce(add, [F.col(f"{m}_norm") for m in measures])
    return min_max_normalize(df, measures, ranges).withColumn(output, total / F.lit(len(measures)))


def anomaly_threshold(scored: DataFrame, index: str = "pollution_index", sigmas: float = SIGMAS) -> DataFrame:
    """One row: mean, sample standard deviation and ``mean + sigmas * sd`` of the index."""
    mean = F.coalesce(F.avg(index), F.lit(0.0))
    sd = F.coalesce(F.stddev_samp(index), F.lit(0.0))
    threshold = mean + F.lit(sigmas) * sd
    return scored.agg(mean.alias("mean_idx"), sd.alias("std_idx"), threshold.alias("threshold"))


def _above(index: str, threshold: DataFrame) -> Column:
    return F.col(index) > threshold.select("threshold").scalar()


def anomalies(
    scored: DataFrame,
    index: str = "pollution_index",
    sigmas: float = SIGMAS,
    threshold: DataFrame | None = None,
) -> DataFrame:
    """Rows whose index lies strictly above the threshold of the whole table."""
    threshold = anomaly_threshold(scored, index, sigmas) if threshold is None else threshold
    return scored.filter(_above(index, threshold))


def anomaly_count(
    scored: DataFrame,
    index: str = "pollution_index",
    sigmas: float = SIGMAS,
    threshold: DataFrame | None = None,
) -> DataFrame:
    """One row: number of rows and number of anomalies."""
    threshold = anomaly_threshold(scored, index, sigmas) if threshold is None else threshold
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(_above(index, threshold)).alias("n_anomalies")
    )


def top_rows(df: DataFrame, by: str, keys: Sequence[str], limit: int) -> DataFrame:
    """Rows with the highest ``by``, NULL last, equal ones in the order of the keys."""
    return df.orderBy(F.desc_nulls_last(by), *keys).limit(limit)
