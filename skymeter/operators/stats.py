"""Grouped statistics and rankings.

All aggregates here combine on the map side: a hot group sends one partial row per
task through the shuffle, however many readings it has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skymeter.functions import nan_to_null

AGGREGATES = {"mean": F.avg, "max": F.max, "min": F.min, "count": F.count}


def stat_columns(value: str, stats: Sequence[str] = ("mean",), suffix: str = "") -> list[Column]:
    """Aggregates ``<value>_<stat><suffix>``; NULL and NaN readings are skipped."""
    reading = nan_to_null(F.col(value).cast("double"))
    return [AGGREGATES[s](reading).alias(f"{value}_{s}{suffix}") for s in stats]


def group_stats(
    df: DataFrame,
    keys: str | Sequence[str],
    value: str,
    stats: Sequence[str] = ("mean",),
    suffix: str = "",
) -> DataFrame:
    """Statistics of the readings per group."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(*stat_columns(value, stats, suffix))


def stats_by_each(
    df: DataFrame, keys: Sequence[str], value: str, stats: Sequence[str] = ("mean", "max")
) -> DataFrame:
    """Statistics by each single key, from one scan.

    A row belongs to the key named in ``grouped_by``; its other key columns are NULL.
    Select one with :func:`by_key`.
    """
    # The id has one bit per key, the first key's highest; a key in use has a 0 there.
    ids = {key: 2 ** len(keys) - 1 - 2 ** (len(keys) - 1 - i) for i, key in enumerate(keys)}
    grouped = df.groupingSets([[key] for key in keys], *keys)
    counted = grouped.agg(F.grouping_id().alias("_id"), *stat_columns(value, stats))
    name = F.coalesce(*[F.when(F.col("_id") == i, key) for key, i in ids.items()])
    return counted.withColumn("grouped_by", name).drop("_id")


def by_key(stats: DataFrame, key: str, value: str, names: Sequence[str] = ("mean",)) -> DataFrame:
    """The statistics of one key out of :func:`stats_by_each`."""
    return stats.filter(F.col("grouped_by") == key).select(key, *[f"{value}_{n}" for n in names])


def in_key_order(stats: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """All groups in the order of the key; with a ``limit`` the first of them."""
    ordered = stats.orderBy(key)
    return ordered if limit is None else ordered.limit(limit)


def highest_first(stats: DataFrame, key: str, value: str, limit: int | None = None) -> DataFrame:
    """Groups with the highest mean first; equal means in the order of the key."""
    ordered = stats.orderBy(F.desc(f"{value}_mean"), F.asc(key))
    return ordered if limit is None else ordered.limit(limit)


def mean_by(df: DataFrame, key: str, value: str, limit: int | None = None) -> DataFrame:
    """Mean per group in the order of the key (hours, months, years)."""
    return in_key_order(group_stats(df, key, value), key, limit)


def ranked_by_mean(
    df: DataFrame, key: str, value: str, limit: int | None = None, stats: Sequence[str] = ("mean",)
) -> DataFrame:
    """Statistics of the groups, those with the highest means first."""
    return highest_first(group_stats(df, key, value, stats), key, value, limit)
