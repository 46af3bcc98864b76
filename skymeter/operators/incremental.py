"""Ranges and anomaly threshold of growing data, from a state per batch instead of all rows.

The index of a row is linear in its measures once the ranges are known. So its mean and
its spread over all rows follow from the means and the co-moments of the measures, which
add up over batches, whatever the ranges turn out to be. A new day costs one scan of that
day; the states of all days are one small row each.

A missing measure counts as 0 in the index. So each measure enters as two quantities: its
number, 0 where it is missing, and whether it is there.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations_with_replacement, product
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skymeter.functions import nan_to_null
from skymeter.operators.composite import INDEX_MEASURES, RANGE_EPSILON, SIGMAS


def _quantities(measures: Sequence[str]) -> list[str]:
    return [f"{m}_{kind}" for m in measures for kind in ("value", "given")]


def _pairs(measures: Sequence[str]) -> list[tuple[str, str]]:
    return list(combinations_with_replacement(_quantities(measures), 2))


def state_schema(measures: Sequence[str] = INDEX_MEASURES) -> T.StructType:
    names = [f"{m}_{end}" for m in measures for end in ("min", "max")]
    names += [f"mean_{q}" for q in _quantities(measures)] + [f"moment_{a}_{b}" for a, b in _pairs(measures)]
    return T.StructType([T.StructField("n", T.LongType()), *[T.StructField(n, T.DoubleType()) for n in names]])


def index_state(df: DataFrame, measures: Sequence[str] = INDEX_MEASURES) -> DataFrame:
    """One row: the state of a batch, from one pass over it.

    Rows with text that is no number have no index; they count for the ranges only.
    """
    numbers = {m: F.col(m).try_cast("double") for m in measures}
    missing = {m: F.col(m).isNull() | F.isnan(numbers[m]) for m in measures}
    valid = reduce(lambda a, b: a & b, [missing[m] | numbers[m].isNotNull() for m in measures])
    ranged = {f"{m}_number": nan_to_null(numbers[m]) for m in measures}
    values = {f"{m}_value": F.when(valid, F.when(missing[m], 0.0).otherwise(numbers[m])) for m in measures}
    given = {f"{m}_given": F.when(valid, F.when(missing[m], 0.0).otherwise(1.0)) for m in measures}
    # Names of the batch's own columns do not matter below.
    rows = df.select(*[c.alias(n) for n, c in (ranged | values | given).items()])
    n = F.count(f"{measures[0]}_value")
    ends = [fn(f"{m}_number").alias(f"{m}_{end}") for m in measures for end, fn in (("min", F.min), ("max", F.max))]
    means = [F.coalesce(F.avg(q), F.lit(0.0)).alias(f"mean_{q}") for q in _quantities(measures)]
    moments = [(F.coalesce(F.covar_pop(a, b), F.lit(0.0)) * n).alias(f"moment_{a}_{b}") for a, b in _pairs(measures)]
    return rows.agg(n.alias("n"), *ends, *means, *moments)


def append_state(state: DataFrame, folder: str, batch: str) -> None:
    """Stores the state of a batch below ``folder``; the same batch again replaces it."""
    state.coalesce(1).write.mode("overwrite").parquet(f"{folder}/batch={batch}")


def read_states(spark: SparkSession, folder: str, measures: Sequence[str] = INDEX_MEASURES) -> DataFrame:
    """The stored states, one row per batch."""
    return spark.read.schema(state_schema(measures)).parquet(folder)


def merged_state(states: DataFrame, measures: Sequence[str] = INDEX_MEASURES) -> DataFrame:
    """One row: the state of all rows of all batches."""
    n = F.sum("n")
    quantities = _quantities(measures)
    ends = [
        fn(f"{m}_{end}").alias(f"{m}_{end}") for m in measures for end, fn in (("min", F.min), ("max", F.max))
    ]
    means = [
        F.coalesce(F.try_divide(F.sum(F.col("n") * F.col(f"mean_{q}")), n), F.lit(0.0)).alias(f"mean_{q}")
        for q in quantities
    ]
    total = states.agg(F.coalesce(n, F.lit(0)).alias("n"), *ends, *means)
    # How far a batch's means lie from those of all rows adds to the co-moments.
    beside = states.withColumn("_all", total.select(F.struct("*")).scalar())
    off = {q: F.col(f"mean_{q}") - F.col(f"_all.mean_{q}") for q in quantities}
    moments = [
        F.coalesce(F.sum(F.col(f"moment_{a}_{b}") + F.col("n") * off[a] * off[b]), F.lit(0.0)).alias(f"moment_{a}_{b}")
        for a, b in _pairs(measures)
    ]
    spread = beside.agg(*moments).select(F.struct("*")).scalar()
    return total.withColumn("_spread", spread).select(*total.columns, "_spread.*")


def ranges_of(state: DataFrame, measures: Sequence[str] = INDEX_MEASURES) -> DataFrame:
    """``<m>_min`` and ``<m>_max``, as ``column_ranges`` gives them."""
    ends = [f"{m}_{end}" for m in measures for end in ("min", "max")]
    return state.select(*[F.coalesce(c, F.lit(0.0)).alias(c) for c in ends])


def threshold_of(
    state: DataFrame, measures: Sequence[str] = INDEX_MEASURES, sigmas: float = SIGMAS
) -> DataFrame:
    """``mean_idx, std_idx, threshold`` of the index, as ``anomaly_threshold`` gives them."""
    low = {m: F.coalesce(f"{m}_min", F.lit(0.0)) for m in measures}
    high = {m: F.coalesce(f"{m}_max", F.lit(0.0)) for m in measures}
    scale = {m: (high[m] - low[m] + RANGE_EPSILON) * len(measures) for m in measures}

    def moment(a: str, b: str) -> Column:
        return F.col(f"moment_{a}_{b}" if (a, b) in _pairs(measures) else f"moment_{b}_{a}")

    # Of the numbers less their minimum, and 0 where there is none, before anything is divided.
    mean = reduce(add, [(F.col(f"mean_{m}_value") - low[m] * F.col(f"mean_{m}_given")) / scale[m] for m in measures])
    squares = reduce(
        add,
        [
            (
                moment(f"{a}_value", f"{b}_value")
                - low[a] * moment(f"{a}_given", f"{b}_value")
                - low[b] * moment(f"{a}_value", f"{b}_given")
                + low[a] * low[b] * moment(f"{a}_given", f"{b}_given")
            )
            / scale[a]
            / scale[b]
            for a, b in product(measures, measures)
        ],
    )
    # Rounding may leave a little less than nothing where all rows have one index.
    sd = F.when(F.col("n") > 1, F.sqrt(F.greatest(squares, F.lit(0.0)) / (F.col("n") - 1))).otherwise(0.0)
    found = state.select(mean.alias("mean_idx"), sd.alias("std_idx"))
    return found.withColumn("threshold", F.col("mean_idx") + F.lit(sigmas) * F.col("std_idx"))
