"""Cleaning of raw readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skymeter.functions import parse_number

TIME_PARTS = ("year", "month", "day", "hour")


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")


def type_time_parts(df: DataFrame, time_parts: Sequence[str] = TIME_PARTS) -> DataFrame:
    """Time parts as integers, NULL where the text is not one; ``2013.0`` is."""
    require_columns(df, time_parts)
    return df.withColumns({c: _integer(F.col(c)) for c in time_parts})


def _integer(text: Column) -> Column:
    number = text.try_cast("double")
    return F.coalesce(text.try_cast("int"), F.when(number == F.floor(number), number).try_cast("int"))


def dedupe(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """One row of each group of equal rows.

    With all columns as key the copies collapse before the shuffle, so one row that
    makes up a third of the table costs one row per task. With a ``subset``, the
    smallest row of each group is kept, whatever the partitioning.
    """
    if subset is None:
        return df.dropDuplicates()
    require_columns(df, subset)
    rest = [c for c in df.columns if c not in subset]
    if not rest:
        return df.dropDuplicates()
    # The first row of each group is picked before the shuffle as well as after it.
    place = F.row_number().over(Window.partitionBy(*subset).orderBy(*rest))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")


def _usable(time_parts: Sequence[str], value: Column) -> Column:
    condition = value.isNotNull()
    for part in time_parts:
        condition = condition & F.col(part).isNotNull()
    return condition


def clean_readings(
    df: DataFrame,
    measure: str = "pm25_raw",
    output: str = "pm25_clean",
    time_parts: Sequence[str] = TIME_PARTS,
    dedupe_on: Sequence[str] | None = None,
    strict: bool = False,
) -> DataFrame:
    """Distinct rows that have a full time and a usable measure, parsed into ``output``.

    With ``dedupe_on``, one usable row of each group that agrees in these columns: the
    smallest. Unusable rows go first, so a group with a reading keeps one.

    Select the columns you need first: nothing can be pruned below a comparison of
    whole rows. The filters do move below it, into the scan stage.
    """
    require_columns(df, [measure])
    typed = type_time_parts(df, time_parts)
    distinct = typed if dedupe_on is not None else dedupe(typed)
    parsed = distinct.withColumn(output, parse_number(F.col(measure), strict=strict))
    usable = parsed.filter(_usable(time_parts, F.col(output)))
    return usable if dedupe_on is None else dedupe(usable, dedupe_on)


def _with_usable(
    typed: DataFrame, measure: str, output: str, time_parts: Sequence[str], strict: bool
) -> DataFrame:
    parsed = typed.withColumn(output, parse_number(F.col(measure), strict=strict))
    return parsed.withColumn("usable", _usable(time_parts, F.col(output)))


def assess_readings(
    df: DataFrame,
    measure: str = "pm25_raw",
    output: str = "pm25_clean",
    time_parts: Sequence[str] = TIME_PARTS,
    strict: bool = False,
    dedupe_on: Sequence[str] | None = None,
) -> DataFrame:
    """Distinct rows, usable or not, with the parsed measure, ``copies`` and ``usable``.

    With ``dedupe_on``, one row of each group that agrees in these columns: the smallest
    usable one, or the smallest if none is usable. The usable ones are the clean readings. Both they and the quality report come out
    of one shuffle of the raw rows when this table is stored.
    """
    require_columns(df, [measure])
    typed = type_time_parts(df, time_parts)
    if dedupe_on is None:
        distinct = typed.groupBy(*typed.columns).agg(F.count(F.lit(1)).alias("copies"))
        return _with_usable(distinct, measure, output, time_parts, strict)
    require_columns(df, dedupe_on)
    assessed = _with_usable(typed, measure, output, time_parts, strict)
    rest = [c for c in typed.columns if c not in dedupe_on]
    order = F.struct((~F.col("usable")).alias("unusable"), *rest, output, "usable")
    grouped = assessed.groupBy(*dedupe_on).agg(F.count(F.lit(1)).alias("copies"), F.min(order).alias("_row"))
    kept = grouped.select(*dedupe_on, "_row.*", "copies")
    return kept.select(*typed.columns, "copies", output, "usable")


def quality_of(assessed: DataFrame, malformed: str | None = None) -> DataFrame:
    """One row: raw, distinct and clean row counts of assessed readings, and those of malformed lines."""
    read = F.lit(True) if malformed is None else F.col(malformed).isNull()
    counts = [
        F.coalesce(F.sum(F.when(read, F.col("copies"))), F.lit(0)).alias("raw_rows"),
        F.count_if(read).alias("distinct_rows"),
        F.count_if(F.col("usable") & read).alias("clean_rows"),
    ]
    if malformed is not None:
        counts.append(F.coalesce(F.sum(F.when(~read, F.col("copies"))), F.lit(0)).alias("malformed_rows"))
    return assessed.agg(*counts)


def quality_report(
    df: DataFrame,
    measure: str = "pm25_raw",
    time_parts: Sequence[str] = TIME_PARTS,
    strict: bool = False,
    dedupe_on: Sequence[str] | None = None,
    malformed: str | None = None,
) -> DataFrame:
    """Row counts of raw readings, from a single pass over them.

    ``malformed`` is the column of lines that could not be read: they are counted as
    ``malformed_rows`` and in no other count.

    With ``dedupe_on`` the counts need no row of a group, only whether one is usable:
    that is a hash aggregation of the key and a flag, without sorting the readings.
    """
    if malformed is not None:
        require_columns(df, [malformed])
    if dedupe_on is None:
        return quality_of(assess_readings(df, measure, time_parts=time_parts, strict=strict), malformed)
    require_columns(df, [measure, *dedupe_on])
    # Columns the key does not need are typed for the flag alone.
    rows = _with_usable(type_time_parts(df, time_parts), measure, "_value", time_parts, strict)
    key = list(dedupe_on) if malformed is None else [*dedupe_on, malformed]
    groups = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"), F.bool_or("usable").alias("usable"))
    return quality_of(groups, malformed)
