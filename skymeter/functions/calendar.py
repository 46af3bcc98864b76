"""Calendar features of a reading."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Months of each season and hours (inclusive) of each part of the
# day. Anything else, NULL included, takes the default.
SEASON_MONTHS = {"winter": (12, 1, 2), "spring": (3, 4, 5), "summer": (6, 7, 8)}
SEASON_DEFAULT = "autumn"
HOUR_RANGES = {"night": (0, 5), "morning": (6, 11), "afternoon": (12, 17)}
HOUR_DEFAULT = "evening"


def _first_match(cases: list[tuple[Column, str]], default: str) -> Column:
    expr = F
    for condition, label in cases:
        expr = expr.when(condition, label)
    return expr.otherwise(default)


def reading_time(year: Column, month: Column, day: Column, hour: Column) -> Column:
    """Wall-clock time of a reading; NULL for an impossible date such as 30 February.

    The type has no time zone, so the result does not depend on the session's.
    """
    return F.try_make_timestamp_ntz(year, month, day, hour, F.lit(0), F.lit(0))


def season(month: Column) -> Column:
    return _first_match([(month.isin(*m), name) for name, m in SEASON_MONTHS.items()], SEASON_DEFAULT)


def hour_category(hour: Column) -> Column:
    return _first_match([(hour.between(*r), name) for name, r in HOUR_RANGES.items()], HOUR_DEFAULT)


def is_weekend(time: Column) -> Column:
    """1 on Saturday and Sunday, 0 otherwise and for NULL. Independent of the locale."""
    return F.coalesce(F.dayofweek(time).isin(1, 7), F.lit(False)).cast("int")
