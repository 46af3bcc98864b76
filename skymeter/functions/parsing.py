"""Turning dirty text into numbers. Nothing here throws under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the marker that stands for "no reading" in the raw files.
MISSING_MARKER = "NA"


def nan_to_null(value: Column) -> Column:
    """NaN counts as missing: otherwise it wins every ``max`` and every ``>``."""
    return F.nullif(value, F.lit(float("nan")))


def parse_number(text: Column, marker: str = MISSING_MARKER, strict: bool = False) -> Column:
    """Double from text, NULL where there is none.

    By default the marker is removed wherever it stands, so ``1NA2`` reads as 12;
    ``strict`` accepts only text that is a number as it is.
    """
    text = text.cast("string")
    if not strict:
        text = F.replace(text, F.lit(marker), F.lit(""))
    return nan_to_null(text.try_cast("double"))


def parse_decimal_comma(text: Column) -> Column:
    """Double from text such as ``12,5``. NaN is kept; see ``reading_pairs``."""
    return F.translate(text.cast("string"), ",", ".").try_cast("double")
