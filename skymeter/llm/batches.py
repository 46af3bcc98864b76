"""Batches of texts that go to Python, and the memory they take there."""

from __future__ import annotations

import ctypes
import ctypes.util
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXT_ROWS = 1_000

Batches = Iterator[pa.RecordBatch]


def in_text_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session from now on sends at most ``TEXT_ROWS`` rows to Python at once.

    Texts are some KB long, and both sides hold a whole batch, Python as objects besides.
    A smaller setting of the session stays.
    """
    spark = df.sparkSession
    rows = int(spark.conf.get(SETTING, "0"))
    if not 0 < rows <= TEXT_ROWS:
        spark.conf.set(SETTING, str(TEXT_ROWS))
    return df


def give_back() -> None:
    """Returns freed memory to the system: a worker waits for its next task with it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(ctypes.util.find_library("c")), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_texts(df: DataFrame, function: Callable[[Batches], Batches], schema: str) -> DataFrame:
    """``mapInArrow`` in batches of texts, after which a worker holds little memory."""

    def mapped(batches: Batches) -> Batches:
        yield from function(batches)
        give_back()

    return in_text_batches(df).mapInArrow(mapped, schema)
