"""Raw readings from CSV files, and small tables from literal rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

READING_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("station", T.StringType()),
        T.StructField("pm25", T.DoubleType()),
    ]
)
CONNECTION_SCHEMA = T.StructType([T.StructField("src", T.StringType()), T.StructField("dst", T.StringType())])


# Fixed value: the file's name of the main measure, whatever its case. The clean one is called pm25.
RENAMES = {"pm2.5": "pm25_raw"}


def column_name(name: str) -> str:
    """Lower case without dots, so that no column needs quoting."""
    lower = name.strip().lower()
    return RENAMES.get(lower, lower.replace(".", ""))


def column_names(names: Sequence[str]) -> list[str]:
    """Names for all columns of a header; an error if two become the same."""
    found: dict[str, str] = {}
    for name in names:
        other = found.setdefault(column_name(name), name)
        if other is not name:
            raise ValueError(f"columns {other!r} and {name!r} would both be called {column_name(name)!r}")
    return list(found)


def read_readings(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | None = None,
    infer_schema: bool = False,
    malformed: str | None = None,
) -> DataFrame:
    """Union of CSV files with a header line.

    Without a schema every column is text, typed later by the cleaning operators;
    only the first header is read for that. ``infer_schema`` types clean columns at
    the price of one more pass over all files. Files match by position, and a file
    whose header differs is an error, not silently misread.

    ``malformed`` names a further column: the whole line where it has too few or too many
    fields, or a value that is not of its type; NULL for all others. Without it such
    values are NULL, unnoticed. ``split_malformed`` parts the two.
    """
    files = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if schema is None and (infer_schema or malformed is None):
        reader = reader.option("inferSchema", infer_schema)
    if malformed is not None:
        # A line is held against all columns, so none may be pruned from the parser.
        schema = reader.csv(files).schema if schema is None else schema
        schema = T.StructType([*schema.fields, T.StructField(malformed, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", malformed).option("columnPruning", False)
    df = (reader if schema is None else reader.schema(schema)).csv(files)
    own = [c for c in df.columns if c != malformed]
    names = column_names(own)
    if malformed in names:
        raise ValueError(f"the files have a column {malformed!r} of their own")
    if malformed is None:
        return df.toDF(*names)
    # Spark refuses to read the line alone; any other column beside it will do, and always passes.
    read = F.length(F.coalesce(df[f"`{own[0]}`"].cast("string"), F.lit(""))) >= 0
    return df.select(*[df[f"`{c}`"].alias(n) for c, n in zip(own, names)], F.when(read, df[malformed]).alias(malformed))


def split_malformed(readings: DataFrame, malformed: str = "malformed") -> tuple[DataFrame, DataFrame]:
    """Readings without their column ``malformed``, and ``file, line`` of the lines that are none."""
    bad = readings.filter(F.col(malformed).isNotNull())
    lines = bad.select(F.col("_metadata.file_path").alias("file"), F.col(malformed).alias("line"))
    return readings.filter(F.col(malformed).isNull()).drop(malformed), lines


def connections_table(spark: SparkSession, pairs: Iterable[tuple[str, str]]) -> DataFrame:
    """Directed connections ``(src, dst)`` from literal pairs."""
    return spark.createDataFrame(list(pairs), CONNECTION_SCHEMA)


def readings_table(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    """Readings ``(timestamp, station, pm25)`` from literal rows."""
    return spark.createDataFrame(list(rows), READING_SCHEMA)
