"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructType

# Uncompressed input per shuffle partition. About a third of it is written, which
# sorts and hashes in an executor's memory and keeps 100 TB below 100,000 partitions.
SHUFFLE_PARTITION_BYTES = 1024**3

# Counted bytes of a table that may be broadcast; its hash table takes two or three times that.
BROADCAST_BYTES = 32 * 1024**2
# A row's own cost in such a table, and a value of fixed width.
ROW_BYTES, VALUE_BYTES = 16, 8


def shuffle_partitions(input_bytes: int, minimum: int = 1) -> int:
    """Partitions for a shuffle of whole rows: deduplication moves all of its input.

    AQE joins partitions that turn out small but never adds any, so the number has to
    follow the largest shuffle.
    """
    return max(minimum, -(-input_bytes // SHUFFLE_PARTITION_BYTES))


def build_session(
    app_name: str = "skymeter", master: str | None = None, input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with the settings the operators are written for.

    The master belongs to the cluster; pass it (or a ``spark-submit`` option) instead
    of fixing it in code. ``input_bytes``, the uncompressed size of the raw readings,
    sets the number of shuffle partitions.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    if input_bytes is not None:
        settings.setdefault("spark.sql.shuffle.partitions", str(shuffle_partitions(input_bytes)))
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    It is the one named in ``spark.checkpoint.dir`` (or set on the context). Without
    either there is none: executors cannot read each other's local disks.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    raise ValueError("set spark.checkpoint.dir to a folder all executors share")


class Scratch:
    """Tables stored within a :func:`scratch` scope."""

    def __init__(self) -> None:
        self.paths: list[str] = []
        self.results: list[str] = []

    def keep(self, path: str) -> None:
        """Leave this table when the scope ends."""
        self.paths.remove(path)
        self.results.append(path)

    def keep_all(self) -> list[str]:
        """Leave all tables when the scope ends; returns their paths."""
        self.results += self.paths
        self.paths = []
        return list(self.results)

    def result(self, df: DataFrame, name: str) -> DataFrame:
        """A stored table that outlives the scope."""
        path = store(df, name)
        self.keep(path)
        return load(df.sparkSession, path, df.schema)


_scratch: ContextVar[Scratch | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """A scope that deletes what is stored within it, however it ends, except its results."""
    outer, area = _scratch.get(), Scratch()
    token = _scratch.set(area)
    try:
        yield area
    except BaseException:
        area.paths += area.results
        area.results = []
        raise
    finally:
        _scratch.reset(token)
        for path in area.paths:
            discard(spark, path)
        if outer is not None:
            outer.paths += area.results


def work_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below :func:`work_root`."""
    return f"{work_root(spark)}/skymeter/{name}-{uuid.uuid4().hex}"


def own(spark: SparkSession, path: str) -> str:
    """Makes a written folder below :func:`work_root` the property of the scope and the session.

    It is deleted when the scope around ends, and otherwise when the driver's JVM does: a
    result that reads it lives as long as its session, and nothing is left afterwards.
    Only a driver that is killed leaves folders behind.
    """
    area = _scratch.get()
    if area is not None:
        area.paths.append(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def store(
    df: DataFrame,
    name: str,
    observation: Observation | None = None,
    metrics: Sequence[Column] = (),
    partition_by: Sequence[str] = (),
) -> str:
    """Write ``df`` to a new path of the shared folder and return the path.

    ``metrics`` are collected into ``observation`` by the same job.
    """
    path = work_path(df.sparkSession, name)
    out = df if observation is None else df.observe(observation, *metrics)
    try:
        out.write.partitionBy(*partition_by).parquet(path)
    finally:
        own(df.sparkSession, path)
    return path


def load(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table written by :func:`store`; the known schema saves a job that reads footers."""
    return spark.read.schema(schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table written by :func:`store` that nothing reads any more."""
    if not path.startswith(f"{work_root(spark)}/skymeter/"):
        raise ValueError(f"not a stored table: {path}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(target, True)
    files.cancelDeleteOnExit(target)


def materialize(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Store ``df`` in the shared folder and return the stored table.

    Cuts the lineage in a way that survives lost executors.
    """
    return load(df.sparkSession, store(df, name, partition_by=partition_by), df.schema)


def row_bytes(schema: StructType) -> Column:
    """About the memory a row takes in a broadcast table."""
    fixed = ROW_BYTES + VALUE_BYTES * len(schema.fields)
    texts = [f.name for f in schema.fields if isinstance(f.dataType, StringType | BinaryType)]
    return sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(fixed).cast("long"))


def stored_for_join(df: DataFrame, name: str, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Store a table of few columns and mark how to join it by its counted bytes.

    Up to ``broadcast_bytes`` it is broadcast, so the other side is not shuffled. Beyond,
    it is a shuffle join, where AQE splits the hot keys of the other side. The count is
    a metric of the writing job; a task that runs twice can only raise it.
    """
    seen = Observation()
    path = store(df, name, seen, [F.coalesce(F.sum(row_bytes(df.schema)), F.lit(0)).alias("bytes")])
    stored = load(df.sparkSession, path, df.schema)
    return F.broadcast(stored) if seen.get["bytes"] <= broadcast_bytes else stored.hint("merge")
