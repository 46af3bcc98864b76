"""A table of a stream's batches that a repeated batch cannot fill twice.

Every batch has a folder of its own, written whole, and then a manifest. A batch that is
run again after a failure replaces its folder if its manifest is missing, and is left
alone otherwise; readers see batches with a manifest only. Rows are dealt to few files of
even size, instead of one for each task of each batch.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

MANIFEST = T.StructType(
    [T.StructField("stream", T.StringType()), T.StructField("batch", T.LongType()), T.StructField("rows", T.LongType())]
)


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def stream_name(checkpoint: str) -> str:
    """Batches are numbered by checkpoint, so one that starts anew does not meet the numbers of the last."""
    return hashlib.md5(checkpoint.encode()).hexdigest()[:12]


def write_batch(rows: DataFrame, batch: int, path: str, stream: str) -> None:
    """Writes one batch and its manifest, unless the manifest is there."""
    spark = rows.sparkSession
    manifest = f"{path}/manifest/stream={stream}/batch={batch}"
    if _exists(spark, f"{manifest}/_SUCCESS"):
        return
    seen = Observation()
    counted = rows.hint("rebalance").observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").parquet(f"{path}/data/stream={stream}/batch={batch}")
    known = spark.createDataFrame([(seen.get["rows"],)], "rows long").coalesce(1)
    known.write.mode("overwrite").json(manifest)


def write_batches(df: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Writes the stream as batches with manifests: each row once, whatever fails in between."""
    stream = stream_name(checkpoint)
    writer = df.writeStream.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.foreachBatch(lambda rows, batch: write_batch(rows, batch, path, stream)).start()


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """``stream, batch, rows`` of the finished batches."""
    if not _exists(spark, f"{path}/manifest"):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).json(f"{path}/manifest")


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all finished batches. Folders of others are pruned by the join."""
    if not _exists(spark, f"{path}/data"):
        return spark.createDataFrame([], schema)
    keys = T.StructType([*schema.fields, *MANIFEST.fields[:2]])
    rows = spark.read.schema(keys).parquet(f"{path}/data")
    return rows.join(read_manifests(spark, path), ["stream", "batch"], "left_semi").select(*schema.names)
