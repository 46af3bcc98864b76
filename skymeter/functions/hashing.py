"""Hash buckets that depend on the row alone, not on how it is partitioned."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_bucket(keys: list[Column], buckets: int, seed: int) -> Column:
    """Bucket 0..buckets-1 from the md5 of the seed and the keys."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("")) for k in keys])
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % buckets).cast("int")
