from __future__ import annotations

import os
import subprocess
import sys
import time
from pathlib import Path

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from skymeter.session import (
    discard,
    load,
    materialize,
    scratch,
    shuffle_partitions,
    store,
    stored_for_join,
    work_path,
    work_root,
)


def test_the_folder_the_cluster_names_is_used(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert work_root(spark) == named.rstrip("/")
    assert work_path(spark, "x").startswith(f"{work_root(spark)}/skymeter/x-")
    assert work_path(spark, "x") != work_path(spark, "x")


def test_a_session_without_a_shared_folder_is_an_error():
    class Context:
        master = "local[4]"
        applicationId = "app"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_root(Session())


def test_materialize_cuts_the_lineage_and_keeps_the_rows(spark):
    df = spark.range(10).withColumn("even", F.col("id") % 2 == 0)
    stored = materialize(df, "test")
    assert stored.schema == df.schema or stored.dtypes == df.dtypes
    assert "Range" not in stored._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.id for r in stored.collect()) == list(range(10))


def test_partitions_are_pruned(spark):
    df = materialize(spark.range(10).withColumn("even", F.col("id") % 2 == 0), "test", ["even"])
    even = df.filter("even")
    assert "PartitionFilters: [isnotnull(even" in even._jdf.queryExecution().executedPlan().toString()
    assert even.count() == 5


def test_metrics_come_from_the_writing_job_and_discard_removes_the_table(spark):
    seen = Observation()
    path = store(spark.range(7), "test", seen, [F.count(F.lit(1)).alias("n")])
    assert seen.get["n"] == load(spark, path, spark.range(0).schema).count() == 7
    discard(spark, path)
    assert not os.path.exists(path.removeprefix("file:"))
    with pytest.raises(ValueError):
        discard(spark, "/somewhere/else")


def test_shuffle_partitions_follow_the_input():
    assert shuffle_partitions(1) == 1
    assert shuffle_partitions(1, minimum=8) == 8
    assert shuffle_partitions(100 * 10**12) == 93_133


def test_a_scratch_scope_leaves_only_its_results(spark):
    def exists(path):
        return os.path.exists(path.removeprefix("file:").replace("//", "/"))

    with scratch(spark) as outer:
        with scratch(spark) as area:
            gone = store(spark.range(3), "gone")
            kept = area.result(spark.range(4), "kept")
            path = area.results[0]
        assert not exists(gone) and exists(path) and kept.count() == 4
        outer.keep(path)
    assert exists(path)
    with pytest.raises(RuntimeError), scratch(spark) as area:
        area.result(spark.range(4), "kept")
        path = area.results[0]
        raise RuntimeError
    assert not exists(path)


def test_few_rows_with_long_keys_are_not_broadcast(spark):
    rows = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("key"), F.col("id").alias("n"))
    assert "broadcast" in stored_for_join(rows, "short", 20_000)._jdf.queryExecution().logical().toString()
    long = stored_for_join(rows, "long", 9_000)._jdf.queryExecution().logical().toString()
    assert "merge" in long and "broadcast" not in long


SESSION_WITH_TABLES = """
import sys
from skymeter.session import build_session, materialize, scratch
spark = build_session("tables", "local[1]", **{"spark.ui.enabled": "false", "spark.checkpoint.dir": sys.argv[1]})
left = materialize(spark.range(5), "left")
with scratch(spark):
    gone = materialize(spark.range(5), "gone")
import os
print("during", sorted(n.split("-")[0] for n in os.listdir(sys.argv[1] + "/skymeter")), left.count())
spark.stop()
"""


def test_stored_tables_go_with_the_session(tmp_path):
    root = Path(__file__).resolve().parents[1]
    done = subprocess.run(
        [sys.executable, "-c", SESSION_WITH_TABLES, str(tmp_path)],
        env=os.environ | {"PYTHONPATH": str(root)}, capture_output=True, text=True, timeout=300,
    )
    assert "during ['left'] 5" in done.stdout, done.stderr[-2000:]
    deadline = time.monotonic() + 30  # the JVM ends a little later
    while os.listdir(tmp_path / "skymeter") and time.monotonic() < deadline:
        time.sleep(0.5)
    assert os.listdir(tmp_path / "skymeter") == []


def test_the_bench_leaves_no_tables(spark):
    import __spark_entry__ as contract
    import bench

    folder = work_root(spark).removeprefix("file://") + "/skymeter"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    for name in ("dedupe", "csv_malformed", "string_index", "pagerank_chain", "stream_alert_batches", "grown_threshold"):
        assert bench.run(contract.queries()[name], spark, "/root/testdata/sf0.001") > 0
    assert set(os.listdir(folder)) <= before
