"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from skymeter.session import Scratch, discard, load, materialize, scratch, store


def _to_smallest(pairs: DataFrame) -> DataFrame:
    """``node, smallest``: the smallest of each node's neighbours and itself."""
    return pairs.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("smallest"))


def _stored_smallest(pairs: DataFrame) -> DataFrame:
    """The same, stored: the links of a node with very many are split in a join with a stored table."""
    return materialize(_to_smallest(pairs), "smallest")


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a"))
    linked = both.filter("other > node").join(_stored_smallest(both), "node")
    return linked.select(F.col("other").alias("a"), F.col("smallest").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other"))
    smallest = _stored_smallest(down)
    linked = down.join(smallest, "node").filter("other > smallest")
    moved = linked.select(F.col("other").alias("a"), F.col("smallest").alias("b"))
    own = smallest.select(F.col("node").alias("a"), F.col("smallest").alias("b"))
    return moved.union(own).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for edges ``a, b``: the smallest node that can be reached.

    Only nodes other than the smallest of their component are listed. Every round moves
    each node's links to its smallest neighbour, first those of larger neighbours and
    then those of smaller ones, until only stars are left; the number of rounds grows
    with the logarithm of the nodes. The links are written after each round, which cuts
    the lineage, and their count and checksum tell when nothing changes any more.
    """
    with scratch(edges.sparkSession) as area:
        return _stars(edges.filter("a <> b").select("a", "b").distinct(), area)


def _stars(edges: DataFrame, area: Scratch) -> DataFrame:
    spark = edges.sparkSession
    check = [F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("sum")]
    path, last = None, None
    while True:
        seen = Observation()
        before, path = path, store(edges, "components", seen, check)
        current = load(spark, path, edges.schema)
        if before:
            discard(spark, before)
        state = seen.get
        if not state["n"] or state == last:
            area.keep(path)
            return current.select(F.col("a").alias("node"), F.col("b").alias("label"))
        last = state
        edges = _small_star(_large_star(current))
