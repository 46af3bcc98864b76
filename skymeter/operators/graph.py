"""Station graph: vertices, edges, PageRank and one-hop propagation.

A graph is two DataFrames. Vertices have a key ``station`` and an attribute, edges
``src, dst, weight`` with keys at both ends.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from skymeter.operators.stats import group_stats
from skymeter.session import BROADCAST_BYTES, discard, load, materialize, row_bytes, scratch, store, stored_for_join

# Share passed on to neighbours, PageRank's reset probability and
# tolerance, edge weight, attributes of a vertex nobody described.
PROPAGATED_SHARE = 0.1
RESET_PROBABILITY = 0.15
TOLERANCE = 0.0001
EDGE_WEIGHT = 1.0
UNKNOWN_STATION = "Unknown"
UNKNOWN_VALUE = 0.0

# A round refers to the state before it up to three times, so the plan of several grows by that factor.
ROUNDS_PER_WRITE = 4
# Links of a partition. A hash table of the state that goes with them stays below
# 300 MB, and 10^11 links make 25,000 tasks a round.
ROWS_PER_PARTITION = 4_000_000
MIN_ROWS_PER_PARTITION = 50_000
# Links of one vertex that are kept together.
HOT_DEGREE = 1_000_000
# The state of hubs passes through the driver in every round that broadcasts it, and there may
# be more than a hundred rounds: each has this part of ``BROADCAST_BYTES``.
HUB_BROADCASTS = 32
# Receivers in one row of the links.
LIST_LINKS = 1_000


def dense_ids(df: DataFrame, key: str | Sequence[str | Column], output: str = "id") -> DataFrame:
    """Adds ids 0..n-1 in the order of a unique key, without one global sort.

    The key, one column or several in their order, is range-partitioned; a row's id is
    its position in its partition plus the number of rows in earlier partitions. Only
    those counts, one per partition, are summed up in one place and broadcast.
    """
    # monotonically_increasing_id holds the partition above the row number in it.
    bits = 33
    ranged = df.orderBy(*([key] if isinstance(key, str) else key)).withColumn("_position", F.monotonically_increasing_id())
    stored = materialize(ranged, "dense-ids")
    partition = F.shiftright("_position", bits).alias("_partition")
    earlier = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored.groupBy(partition).agg(F.count(F.lit(1)).alias("_rows"))
    offsets = counts.select("_partition", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    located = stored.withColumn("_partition", partition).join(F.broadcast(offsets), "_partition")
    position = F.col("_position").bitwiseAND(F.lit((1 << bits) - 1))
    return located.select((F.col("_offset") + position).alias(output), *df.columns)


def station_vertices(df: DataFrame, station: str = "station", value: str = "pm25") -> DataFrame:
    """Vertices ``id, station, avg_<value>``: one per station with its mean reading."""
    means = group_stats(df, station, value).select(
        F.col(station).alias("station"), F.col(f"{value}_mean").alias(f"avg_{value}")
    )
    return dense_ids(means.filter(F.col("station").isNotNull()), "station")


def station_edges(vertices: DataFrame, connections: DataFrame) -> DataFrame:
    """Edges for the connections ``src, dst`` whose two ends are known stations."""
    ids = vertices.select("id", "station")
    source = ids.select(F.col("id").alias("src_id"), F.col("station").alias("src"))
    target = ids.select(F.col("id").alias("dst_id"), F.col("station").alias("dst"))
    return (
        connections.select("src", "dst")
        .join(source, "src")
        .join(target, "dst")
        .select("src_id", "dst_id", "src", "dst", F.lit(EDGE_WEIGHT).alias("weight"))
    )


def assemble_vertices(
    vertices: DataFrame,
    edges: DataFrame,
    key: str = "station",
    src: str = "src",
    dst: str = "dst",
    defaults: dict[str, object] | None = None,
) -> DataFrame:
    """Vertices plus one with default attributes for each edge end that has none."""
    defaults = {} if defaults is None else defaults
    ends = edges.select(F.col(src).alias(key)).union(edges.select(F.col(dst).alias(key))).distinct()
    joined = vertices.withColumn("_known", F.lit(True)).join(ends, key, "full")
    unknown = F.col("_known").isNull()
    filled = {c: F.when(unknown, F.lit(v)).otherwise(F.col(c)) for c, v in defaults.items()}
    return joined.withColumns(filled).drop("_known").select(*vertices.columns)


def label_by_key(
    df: DataFrame,
    vertices: DataFrame,
    key: str = "id",
    label: str = "station",
    default: str = UNKNOWN_STATION,
) -> DataFrame:
    """Adds the label of a vertex; one that is not listed gets the default."""
    labels = vertices.select(key, label)
    return df.join(labels, key, "left").withColumn(label, F.coalesce(label, F.lit(default)))


def propagate(
    vertices: DataFrame,
    edges: DataFrame,
    value: str = "avg_pm25",
    key: str = "station",
    share: float = PROPAGATED_SHARE,
) -> DataFrame:
    """What each vertex receives when all pass ``share`` of their value along every edge.

    Vertices without an incoming edge are absent.
    """
    sent = vertices.select(F.col(key).alias("src"), (F.col(value) * F.lit(share)).alias("_sent"))
    return (
        edges.select("src", "dst")
        .join(sent, "src")
        .groupBy(F.col("dst").alias(key))
        .agg(F.sum("_sent").alias("received"))
    )


def _weighted_links(vertices: DataFrame, edges: DataFrame, key: str, hot_degree: int) -> DataFrame:
    """Links of the PageRank loop: ``node, block, slice, dst, weight, blocks``.

    Parallel edges are merged into one link whose weight is their share of the
    node's edges. Each node also has a row without a receiver, from which its state
    starts. The links of a node with more than ``hot_degree`` of them, a hub, are spread
    over several blocks, and those of a block over slices of about ``LIST_LINKS``.
    """
    # Read three times from here on.
    pairs = materialize(edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("_copies")), "pairs")
    receivers = F.count(F.lit(1))
    blocks = F.ceil(receivers / F.lit(hot_degree)).cast("int")
    degrees = pairs.groupBy("src").agg(
        F.sum("_copies").alias("_degree"),
        blocks.alias("blocks"),
        (blocks * F.ceil(receivers / (blocks * F.lit(LIST_LINKS)))).alias("_slices"),
    )
    degrees = stored_for_join(degrees, "degrees")
    nodes = (
        vertices.select(F.col(key).alias("node"))
        .union(degrees.select("src"))
        .union(pairs.select("dst"))
        .distinct()
    )
    links = pairs.join(degrees, "src").withColumn("slice", F.pmod(F.xxhash64("dst"), F.col("_slices"))).select(
        F.col("src").alias("node"),
        F.pmod("slice", F.col("blocks")).cast("int").alias("block"),
        "slice",
        "dst",
        (F.col("_copies") / F.col("_degree")).alias("weight"),
        "blocks",
    )
    own = nodes.join(degrees.withColumnRenamed("src", "node"), "node", "left").select(
        "node",
        F.lit(0).alias("block"),
        F.lit(0).cast("long").alias("slice"),
        F.lit(None).cast(links.schema["dst"].dataType).alias("dst"),
        F.lit(None).cast("double").alias("weight"),
        F.coalesce("blocks", F.lit(1)).alias("blocks"),
    )
    return links.unionByName(own)


@dataclass
class _Links:
    """Links by sender, and those of hubs, dealt evenly by their blocks.

    A row lists the receivers of a sender that get the same share, so that a round joins
    a sender once, not once a link.
    """

    ordinary: DataFrame
    of_hubs: DataFrame | None
    # Whether the state of all hubs may be broadcast.
    few_hubs: bool


def _listed(links: DataFrame, partitions: int, *keys: str) -> DataFrame:
    """Links in rows ``*keys, weight, receivers``, partitioned by the keys."""
    placed = links.repartition(partitions, *keys)
    lists = placed.groupBy(*keys, "slice", "weight").agg(F.collect_list("dst").alias("receivers"))
    return lists.drop("slice")


def _round(state: DataFrame, links: _Links, keep: float, tolerance: float) -> DataFrame:
    """The state ``node, rank, delta, blocks`` after one round.

    Only vertices whose change exceeds the tolerance are joined with their links, and
    only the messages move, in one exchange: state and links stay partitioned by node.
    What hubs send is told to the blocks of their links by a broadcast, and united with
    the other messages before the one aggregation. Too many hubs for that are dealt to
    the blocks themselves; the state of other vertices still does not move.
    """
    senders = state.filter(F.col("delta") > F.lit(tolerance))
    messages = F.explode("receivers").alias("dst"), (F.col("delta") * F.col("weight")).alias("sent")
    own = senders.filter("blocks = 1").select("node", "delta")
    sent = links.ordinary.join(own.hint("shuffle_hash"), "node").select(*messages)
    if links.of_hubs is not None:
        hubs = senders.filter("blocks > 1")
        if links.few_hubs:
            told = links.of_hubs.join(F.broadcast(hubs.select("node", "delta")), "node")
        else:
            block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
            told = links.of_hubs.join(hubs.select("node", "delta", block).hint("shuffle_hash"), ["node", "block"])
        sent = sent.union(told.select(*messages))
    received = sent.groupBy(F.col("dst").alias("node")).agg((F.lit(keep) * F.sum("sent")).alias("received"))
    change = F.coalesce("received", F.lit(0.0))
    return state.join(received.hint("shuffle_hash"), "node", "left").select(
        "node", (F.col("rank") + change).alias("rank"), change.alias("delta"), "blocks"
    )


def pagerank(
    vertices: DataFrame,
    edges: DataFrame,
    key: str = "station",
    tolerance: float = TOLERANCE,
    reset: float = RESET_PROBABILITY,
    hot_degree: int = HOT_DEGREE,
    rounds_per_write: int = ROUNDS_PER_WRITE,
) -> DataFrame:
    """PageRank ``key, rank`` to convergence; the ranks sum to the number of vertices.

    Every vertex starts with rank and change ``reset``. In a round, each vertex whose
    last change exceeds the tolerance sends it, split evenly, along its edges;
    receivers add ``1 - reset`` times what arrives. It ends when nobody sends.

    Links and state stay partitioned by vertex, so a round shuffles messages (already
    combined per task) and nothing else, and what it joins falls with the senders. The
    links of a vertex with more than ``hot_degree`` of them lie apart in even blocks, to
    which its state is broadcast; there are at most links / ``hot_degree`` such vertices.
    After some rounds the state is written to the shared folder, which cuts the lineage;
    the same job counts who would send next. Rounds after the end change nothing, so
    stopping only between writes is exact.
    """
    with scratch(edges.sparkSession) as area:
        ranks = _converged(vertices, edges, key, tolerance, reset, hot_degree, rounds_per_write, area)
    scale = ranks.agg(F.count(F.lit(1)) / F.sum("rank")).scalar()
    return ranks.select(F.col("node").alias(key), (F.col("rank") * scale).alias("rank"))


def _partitions(rows: int, cores: int) -> int:
    """Partitions of so many links: full waves of the cores, or one of fewer for few links."""
    waves = max(-(-rows // (ROWS_PER_PARTITION * cores)), 1)
    return max(min(waves * cores, -(-rows // MIN_ROWS_PER_PARTITION)), 1)


def _converged(vertices, edges, key, tolerance, reset, hot_degree, rounds_per_write, area) -> DataFrame:
    """Unscaled ranks in a stored table; all others are left to the scope."""
    spark = edges.sparkSession
    edges = edges.select("src", "dst").dropna()
    vertices = vertices.select(key).dropna()
    links_seen = Observation()
    links = _weighted_links(vertices, edges, key, hot_degree)
    own, hub = F.col("weight").isNull(), F.col("blocks") > 1
    told = row_bytes(links.select("node", "weight").schema)
    counts = [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(own & hub).alias("hubs"),
        F.coalesce(F.sum(F.when(own & hub, told)), F.lit(0)).alias("hub_bytes"),
    ]
    links_path = store(links, "links", links_seen, counts)
    seen = links_seen.get
    partitions = _partitions(seen["rows"], spark.sparkContext.defaultParallelism)

    # The loop has a session of its own, where one partition count holds for every
    # shuffle: what lets the cached links be joined in place. The caller's settings
    # stay as they are.
    loop = spark.newSession()
    loop.conf.set("spark.sql.adaptive.enabled", "false")
    loop.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    loop.conf.set("spark.sql.shuffle.partitions", str(partitions))
    loop.conf.set("spark.sql.constraintPropagation.enabled", "false")
    # A task's messages have too many receivers for the small hash table before the large one.
    loop.conf.set("spark.sql.codegen.aggregate.map.twolevel.enabled", "false")

    stored = load(loop, links_path, links.schema)
    cached = [_listed(stored.filter(~own & ~hub), partitions, "node").persist()]
    if seen["hubs"]:
        cached.append(_listed(stored.filter(~own & hub), partitions, "node", "block").persist())
    placed = _Links(cached[0], cached[1] if seen["hubs"] else None, seen["hub_bytes"] <= BROADCAST_BYTES // HUB_BROADCASTS)
    start = F.lit(reset)
    state = stored.filter(own).select("node", start.alias("rank"), start.alias("delta"), "blocks")
    senders = F.count_if(F.col("delta") > F.lit(tolerance)).alias("senders")
    path = None
    try:
        active = True
        while active:
            states = [state.repartition(partitions, "node").persist()]
            cached += states
            for _ in range(rounds_per_write):
                states.append(_round(states[-1], placed, 1.0 - reset, tolerance).persist())
                cached.append(states[-1])
            seen = Observation()
            previous, path = path, store(states[-1], "ranks", seen, [senders])
            state = load(loop, path, states[-1].schema)
            active = seen.get["senders"] > 0
            for df in states:
                df.unpersist()
            if previous:
                discard(spark, previous)
    finally:
        for df in cached:
            df.unpersist()
    area.keep(path)
    return load(spark, path, state.schema)
