from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fixtures import CHAIN_RANKS, CONNECTIONS, CYCLIC_EDGES, CYCLIC_RANKS, STATIONS
from skymeter.operators import graph as graph_operators
from skymeter.operators.graph import (
    assemble_vertices,
    dense_ids,
    label_by_key,
    pagerank,
    propagate,
    station_edges,
    station_vertices,
)
from skymeter.session import work_root
from skymeter.sources import connections_table


@pytest.fixture
def vertices(spark):
    rows = [(s, float(10 * i)) for i, s in enumerate(STATIONS)]
    return station_vertices(spark.createDataFrame(rows, "station string, pm25 double"))


def test_vertices_have_dense_ids_in_name_order(vertices):
    got = [(r.id, r.station) for r in vertices.orderBy("id").collect()]
    assert got == list(enumerate(sorted(STATIONS)))
    assert vertices.filter("station = 'Dongsi'").first().avg_pm25 == 10.0


def test_dense_ids_over_many_partitions(spark):
    keys = spark.range(0, 5000, 1, 7).select(F.xxhash64("id").alias("key"), "id")
    got = dense_ids(keys, "key", "n").orderBy("key").select("n").collect()
    assert [r.n for r in got] == list(range(5000))
    assert dense_ids(keys.filter("false"), "key").count() == 0


def test_edges_need_two_known_ends(spark, vertices, collected):
    pairs = [*CONNECTIONS, ("Dongsi", "Nowhere"), ("Nowhere", "Dongsi"), (None, "Dongsi")]
    edges = station_edges(vertices, connections_table(spark, pairs))
    assert collected(edges, "src", "dst", "weight") == sorted((a, b, 1.0) for a, b in CONNECTIONS)
    ids = {s: i for i, s in enumerate(sorted(STATIONS))}
    assert all(r.src_id == ids[r.src] and r.dst_id == ids[r.dst] for r in edges.collect())


def test_unknown_ends_get_default_attributes(spark, vertices, collected):
    edges = connections_table(spark, [("Dongsi", "Nowhere"), ("Elsewhere", "Nowhere")])
    got = assemble_vertices(
        vertices.select("station", "avg_pm25"), edges, defaults={"avg_pm25": 0.0}
    )
    assert got.count() == len(STATIONS) + 2
    assert collected(got.filter("station in ('Nowhere', 'Elsewhere', 'Dongsi')")) == [
        ("Dongsi", 10.0), ("Elsewhere", 0.0), ("Nowhere", 0.0)
    ]


def test_labels_have_a_default(spark, vertices, collected):
    ids = spark.createDataFrame([(0,), (99,)], "id long")
    assert collected(label_by_key(ids, vertices)) == [(0, "Aotizhongxin"), (99, "Unknown")]


def test_propagation_sums_over_incoming_edges(spark, vertices, collected):
    pairs = [("Dongsi", "Tiantan"), ("Guanyuan", "Tiantan"), ("Guanyuan", "Tiantan"), ("Tiantan", "Dongsi")]
    edges = connections_table(spark, pairs)
    got = collected(propagate(vertices, edges))
    assert got == [("Dongsi", pytest.approx(4.0)), ("Tiantan", pytest.approx(1.0 + 2.0 + 2.0))]
    assert collected(propagate(vertices, edges, share=0.0)) == [("Dongsi", 0.0), ("Tiantan", 0.0)]


def graph(spark, edges, nodes=()):
    key = "long" if edges and isinstance(edges[0][0], int) else "string"
    return (
        spark.createDataFrame([(n,) for n in nodes], f"station {key}"),
        spark.createDataFrame(edges, f"src {key}, dst {key}"),
    )


def ranks(spark, edges, nodes=(), **options):
    return {r.station: r["rank"] for r in pagerank(*graph(spark, edges, nodes), **options).collect()}


def plain_pagerank(edges, nodes, tolerance=0.0001, reset=0.15):
    nodes = {*nodes, *[v for e in edges for v in e]}
    degree = {n: sum(a == n for a, _ in edges) for n in nodes}
    rank = dict.fromkeys(nodes, reset)
    change = dict.fromkeys(nodes, reset)
    while change:
        message: dict = {}
        for a, b in edges:
            if change.get(a, 0.0) > tolerance:
                message[b] = message.get(b, 0.0) + change[a] / degree[a]
        change = {n: (1 - reset) * m for n, m in message.items()}
        for n, c in change.items():
            rank[n] += c
    scale = len(nodes) / sum(rank.values())
    return {n: r * scale for n, r in rank.items()}


def test_pagerank_of_the_station_chain(spark):
    got = ranks(spark, CONNECTIONS)
    assert [got[s] for s in STATIONS] == pytest.approx(CHAIN_RANKS, abs=1e-6)
    assert sum(got.values()) == pytest.approx(len(STATIONS))


@pytest.mark.parametrize("options", [{}, {"hot_degree": 1}, {"rounds_per_write": 3}])
def test_pagerank_with_cycles_sink_and_source(spark, options):
    got = ranks(spark, CYCLIC_EDGES, **options)
    assert [got[n] for n in range(1, 7)] == pytest.approx(CYCLIC_RANKS, abs=1e-8)


def test_pagerank_counts_parallel_edges_and_isolated_vertices(spark):
    edges = [(1, 2), (1, 2), (1, 3), (3, 3), (2, 1)]
    edges_with_gaps = [*edges, (1, None), (None, 2)]
    assert ranks(spark, edges_with_gaps, [1, 9, None]) == pytest.approx(plain_pagerank(edges, [9]), abs=1e-9)


def test_pagerank_without_edges_is_one_everywhere(spark):
    assert ranks(spark, [], ["a", "b"]) == pytest.approx({"a": 1.0, "b": 1.0})


def test_hot_vertex_is_split_and_ranked_the_same(spark):
    """One vertex has a third of all edges, outgoing and incoming."""
    rng = random.Random(7)
    edges = [(0, n) for n in range(1, 60)] + [(n, 0) for n in range(1, 60)]
    edges += [(rng.randrange(60), rng.randrange(60)) for _ in range(60)]
    expected = plain_pagerank(edges, [])
    assert ranks(spark, edges) == pytest.approx(expected, abs=1e-9)
    assert ranks(spark, edges, hot_degree=5) == pytest.approx(expected, abs=1e-9)


def hub_edges(seed=7):
    rng = random.Random(seed)
    edges = [(0, n) for n in range(1, 60)] + [(n, 0) for n in range(1, 60)]
    return edges + [(rng.randrange(60), rng.randrange(60)) for _ in range(60)]


def test_too_many_hubs_for_a_broadcast_rank_the_same(spark, monkeypatch):
    monkeypatch.setattr(graph_operators, "BROADCAST_BYTES", 0)
    expected = plain_pagerank(hub_edges(), [])
    assert ranks(spark, hub_edges(), hot_degree=5) == pytest.approx(expected, abs=1e-9)


def recorded_rounds(monkeypatch):
    """What goes into each round and comes out of it."""
    rounds, one = [], graph_operators._round

    def recorded(state, links, keep, tolerance):
        out = one(state, links, keep, tolerance)
        rounds.append((state, links, out))
        return out

    monkeypatch.setattr(graph_operators, "_round", recorded)
    return rounds


def test_a_round_with_hubs_has_one_exchange(spark, monkeypatch):
    rounds = recorded_rounds(monkeypatch)
    ranks(spark, hub_edges(), hot_degree=5, rounds_per_write=1)
    assert len(rounds) > 5
    # Both sides of a round were cached in place; only what a round adds to them counts.
    for _, links, out in rounds:
        plan = out._jdf.queryExecution().executedPlan().toString()
        own = plan.split("InMemoryRelation")[0]
        assert links.few_hubs and links.of_hubs is not None
        assert own.count("Exchange hashpartitioning") == 1 and own.count("BroadcastExchange") <= 1


def test_many_hubs_do_not_pass_through_the_driver(spark, monkeypatch):
    """40,000 hubs, 1.28 MB by counted bytes, would be sent to the driver in every round."""
    rounds, one, n = [], graph_operators._round, 40_000

    def recorded(state, links, keep, tolerance):
        out = one(state, links, keep, tolerance)
        rounds.append((links, out._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]))
        return out

    monkeypatch.setattr(graph_operators, "_round", recorded)
    nodes = spark.range(n).select(F.col("id").alias("station"))
    steps = [nodes.select(F.col("station").alias("src"), ((F.col("station") + k) % n).alias("dst")) for k in (1, 7)]
    got = pagerank(nodes, steps[0].union(steps[1]), hot_degree=1, tolerance=0.1)
    assert all(links.of_hubs is not None and "BroadcastExchange" not in plan for links, plan in rounds)
    assert got.filter("abs(rank - 1) < 1e-9").count() == n


def test_a_round_joins_a_sender_once_not_once_a_link(spark, monkeypatch):
    monkeypatch.setattr(graph_operators, "LIST_LINKS", 8)
    rows, one = [], graph_operators._round

    def counted(state, links, keep, tolerance):
        if not rows:
            rows.extend((r.node, len(r.receivers)) for r in links.ordinary.select("node", "receivers").collect())
        return one(state, links, keep, tolerance)

    monkeypatch.setattr(graph_operators, "_round", counted)
    edges = [(n, (n + k) % 50) for n in range(50) for k in (1, 2, 3)] + [(0, 1), (99, 0)] + [(99, n) for n in range(40)]
    assert ranks(spark, edges) == pytest.approx(plain_pagerank(edges, []), abs=1e-9)
    # A sender has a row for each share, and for about LIST_LINKS links; node 0 has two links to 1, and 99 to 0.
    assert sum(n for _, n in rows) == 190 and sorted(n for v, n in rows if v == 0) == [1, 2]
    assert all([n for v, n in rows if v == k] == [3] for k in range(1, 50))
    assert 1 < len([1 for v, _ in rows if v == 99]) <= 6


@pytest.mark.parametrize(
    "rows, cores, partitions",
    [(0, 12, 1), (120_000, 12, 3), (9_900_000, 12, 12), (48_000_000, 12, 12), (59_000_000, 12, 24), (10**11, 1000, 25_000)],
)
def test_links_fill_the_waves_of_the_cores(rows, cores, partitions):
    """15 partitions on 12 cores took as long as 24."""
    assert graph_operators._partitions(rows, cores) == partitions


def test_joined_rows_fall_with_the_senders(spark, monkeypatch):
    """On a chain the first vertices stop sending round by round."""
    joined = []
    one = graph_operators._round

    def counted(state, links, keep, tolerance):
        senders = state.filter(F.col("delta") > tolerance).select("node")
        joined.append((links.ordinary.join(senders, "node").count(), senders.count()))
        return one(state, links, keep, tolerance)

    monkeypatch.setattr(graph_operators, "_round", counted)
    chain = [(n, n + 1) for n in range(60)]
    got = ranks(spark, chain)
    assert got == pytest.approx(plain_pagerank(chain, []), abs=1e-9)
    rows = [n for n, _ in joined]
    assert rows[0] == 60 and rows == sorted(rows, reverse=True) and rows[40] == 20 and rows[-1] == 0
    assert all(n <= senders for n, senders in joined)


def test_pagerank_leaves_the_session_as_it_was(spark):
    keys = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"]
    before = [spark.conf.get(k) for k in keys]
    ranks(spark, CYCLIC_EDGES)
    assert [spark.conf.get(k) for k in keys] == before
    assert spark.getActiveSession().conf.get(keys[0]) == before[0]
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def stored_tables(spark):
    folder = Path(work_root(spark).removeprefix("file://")) / "skymeter"
    return {p.name for p in folder.iterdir()} if folder.is_dir() else set()


def test_pagerank_leaves_only_the_ranks_it_returns(spark, monkeypatch):
    before = stored_tables(spark)
    ranks(spark, CYCLIC_EDGES)
    left = stored_tables(spark) - before
    assert {name.split("-")[0] for name in left} == {"ranks"} and len(left) == 1

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    monkeypatch.setattr(graph_operators, "_round", fail)
    with pytest.raises(RuntimeError, match="lost"):
        ranks(spark, CYCLIC_EDGES)
    assert stored_tables(spark) - before == left
