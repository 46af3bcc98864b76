"""Queries: station graph, propagation, PageRank."""

from __future__ import annotations

from pyspark.sql import functions as F

from skymeter.operators.graph import (
    UNKNOWN_STATION,
    UNKNOWN_VALUE,
    assemble_vertices,
    label_by_key,
    pagerank,
    propagate,
    station_edges,
    station_vertices,
)
from skymeter.plans.adapters import (
    CUSTOMER_EDGES,
    EDGES_BEYOND,
    NATION_CONNECTIONS,
    NATION_READINGS,
    customer_chain,
    customer_edges,
    customer_vertices,
    edges_beyond,
    nation_connections,
    nation_readings,
)
from skymeter.sources import load_table


def _vertices(spark, folder):
    return station_vertices(nation_readings(spark, folder))


def _rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _customers(spark, folder):
    """Vertices that do not cover all ends of the edges."""
    customers = load_table(spark, folder, "customer")
    return customers.selectExpr("c_custkey AS id", "c_name AS station", "c_acctbal AS avg_pm25")


def graph_assembly(spark, folder):
    defaults = {"station": UNKNOWN_STATION, "avg_pm25": UNKNOWN_VALUE}
    return assemble_vertices(
        _customers(spark, folder), edges_beyond(spark, folder), key="id", defaults=defaults
    )


def edge_labels(spark, folder):
    vertices = _customers(spark, folder)
    edges = edges_beyond(spark, folder).select(F.col("dst").alias("id"), "src")
    return label_by_key(edges, vertices)


def received(spark, folder):
    vertices = nation_readings(spark, folder).groupBy("station").agg(F.avg("pm25").alias("avg_pm25"))
    out = propagate(vertices, nation_connections(spark, folder))
    return _rounded(out.orderBy(F.desc("received"), "station"), "received")


def customer_ranks(spark, folder):
    ranks = pagerank(customer_vertices(spark, folder), customer_edges(spark, folder))
    return _rounded(ranks.orderBy(F.desc("rank"), "station"), "rank")


def hub_ranks(spark, folder):
    """The same ranks with every customer of more than five links as a hub."""
    ranks = pagerank(customer_vertices(spark, folder), customer_edges(spark, folder), hot_degree=5)
    return _rounded(ranks.orderBy(F.desc("rank"), "station"), "rank")


def chain_ranks(spark, folder):
    ranks = pagerank(customer_vertices(spark, folder), customer_chain(spark, folder))
    return _rounded(ranks.orderBy(F.desc("rank"), "station"), "rank")


QUERIES = {
    "graph_vertices": lambda s, d: _rounded(_vertices(s, d), "avg_pm25"),
    "graph_edges": lambda s, d: station_edges(_vertices(s, d), nation_connections(s, d)),
    "graph_assembly": graph_assembly,
    "edge_labels": edge_labels,
    "propagate": received,
    "pagerank": customer_ranks,
    "pagerank_hubs": hub_ranks,
    "pagerank_chain": chain_ranks,
}

_CUSTOMERS = "known AS (SELECT c_custkey AS id, c_name AS station, c_acctbal AS avg_pm25 FROM customer)"

ORACLE = {
    "graph_vertices": f"""WITH {NATION_READINGS}
        SELECT id, station, round(avg_pm25, 6) AS avg_pm25 FROM vertices""",
    "graph_edges": f"""WITH {NATION_READINGS}, {NATION_CONNECTIONS}
        SELECT s.id AS src_id, d.id AS dst_id, src, dst, CAST(1.0 AS DOUBLE) AS weight
        FROM connections JOIN vertices s ON src = s.station JOIN vertices d ON dst = d.station""",
    "graph_assembly": f"""WITH {EDGES_BEYOND}, {_CUSTOMERS}
        SELECT * FROM known UNION ALL
        SELECT end_id AS id, 'Unknown' AS station, 0.0 AS avg_pm25
        FROM (SELECT src AS end_id FROM beyond UNION SELECT dst FROM beyond)
        WHERE end_id NOT IN (SELECT id FROM known)""",
    "edge_labels": f"""WITH {EDGES_BEYOND}, {_CUSTOMERS}
        SELECT dst AS id, src, coalesce(station, 'Unknown') AS station
        FROM beyond LEFT JOIN known ON dst = known.id""",
    "propagate": f"""WITH {NATION_READINGS}, {NATION_CONNECTIONS}
        SELECT dst AS station, round(sum(avg_pm25 * 0.1), 6) AS received
        FROM connections JOIN vertices ON src = station GROUP BY dst""",
    "pagerank": f"""WITH RECURSIVE {CUSTOMER_EDGES.strip()},
        degrees AS (SELECT src, count(*) AS degree FROM edges GROUP BY src),
        links AS (SELECT edges.src, dst, 1.0::DOUBLE / degree AS weight FROM edges JOIN degrees USING (src)),
        rounds(node, delta, n) AS (
          SELECT c_custkey, 0.15::DOUBLE, 0 FROM customer
          UNION ALL
          SELECT dst, 0.85::DOUBLE * sum(delta * weight), n + 1
          FROM rounds JOIN links ON node = src WHERE delta > 0.0001 GROUP BY dst, n + 1),
        sums AS (SELECT node, sum(delta) AS raw FROM rounds GROUP BY node)
        SELECT node AS station, round(raw * (SELECT count(*) / sum(raw) FROM sums), 6) AS rank FROM sums""",
    # Closed form: customer k hears from its min(k, 45) nearest predecessors, because
    # 0.15 * 0.85^45 is the first change that does not exceed the tolerance.
    "pagerank_chain": """WITH ranked AS (
          SELECT c_custkey AS station, 1.0::DOUBLE - power(0.85::DOUBLE, least(c_custkey, 45) + 1) AS raw
          FROM customer)
        SELECT station, round(raw * (SELECT count(*) / sum(raw) FROM ranked), 6) AS rank FROM ranked""",
}
ORACLE["pagerank_hubs"] = ORACLE["pagerank"]
