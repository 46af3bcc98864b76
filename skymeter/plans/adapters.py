"""Readings and graphs derived from the driver tables, each in Spark and in SQL.

The tables hold no dirt, so the event readings get some by rules on the event's
number: missing markers, empty text, a marker glued to a number, NaN, missing
years, exact copies. Every rule covers the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skymeter.operators.cleaning import clean_readings
from skymeter.operators.features import temporal_features
from skymeter.session import materialize
from skymeter.sources import load_table

RAW_COLUMNS = (
    "event_id", "station", "site", "year", "month", "day", "hour", "pm25_raw", "pm10_raw"
)


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    """``events`` as dirty readings: measures and time parts are text."""
    return (
        load_table(spark, folder, "events")
        .selectExpr(
            "event_id",
            "event_type AS station",
            "'S' || string(user_id) AS site",
            "if(event_id % 23 <> 0, string(year(ts)), NULL) AS year",
            "string(month(ts)) AS month",
            "string(day(ts)) AS day",
            "string(hour(ts)) AS hour",
            """CASE WHEN event_id % 17 = 0 THEN 'NA' WHEN event_id % 19 = 0 THEN ''
                    WHEN event_id % 37 = 0 THEN string(value) || 'NA'
                    WHEN event_id % 41 = 0 THEN 'NaN' ELSE string(value) END AS pm25_raw""",
            """CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 31 = 0 THEN 'NA'
                    ELSE string(round(value * (int(get_json_object(props, '$.k')) + 1), 2)) END AS pm10_raw""",
            "explode(if(event_id % 10 = 0, array(1, 2), array(1))) AS copy",
        )
        .drop("copy")
    )


RAW_EVENTS = """
base AS (
  SELECT event_id, event_type AS station, 'S' || CAST(user_id AS VARCHAR) AS site,
         CASE WHEN event_id % 23 <> 0 THEN CAST(year(ts) AS VARCHAR) END AS year,
         CAST(month(ts) AS VARCHAR) AS month, CAST(day(ts) AS VARCHAR) AS day,
         CAST(hour(ts) AS VARCHAR) AS hour,
         CASE WHEN event_id % 17 = 0 THEN 'NA' WHEN event_id % 19 = 0 THEN ''
              WHEN event_id % 37 = 0 THEN CAST(value AS VARCHAR) || 'NA'
              WHEN event_id % 41 = 0 THEN 'NaN' ELSE CAST(value AS VARCHAR) END AS pm25_raw,
         CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 31 = 0 THEN 'NA'
              ELSE CAST(round(value * (CAST(json_extract_string(props, '$.k') AS INTEGER) + 1), 2) AS VARCHAR)
         END AS pm10_raw
  FROM events),
raw AS (SELECT * FROM base UNION ALL SELECT * FROM base WHERE event_id % 10 = 0)"""


def clean_events(spark: SparkSession, folder: str) -> DataFrame:
    return clean_readings(raw_events(spark, folder))


def _clean_sql(source: str, columns: str) -> str:
    return f"""
typed AS (
  SELECT DISTINCT {columns}, TRY_CAST(year AS INTEGER) AS year, TRY_CAST(month AS INTEGER) AS month,
         TRY_CAST(day AS INTEGER) AS day, TRY_CAST(hour AS INTEGER) AS hour, pm25_raw
  FROM {source}),
parsed AS (SELECT *, TRY_CAST(replace(pm25_raw, 'NA', '') AS DOUBLE) AS pm25_clean FROM typed),
clean AS (
  SELECT * FROM parsed
  WHERE year IS NOT NULL AND month IS NOT NULL AND day IS NOT NULL AND hour IS NOT NULL
    AND pm25_clean IS NOT NULL AND NOT isnan(pm25_clean))"""


def _features_sql(columns: str) -> str:
    return f"""
timed AS (
  SELECT {columns}, pm25_raw, pm25_clean AS pm25, year, month, day, hour,
         TRY_CAST(printf('%04d-%02d-%02d %02d:00:00', year, month, day, hour) AS TIMESTAMP) AS datetime
  FROM clean),
features AS (
  SELECT *,
         CASE WHEN month IN (12, 1, 2) THEN 'winter' WHEN month IN (3, 4, 5) THEN 'spring'
              WHEN month IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season,
         CASE WHEN dayofweek(datetime) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
         CASE WHEN hour BETWEEN 0 AND 5 THEN 'night' WHEN hour BETWEEN 6 AND 11 THEN 'morning'
              WHEN hour BETWEEN 12 AND 17 THEN 'afternoon' ELSE 'evening' END AS hour_category
  FROM timed)"""


CLEAN_EVENTS = f"{RAW_EVENTS},{_clean_sql('raw', 'event_id, station, site, pm10_raw')}"


def event_features(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned events with temporal features; ``pm10`` stays text, as the index reads it."""
    return temporal_features(clean_events(spark, folder), {"pm25_clean": "pm25", "pm10_raw": "pm10"})


def stored_event_features(spark: SparkSession, folder: str) -> DataFrame:
    """The same, cleaned once and stored: for queries that pass over the features repeatedly."""
    return materialize(event_features(spark, folder), "event-features")


EVENT_FEATURES = f"{CLEAN_EVENTS},{_features_sql('event_id, station, site, pm10_raw AS pm10')}"


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    """``orders`` as readings of several years, some with the impossible date 30 February."""
    return load_table(spark, folder, "orders").selectExpr(
        "o_orderkey",
        "o_orderpriority AS station",
        "string(year(o_orderdate)) AS year",
        "if(o_orderkey % 97 = 0, '2', string(month(o_orderdate))) AS month",
        "if(o_orderkey % 97 = 0, '30', string(day(o_orderdate))) AS day",
        "string(o_orderkey % 24) AS hour",
        "if(o_orderkey % 13 = 0, 'NA', string(o_totalprice)) AS pm25_raw",
    )


RAW_ORDERS = """
raw_orders AS (
  SELECT o_orderkey, o_orderpriority AS station, CAST(year(o_orderdate) AS VARCHAR) AS year,
         CASE WHEN o_orderkey % 97 = 0 THEN '2' ELSE CAST(month(o_orderdate) AS VARCHAR) END AS month,
         CASE WHEN o_orderkey % 97 = 0 THEN '30' ELSE CAST(day(o_orderdate) AS VARCHAR) END AS day,
         CAST(o_orderkey % 24 AS VARCHAR) AS hour,
         CASE WHEN o_orderkey % 13 = 0 THEN 'NA' ELSE CAST(o_totalprice AS VARCHAR) END AS pm25_raw
  FROM orders)"""


def order_features(spark: SparkSession, folder: str) -> DataFrame:
    return temporal_features(clean_readings(raw_orders(spark, folder)))


def stored_order_features(spark: SparkSession, folder: str) -> DataFrame:
    return materialize(order_features(spark, folder), "order-features")


_CLEAN_ORDERS = f"{RAW_ORDERS},{_clean_sql('raw_orders', 'o_orderkey, station')}"
ORDER_FEATURES = f"{_CLEAN_ORDERS},{_features_sql('o_orderkey, station')}"


LINE_MEASURES = ("quantity", "price", "discount", "tax")


def line_readings(spark: SparkSession, folder: str) -> DataFrame:
    """``lineitem`` as readings with four clean measures."""
    return load_table(spark, folder, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey AS station",
        "l_shipdate AS datetime",
        "l_quantity AS quantity",
        "l_extendedprice AS price",
        "l_discount AS discount",
        "l_tax AS tax",
    )


LINE_READINGS = """
readings AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS station, l_shipdate AS datetime,
         l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount, l_tax AS tax
  FROM lineitem)"""


def customer_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``customer`` as line readings with a decimal comma, some missing, NaN or without key."""
    return load_table(spark, folder, "customer").selectExpr(
        "c_custkey",
        "if(c_custkey % 43 <> 0, 'N' || string(c_nationkey), NULL) AS station",
        "if(c_custkey % 47 <> 0, c_mktsegment, NULL) AS line",
        """CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 53 = 0 THEN 'NaN'
                WHEN c_custkey % 59 = 0 THEN '1,2,3'
                ELSE replace(string(c_acctbal), '.', ',') END AS pollution_raw""",
    )


CUSTOMER_LINES = """
line_rows AS (
  SELECT c_custkey,
         CASE WHEN c_custkey % 43 <> 0 THEN 'N' || CAST(c_nationkey AS VARCHAR) END AS station,
         CASE WHEN c_custkey % 47 <> 0 THEN c_mktsegment END AS line,
         CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 53 = 0 THEN 'NaN'
              WHEN c_custkey % 59 = 0 THEN '1,2,3'
              ELSE replace(CAST(c_acctbal AS VARCHAR), '.', ',') END AS pollution_raw
  FROM customer),
lines AS (SELECT *, TRY_CAST(replace(pollution_raw, ',', '.') AS DOUBLE) AS pollution FROM line_rows)"""


def nation_readings(spark: SparkSession, folder: str) -> DataFrame:
    """A reading per customer at the station named after the customer's nation."""
    nation = load_table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("station"))
    customer = load_table(spark, folder, "customer").select("c_nationkey", F.col("c_acctbal").alias("pm25"))
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("station", "pm25")


NATION_READINGS = """
nation_readings AS (
  SELECT n_name AS station, c_acctbal AS pm25 FROM customer JOIN nation ON c_nationkey = n_nationkey),
vertices AS (
  SELECT CAST(row_number() OVER (ORDER BY station) - 1 AS BIGINT) AS id, station, avg_pm25
  FROM (SELECT station, avg(pm25) AS avg_pm25 FROM nation_readings GROUP BY station))"""


def nation_connections(spark: SparkSession, folder: str) -> DataFrame:
    """``src`` nation supplied a line to a customer in ``dst`` nation.

    Pairs of nations combine before they move; names are joined last, on at most one row
    per pair.
    """
    line = load_table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey")
    orders = load_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customer = load_table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    supplier = load_table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    keys = (
        line.join(supplier, line["l_suppkey"] == supplier["s_suppkey"])
        .join(orders, line["l_orderkey"] == orders["o_orderkey"])
        .join(customer, orders["o_custkey"] == customer["c_custkey"])
        .select("s_nationkey", "c_nationkey")
        .distinct()
    )
    names = load_table(spark, folder, "nation")
    source = names.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("src"))
    target = names.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("dst"))
    return keys.join(source, "s_nationkey").join(target, "c_nationkey").select("src", "dst")


NATION_CONNECTIONS = """
connections AS (
  SELECT DISTINCT s.n_name AS src, d.n_name AS dst
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN supplier ON l_suppkey = s_suppkey JOIN nation s ON s_nationkey = s.n_nationkey
       JOIN nation d ON c_nationkey = d.n_nationkey)"""


def customer_vertices(spark: SparkSession, folder: str) -> DataFrame:
    return load_table(spark, folder, "customer").select(F.col("c_custkey").alias("station"))


def customer_edges(spark: SparkSession, folder: str) -> DataFrame:
    """An edge from each order's customer to one picked by the order's number."""
    count = load_table(spark, folder, "customer").agg(F.count(F.lit(1))).scalar()
    orders = load_table(spark, folder, "orders")
    picked = (F.col("o_orderkey") * 7919 + 13) % count
    return orders.select(F.col("o_custkey").alias("src"), picked.alias("dst")).distinct()


CUSTOMER_EDGES = """
edges AS (
  SELECT DISTINCT o_custkey AS src, (o_orderkey * 7919 + 13) % (SELECT count(*) FROM customer) AS dst
  FROM orders)"""


def edges_beyond(spark: SparkSession, folder: str) -> DataFrame:
    """The customer edges, every seventh end shifted past the last customer."""
    last = load_table(spark, folder, "customer").agg(F.max("c_custkey")).scalar()
    shifted = F.when(F.col("dst") % 7 == 0, F.col("dst") + last + 1).otherwise(F.col("dst"))
    return customer_edges(spark, folder).select("src", shifted.alias("dst"))


EDGES_BEYOND = f"""{CUSTOMER_EDGES},
beyond AS (
  SELECT src, CASE WHEN dst % 7 = 0 THEN dst + (SELECT max(c_custkey) FROM customer) + 1 ELSE dst END AS dst
  FROM edges)"""


def customer_chain(spark: SparkSession, folder: str) -> DataFrame:
    """An edge from each customer to the one with the next number."""
    key = F.col("station")
    last = customer_vertices(spark, folder).agg(F.max("station")).scalar()
    return customer_vertices(spark, folder).filter(key < last).select(key.alias("src"), (key + 1).alias("dst"))
