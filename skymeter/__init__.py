"""Station-readings analytics as DataFrame-in / DataFrame-out Spark operators.

* ``sources``   – CSV readings, test tables, small literal tables
* ``functions`` – column expressions (number parsing, calendar, hashing)
* ``operators`` – cleaning, features, statistics, composite index, enrichment,
  station graph, regression
* ``streaming`` – threshold alerts on Structured Streaming
* ``plans``     – the end-to-end report and the registered queries with their SQL
"""

__version__ = "0.1.0"
