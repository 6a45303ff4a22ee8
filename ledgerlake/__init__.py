"""ledgerlake: a layered (bronze / silver / gold) transaction lakehouse on PySpark.

Every public function maps DataFrames to DataFrames with builtin Spark
expressions; only the publishing, ingestion and model-fitting helpers run
actions.  Sub-packages:

* ``functions`` – column expressions (date / amount / text cleaning, shares)
* ``operators`` – DataFrame operators (dedup, keys, merges, lookups,
  aggregates, rolling features, models)
* ``sources``   – raw file scans, lineage columns, schema evolution, tables
* ``streaming`` – incremental file loads with Structured Streaming
* ``plans``     – the composite jobs (bronze, silver, gold, features, models)
"""

__version__ = "0.1.0"
