"""riskweave: fraud-risk analytics as PySpark DataFrame functions.

Every public function maps DataFrames to a DataFrame and stays lazy: nothing
is collected, no Python UDF sits in a hot path, and clocks (``now``) and
thresholds are parameters.  Sub-packages:

* ``sources``   – schemas, CSV/Parquet readers, table writers, test-table mapping
* ``functions`` – column expressions (masks, buckets, flags, haversine, text)
* ``operators`` – quality rules, silver/gold, interval joins, KPIs, BI reports,
                  triage queue, nine-factor scorer, narratives, detection patterns
* ``plans``     – end-to-end batch runs that materialise layers
* ``streaming`` – Structured Streaming forms of ingest, joins, windows, upserts
"""

__version__ = "0.1.0"
