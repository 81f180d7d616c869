"""Serving sinks.

The review queue is kept as versioned Parquet snapshots
(``writers.snapshot_write``).  Where a relational serving store is used,
``write_jdbc`` pushes a prepared frame with Spark's JDBC writer: every task
writes its own partition in batches of ``batch_size`` rows, so nothing passes
through the driver.  Keyed changes are computed in Spark first (``upsert``),
so the store only receives final rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               batch_size: int = 1000, mode: str = "append", num_partitions: int | None = None) -> None:
    w = df.coalesce(num_partitions) if num_partitions else df
    opts = {"url": url, "dbtable": table, "batchsize": str(batch_size)}
    opts.update(properties or {})
    w.write.format("jdbc").options(**opts).mode(mode).save()
