"""Per-key time series without one task per key.

Rows of a key are cut into time chunks and the window key is (key, chunk), so
a key that holds a large share of all rows is spread over its chunks.

* ``trailing``  – aggregates over the rows of the last ``window`` (both ends
  inclusive).  A row that the next chunk's first rows can still see is copied
  there (the halo); copies are seen, never reported.
* ``with_previous`` – the row before, however long ago: ``lag`` inside a chunk,
  and for a chunk's first row the last row of the key's chunk before, carried
  over from a table with one row per (key, chunk).

Rows without a key or a time take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.operators.intervals import floor_div, interval_micros, micros

CHUNK = "1 day"


def trailing(df: DataFrame, key: str, ts: str, window: str, aggregates: dict[str, Column],
             chunk: str = CHUNK) -> DataFrame:
    """``df`` with each aggregate taken over the key's rows in ``[ts - window, ts]``."""
    width, span = interval_micros(chunk), interval_micros(window)
    if not 0 < span <= width:
        raise ValueError(f"window {window!r} must be positive and no longer than chunk {chunk!r}")
    d = df.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    d = d.withColumn("__us", micros(ts)).withColumn("__own", floor_div("__us", width))
    seen_next = F.col("__us") >= (F.col("__own") + 1) * width - span
    chunks = F.when(seen_next, F.array(F.col("__own"), F.col("__own") + 1)).otherwise(F.array(F.col("__own")))
    d = d.withColumn("__chunk", F.explode(chunks))
    w = Window.partitionBy(key, "__chunk").orderBy("__us").rangeBetween(-span, 0)
    d = d.withColumns({name: agg.over(w) for name, agg in aggregates.items()})
    return d.where("__chunk = __own").drop("__us", "__own", "__chunk")


def with_previous(df: DataFrame, key: str, ts: str, tie: str, columns: list[str], chunk: str = CHUNK,
                  name: str = "previous") -> DataFrame:
    """``df`` with a struct of ``columns`` of the key's row before in the order
    of ``ts`` and ``tie`` (null for a key's first row)."""
    d = df.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    d = d.withColumn("__us", micros(ts)).withColumn("__chunk", floor_div("__us", interval_micros(chunk)))
    own = F.struct(*columns)
    last = d.groupBy(key, "__chunk").agg(F.max_by(own, F.struct("__us", tie)).alias("__tail"))
    carried = last.select(key, "__chunk", F.lag("__tail").over(Window.partitionBy(key).orderBy("__chunk")).alias("__carried"))
    before = F.lag(own).over(Window.partitionBy(key, "__chunk").orderBy("__us", tie))
    return (d.withColumn("__before", before).join(carried, [key, "__chunk"], "left")
            .withColumn(name, F.coalesce("__before", "__carried")).drop("__us", "__chunk", "__before", "__carried"))
