"""First occurrences of a key combination, kept as a mergeable table.

The table holds, for each key, the first row by (time, id).  The first row of a
union is the first of the first rows, so a daily run reads only its new rows
and the table: ``merged(known, first_seen(new))``.  Partial minima are taken in
the map tasks; a key that holds most rows costs one row a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_seen(df: DataFrame, keys: list[str], ts: str = "timestamp", tie: str = "transaction_id") -> DataFrame:
    """The first row of each key, all columns kept.  Rows with a null key, time
    or id take no part."""
    rest = [c for c in df.columns if c not in keys]
    known = df.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*keys, ts, tie]))
    best = F.min_by(F.struct(*rest), F.struct(ts, tie)).alias("__first")
    return known.groupBy(*keys).agg(best).select(*[F.col(k) if k in keys else F.col(f"__first.{k}") for k in df.columns])


def merged(known: DataFrame | None, new: DataFrame, keys: list[str], ts: str = "timestamp",
           tie: str = "transaction_id") -> DataFrame:
    """The table after the rows ``new``; late rows earlier than what is known win."""
    first = first_seen(new, keys, ts, tie)
    return first if known is None else first_seen(known.unionByName(first), keys, ts, tie)
