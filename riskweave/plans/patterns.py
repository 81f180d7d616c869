"""Recurring pattern jobs over growing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskweave.operators.first_seen import first_seen, merged
from riskweave.sources.writers import snapshot_expire, snapshot_update


def sync_first_seen(spark: SparkSession, new: DataFrame, root: str, keys: list[str], ts: str = "timestamp",
                    tie: str = "transaction_id", keep: int | None = 10) -> DataFrame:
    """Add the rows ``new`` (a day's transactions) to the first-seen table under
    ``root`` and return the first rows that this run brought in or replaced.
    Only the new rows and the table are read; a rerun changes nothing."""
    brought = None

    def build(known: DataFrame | None, _: int) -> DataFrame:
        nonlocal brought
        first = first_seen(new, keys, ts, tie)
        if known is None:
            brought = first
        else:
            old = known.select(*keys, known[ts].alias("__ts"), known[tie].alias("__tie"))
            later = f"__ts IS NOT NULL AND (__ts < `{ts}` OR (__ts = `{ts}` AND __tie <= `{tie}`))"
            brought = first.join(old, keys, "left").where(f"NOT ({later})").drop("__ts", "__tie")
        return merged(known, new, keys, ts, tie)

    snapshot_update(spark, root, build)
    if keep:
        snapshot_expire(spark, root, max(2, keep))  # ``brought`` still reads the version before
    return brought
