"""Signature catalogue: hits of many patterns as a long table, with severities.

The patterns that one scored pair decides by itself are evaluated together in
one pass (``stack``); the catalogue has several signatures per pattern and is
reduced to one row per pattern before it is joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave import config as C

#: Rows up to which a table is broadcast; beyond, the join shuffles both sides.
BROADCAST_ROWS = 100_000


def row_patterns() -> dict[str, Column]:
    """Pattern name -> condition on one gold pair (``scorer.scorer_records`` with risk)."""
    hour = F.hour("tx_timestamp")
    wire = F.col("transaction_type") == C.WIRE_TYPE
    return {
        "mfa_then_wire": F.col("mfa_then_wire"),
        "midnight_atm": (F.col("transaction_type") == C.ATM_TYPE) & (F.col("tx_country") != C.HOME_COUNTRY)
        & (hour >= C.MIDNIGHT_HOURS[0]) & (hour < C.MIDNIGHT_HOURS[1]),
        "bot_typing": F.col("is_bot_typing"),
        "multiple_failed_mfa": F.col("is_rapid_fail"),
        "cross_channel_rapid": wire & (F.col("tx_channel") == "web") & F.col("login_device").isin(*C.MOBILE_DEVICES)
        & (F.unix_micros("tx_timestamp") - F.unix_micros("login_timestamp") <= 300_000_000),
    }


def pattern_hits(pairs: DataFrame, patterns: dict[str, Column] | None = None) -> DataFrame:
    """One row per pair and pattern that fired: transaction_id, login_id, amount, pattern_name."""
    conditions = patterns if patterns is not None else row_patterns()
    named = {f"__p{n}": c for n, c in enumerate(conditions.values())}
    rows = ", ".join(f"'{name}', __p{n}" for n, name in enumerate(conditions))
    return (pairs.withColumns(named)
            .selectExpr("transaction_id", "login_id", "amount", f"stack({len(conditions)}, {rows}) AS (pattern_name, fired)")
            .where("fired").drop("fired"))


def per_pattern(signatures: DataFrame) -> DataFrame:
    """One row per pattern: its severity (the highest of its signatures, by the
    declared order), number of signatures and mean false-positive rate."""
    rank = F.element_at(F.create_map(*[F.lit(v) for k, s in enumerate(C.SEVERITIES) for v in (s, k)]), F.lower("severity"))
    return (signatures.groupBy("pattern_name")
            .agg(F.max_by("severity", rank).alias("severity"), F.count("*").alias("signatures"),
                 F.avg("false_positive_rate").alias("false_positive_rate")))


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it holds no more than ``rows`` rows (read
    no further than that to find out), else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def with_severity(hits: DataFrame, signatures: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hits with their pattern's severity and rate; a pattern that the catalogue
    does not know keeps nulls."""
    return hits.join(sized(per_pattern(signatures), broadcast_rows), "pattern_name", "left")


def pattern_report(hits: DataFrame) -> DataFrame:
    """Per pattern: hits, transactions, amount of the transactions hit.  Hits are
    first reduced to one row per (pattern, transaction), so a pattern that fires
    on most rows is counted in many tasks."""
    once = hits.groupBy("pattern_name", "transaction_id").agg(
        F.count("*").alias("hits"), F.max("amount").alias("amount"), F.first("severity").alias("severity"))
    return once.groupBy("pattern_name").agg(
        F.first("severity").alias("severity"), F.sum("hits").alias("hits"), F.count("*").alias("transactions"),
        F.round(F.sum("amount"), 2).alias("amount"))
