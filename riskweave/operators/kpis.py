"""Hourly fraud KPIs over the pair table (low-cardinality grouping keys, so
partial aggregation shrinks each map task's output to a handful of rows)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def kpi_table(risk: DataFrame, hour: Column) -> DataFrame:
    """KPIs per (``hour``, level, action), batch or streaming: ``hour`` is a
    truncated timestamp or the start of an event-time window."""
    flagged = F.col("is_flagged") == F.lit(True)
    fp = (F.col("automated_action") == "BLOCK") & (F.col("is_flagged") == F.lit(False))
    out = risk.groupBy(hour.alias("hour"), "risk_level", "automated_action").agg(
        F.count("*").alias("transaction_count"),
        F.sum("amount").alias("total_amount"),
        F.avg("risk_score").alias("avg_risk_score"),
        F.sum(F.when(flagged, 1).otherwise(0)).cast("long").alias("true_fraud_count"),
        F.sum(F.when(fp, 1).otherwise(0)).cast("long").alias("false_positive_count"),
    )
    return out.withColumn(
        "false_positive_ratio",
        F.when(F.col("transaction_count") > 0,
               F.col("false_positive_count") / F.col("transaction_count")).otherwise(F.lit(0.0)))


def fraud_kpis(risk: DataFrame) -> DataFrame:
    return kpi_table(risk, F.date_trunc("hour", "tx_timestamp"))
