"""Silver layer: typed, masked, feature-enriched inputs.

Each function is one narrow projection + filter over its input, so it fuses
into the scan stage; the quality filter reaches Parquet as a pushed filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions import features as fx
from riskweave.operators.quality import LOGIN_RULES, TRANSACTION_RULES, expect_or_drop


def drop_pii(df: DataFrame, cols=("card_number", "ip_address")) -> DataFrame:
    return df.drop(*[c for c in cols if c in df.columns])


def silver_transactions(bronze: DataFrame, rules: dict | None = TRANSACTION_RULES) -> DataFrame:
    ts = fx.parse_ts("timestamp", bronze.schema["timestamp"].dataType)
    df = expect_or_drop(bronze, rules or {})
    df = df.withColumns({
        "timestamp": ts,
        "card_number_masked": fx.mask_card("card_number"),
        "amount_bucket": fx.amount_bucket("amount"),
    })
    df = df.withColumns({
        "hour_of_day": fx.hour_of_day("timestamp"),
        "day_of_week": fx.day_of_week("timestamp"),
        "is_high_risk_merchant": fx.is_high_risk_merchant("merchant_category"),
    })
    df = df.withColumn("is_off_hours", fx.is_off_hours("hour_of_day"))
    return drop_pii(df, ("card_number",))


def silver_login_logs(bronze: DataFrame, rules: dict | None = LOGIN_RULES) -> DataFrame:
    ts = fx.parse_ts("timestamp", bronze.schema["timestamp"].dataType)
    df = expect_or_drop(bronze, rules or {})
    df = df.withColumns({
        "timestamp": ts,
        "ip_masked": fx.mask_ip("ip_address"),
        "is_bot_typing": fx.is_bot_typing("typing_speed_ms"),
        "is_rapid_fail": fx.is_rapid_fail("failed_attempts_before_success"),
    })
    df = df.withColumn("hour_of_day", fx.hour_of_day("timestamp"))
    return drop_pii(df, ("ip_address",))


def amount_buckets(silver_tx: DataFrame) -> DataFrame:
    """Count and amount per bucket (a small report on P4)."""
    return silver_tx.groupBy("amount_bucket").agg(
        F.count("*").alias("transaction_count"),
        F.sum("amount").alias("total_amount"))
