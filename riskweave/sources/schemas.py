"""Typed schemas of the bronze inputs and of the serving tables."""

from __future__ import annotations

from pyspark.sql import types as T

TRANSACTIONS = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("card_number", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("merchant_name", T.StringType()),
    T.StructField("merchant_category", T.StringType()),
    T.StructField("transaction_type", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("is_international", T.BooleanType()),
    T.StructField("is_flagged", T.BooleanType()),
])

LOGIN_LOGS = T.StructType([
    T.StructField("login_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("ip_address", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("user_agent", T.StringType()),
    T.StructField("login_successful", T.BooleanType()),
    T.StructField("failed_attempts_before_success", T.IntegerType()),
    T.StructField("mfa_change_flag", T.BooleanType()),
    T.StructField("mfa_method", T.StringType()),
    T.StructField("typing_speed_ms", T.DoubleType()),
    T.StructField("session_duration_min", T.DoubleType()),
    T.StructField("is_suspicious", T.BooleanType()),
])

FRAUD_SIGNATURES = T.StructType([
    T.StructField("signature_id", T.StringType()),
    T.StructField("pattern_name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("detection_rule", T.StringType()),
    T.StructField("false_positive_rate", T.DoubleType()),
    T.StructField("created_date", T.StringType()),
    T.StructField("last_triggered", T.StringType()),
    T.StructField("trigger_count_30d", T.IntegerType()),
    T.StructField("embedding_text", T.StringType()),
])

DECISIONS = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("analyst_id", T.StringType()),
    T.StructField("decision", T.StringType()),
    T.StructField("notes", T.StringType()),
    T.StructField("decided_at", T.TimestampType()),
])

# Review-queue table (one row per transaction_id).
TRIAGE = T.StructType([
    T.StructField("transaction_id", T.StringType(), False),
    T.StructField("user_id", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("transaction_type", T.StringType()),
    T.StructField("merchant_name", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("risk_score", T.IntegerType()),
    T.StructField("risk_level", T.StringType()),
    T.StructField("automated_action", T.StringType()),
    T.StructField("triggered_factors", T.StringType()),
    T.StructField("explanation", T.StringType()),
    T.StructField("tx_city", T.StringType()),
    T.StructField("tx_country", T.StringType()),
    T.StructField("login_city", T.StringType()),
    T.StructField("login_country", T.StringType()),
    T.StructField("geo_mismatch", T.BooleanType()),
    T.StructField("mfa_changed", T.BooleanType()),
    T.StructField("bot_detected", T.BooleanType()),
    T.StructField("analyst_id", T.StringType()),
    T.StructField("analyst_decision", T.StringType()),
    T.StructField("analyst_notes", T.StringType()),
    T.StructField("reviewed_at", T.TimestampType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
    T.StructField("expires_at", T.TimestampType()),
])

TRIAGE_COLUMNS = [f.name for f in TRIAGE.fields]
