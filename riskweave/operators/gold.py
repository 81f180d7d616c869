"""Gold layer: transaction/login pairs, risk signals and the additive score,
the MFA-change-then-wire join, and per-transaction / per-user reductions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave import config as C
from riskweave.functions import features as fx
from riskweave.operators.intervals import interval_join

# Columns of the pair table, in order: (source side, source column, output name).
_TX_COLS = [
    ("transaction_id", "transaction_id"), ("user_id", "user_id"), ("timestamp", "tx_timestamp"),
    ("amount", "amount"), ("transaction_type", "transaction_type"),
    ("merchant_category", "merchant_category"), ("channel", "tx_channel"), ("city", "tx_city"),
    ("country", "tx_country"), ("is_high_risk_merchant", "is_high_risk_merchant"),
    ("is_off_hours", "is_off_hours"), ("amount_bucket", "amount_bucket"),
]
_LOGIN_COLS = [
    ("login_id", "login_id"), ("timestamp", "login_timestamp"), ("city", "login_city"),
    ("country", "login_country"), ("mfa_change_flag", "mfa_change_flag"),
    ("is_bot_typing", "is_bot_typing"), ("is_rapid_fail", "is_rapid_fail"),
    ("typing_speed_ms", "typing_speed_ms"), ("device_type", "login_device"),
]
PAIR_COLUMNS = [o for _, o in _TX_COLS] + [o for _, o in _LOGIN_COLS] + ["is_flagged"]


def _tx_side(tx: DataFrame, extra: dict[str, str] | None = None) -> DataFrame:
    cols = [F.col(s).alias(o) for s, o in _TX_COLS] + [F.col("is_flagged")]
    cols += [F.col(s).alias(o) for s, o in (extra or {}).items()]
    return tx.select(*cols)


def _login_side(logins: DataFrame, extra: dict[str, str] | None = None) -> DataFrame:
    cols = [F.col("user_id")] + [F.col(s).alias(o) for s, o in _LOGIN_COLS]
    cols += [F.col(s).alias(o) for s, o in (extra or {}).items()]
    return logins.select(*cols)


def session_join(tx: DataFrame, logins: DataFrame, window: str = C.SESSION_WINDOW,
                 strategy: str = "bucketed", tx_extra: dict | None = None,
                 login_extra: dict | None = None) -> DataFrame:
    """Left outer interval join: every silver transaction with each login of the
    same user in ``[login, login + window]``; unmatched transactions keep NULL
    login columns.  Grain: one row per (transaction, matching login)."""
    t = _tx_side(tx, tx_extra)
    lg = _login_side(logins, login_extra)
    out = interval_join(t, lg, "user_id", "tx_timestamp", "login_timestamp",
                        lower="0 seconds", upper=window, how="left", strategy=strategy)
    extra = list((tx_extra or {}).values()) + list((login_extra or {}).values())
    return out.select(*PAIR_COLUMNS, *extra)


def with_risk(pairs: DataFrame, weights: dict | None = None) -> DataFrame:
    """Signals, additive score (uncapped), level (lower case) and action."""
    df = pairs.withColumns({
        "geo_mismatch": fx.geo_mismatch("tx_city", "login_city"),
        "mfa_then_wire": fx.mfa_then_wire("mfa_change_flag", "transaction_type"),
    })
    df = df.withColumn("risk_score", fx.gold_risk_score(weights))
    return df.withColumns({
        "risk_level": fx.risk_level("risk_score"),
        "automated_action": fx.automated_action("risk_score"),
    })


def session_risk(tx: DataFrame, logins: DataFrame, window: str = C.SESSION_WINDOW,
                 strategy: str = "bucketed") -> DataFrame:
    return with_risk(session_join(tx, logins, window, strategy))


def wire_after_mfa(tx: DataFrame, logins: DataFrame, window: str = C.MFA_WIRE_WINDOW,
                   min_amount: float = C.MFA_WIRE_MIN_AMOUNT, strategy: str = "bucketed") -> DataFrame:
    """Wires above ``min_amount`` within ``window`` after an MFA change of the same
    user (inner; one row per MFA change).  Both sides are filtered before the
    shuffle, so only wires and MFA changes move."""
    out = interval_join(wire_side(tx, min_amount), mfa_side(logins), "user_id", "wire_timestamp",
                        "mfa_change_timestamp", lower="0 seconds", upper=window, how="inner", strategy=strategy)
    return wire_pairs(out)


def wire_side(tx: DataFrame, min_amount: float) -> DataFrame:
    return tx.filter((F.col("transaction_type") == C.WIRE_TYPE) & (F.col("amount") > min_amount)).select(
        "transaction_id", "user_id", F.col("timestamp").alias("wire_timestamp"), "amount",
        "merchant_name", F.col("city").alias("wire_city"), F.col("country").alias("wire_country"))


def mfa_side(logins: DataFrame) -> DataFrame:
    return logins.filter(F.col("mfa_change_flag") == F.lit(True)).select(
        "user_id", F.col("login_id").alias("mfa_login_id"),
        F.col("timestamp").alias("mfa_change_timestamp"), F.col("mfa_method").alias("new_mfa_method"),
        F.col("city").alias("mfa_change_city"), F.col("country").alias("mfa_change_country"))


def wire_pairs(joined: DataFrame) -> DataFrame:
    return joined.select(
        "transaction_id", "user_id", "wire_timestamp", "amount", "merchant_name", "wire_city",
        "wire_country", "mfa_change_timestamp", "new_mfa_method", "mfa_change_city",
        "mfa_change_country", "mfa_login_id",
        fx.seconds_between("wire_timestamp", "mfa_change_timestamp").alias("seconds_between"))


def dedupe_per_transaction(risk: DataFrame) -> DataFrame:
    """One row per transaction: highest score, then latest login, then largest
    login id.  ``row_number() == 1`` is planned with a window group limit: each
    map task keeps only its best row per transaction before the shuffle
    (partial top-1) and the final top-1 runs after it, so a transaction with a
    huge fan-out never moves or buffers all of its pairs."""
    w = Window.partitionBy("transaction_id").orderBy(
        F.desc("risk_score"), F.desc_nulls_last("login_timestamp"), F.desc_nulls_last("login_id"))
    return risk.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def latest_session(logins: DataFrame) -> DataFrame:
    """Most recent login per user (the access path of the session table)."""
    cols = [c for c in logins.columns if c != "user_id"]
    best = F.max_by(F.struct(*cols), F.struct("timestamp", "login_id")).alias("__s")
    return logins.groupBy("user_id").agg(best, F.count("*").alias("login_count")).select(
        "user_id", "__s.*", "login_count")


def risk_counts(risk: DataFrame) -> DataFrame:
    """Total and flagged pair counts in one pass."""
    return risk.agg(F.count("*").alias("total_rows"),
                    F.count_if(fx.is_flagged_action()).alias("flagged_rows"))
