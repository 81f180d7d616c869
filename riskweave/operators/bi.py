"""The eight certified BI reports over the pair table and the wire/MFA table.

Report orderings are kept; reports that cut with LIMIT get deterministic
tie-breaks so the top-k set is stable (Spark plans ORDER BY + LIMIT as a
TakeOrderedAndProject: per-partition top-k, then a k-row merge).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave import config as C
from riskweave.functions import features as fx


def _pct(num: Column, den: Column, digits: int = 2) -> Column:
    return F.round(num.cast("double") * 100.0 / F.nullif(den, F.lit(0)).cast("double"), digits)


def _count_when(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


def bi_false_positive_rate(risk: DataFrame) -> DataFrame:
    """Q1: share of flagged rows that are not labelled fraud, per hour."""
    flagged = fx.is_flagged_action()
    fp = flagged & (F.col("is_flagged") == F.lit(False))
    tp = flagged & (F.col("is_flagged") == F.lit(True))
    return risk.filter(flagged).groupBy(F.date_trunc("hour", "tx_timestamp").alias("hour")).agg(
        F.count("*").alias("total_flagged"),
        _count_when(fp).alias("false_positives"),
        _count_when(tp).alias("true_positives"),
        _pct(_count_when(fp), _count_when(flagged)).alias("false_positive_rate_pct"),
    ).orderBy(F.desc("hour"))


def bi_account_takeover(risk: DataFrame) -> DataFrame:
    """Q2: distinct users per day and distinct users with MFA change + city mismatch.

    Two exact distinct counts are computed by first reducing to one row per
    (day, user) with a map-side-combined max of the takeover flag, then
    counting per day: a heavy user costs one row per day, not one per pair.
    """
    ato = (F.col("mfa_change_flag") == F.lit(True)) & (F.col("geo_mismatch") == F.lit(True))
    per_user = risk.groupBy(F.date_trunc("day", "tx_timestamp").alias("day"), "user_id") \
                   .agg(F.max(F.coalesce(ato, F.lit(False))).alias("ato"))
    # NULL users form their own group above and are not counted below, as in
    # COUNT(DISTINCT user_id); days with only NULL users still appear.
    counts = per_user.groupBy("day").agg(
        F.count("user_id").alias("total_users"),
        F.count_if(F.col("ato") & F.col("user_id").isNotNull()).alias("ato_suspected_users"))
    return counts.withColumn("ato_rate_pct", _pct(F.col("ato_suspected_users"), F.col("total_users"))) \
                 .orderBy(F.desc("day"))


def bi_wire_after_mfa(wires: DataFrame) -> DataFrame:
    """Q3: the wire-after-MFA table with minutes between the two events."""
    return wires.select(
        "transaction_id", "user_id", "wire_timestamp", "amount", "merchant_name", "wire_city",
        "wire_country", "mfa_change_timestamp", "new_mfa_method", "mfa_change_city",
        "mfa_change_country",
        F.round(F.col("seconds_between") / 60.0, 1).alias("minutes_between_events"),
    ).orderBy(F.desc("wire_timestamp"))





def bi_risk_distribution(risk: DataFrame) -> DataFrame:
    """Q4: count, amount and score statistics per (level, action)."""
    rank = F.when(F.col("risk_level") == "critical", 1).when(F.col("risk_level") == "high", 2) \
            .when(F.col("risk_level") == "medium", 3).otherwise(4)
    return risk.groupBy("risk_level", "automated_action").agg(
        F.count("*").alias("transaction_count"),
        F.round(F.sum("amount"), 2).alias("total_amount"),
        F.round(F.avg("risk_score"), 1).alias("avg_risk_score"),
        F.round(F.avg("amount"), 2).alias("avg_transaction_amount"),
        F.min("tx_timestamp").alias("earliest"),
        F.max("tx_timestamp").alias("latest"),
    ).orderBy(rank, "automated_action")


def bi_top_risky_users(risk: DataFrame, n: int = C.TOP_USERS_N,
                       min_avg: float = C.TOP_USERS_MIN_AVG_SCORE) -> DataFrame:
    """Q5: top-n users by average score among users averaging above ``min_avg``."""
    per_user = risk.groupBy("user_id").agg(
        F.count("*").alias("total_transactions"),
        F.round(F.sum("amount"), 2).alias("total_amount"),
        F.round(F.avg("risk_score"), 1).alias("avg_risk_score"),
        F.max("risk_score").alias("max_risk_score"),
        _count_when(F.col("geo_mismatch")).alias("geo_mismatches"),
        _count_when(F.col("mfa_change_flag")).alias("mfa_changes"),
        _count_when(F.col("is_bot_typing")).alias("bot_typing_events"),
        _count_when(F.col("automated_action") == "BLOCK").alias("blocked_count"),
        F.avg("risk_score").alias("__avg"),
    )
    return per_user.filter(F.col("__avg") > min_avg).drop("__avg") \
                   .orderBy(F.desc("avg_risk_score"), F.asc_nulls_last("user_id")).limit(n)


def bi_bot_detection(risk: DataFrame) -> DataFrame:
    """Q6: bot-typing share and average typing speeds per day."""
    bot = F.col("is_bot_typing")
    return risk.filter(F.col("typing_speed_ms").isNotNull()).groupBy(
        F.date_trunc("day", "tx_timestamp").alias("day")
    ).agg(
        F.count("*").alias("total_transactions"),
        _count_when(bot).alias("bot_detected_count"),
        F.round(F.avg(F.when(bot, F.col("typing_speed_ms"))), 1).alias("avg_bot_typing_ms"),
        F.round(F.avg(F.when(~bot, F.col("typing_speed_ms"))), 1).alias("avg_human_typing_ms"),
        F.round(_count_when(bot).cast("double") * 100.0 / F.count("*").cast("double"), 2).alias("bot_rate_pct"),
    ).orderBy(F.desc("day"))


_CROSS_COLS = ["transaction_id", "user_id", "login_timestamp", "login_device", "login_city",
               "tx_timestamp", "tx_channel", "tx_city", "amount", "transaction_type",
               "risk_score", "automated_action"]


def bi_cross_channel(risk: DataFrame, n: int = C.CROSS_CHANNEL_N,
                     min_amount: float = C.CROSS_CHANNEL_MIN_AMOUNT) -> DataFrame:
    """Q7: login device differs from transaction channel, large amount, top-n by score.

    Faithful to the report: channel and device vocabularies never overlap, so
    the inequality holds for every matched row (see ``bi_cross_channel_family``).
    """
    return risk.filter(F.col("login_device").isNotNull()
                       & (F.col("tx_channel") != F.col("login_device"))
                       & (F.col("amount") > min_amount)) \
               .select(*_CROSS_COLS, "login_id") \
               .orderBy(F.desc("risk_score"), "transaction_id", "login_id").limit(n).drop("login_id")


def channel_family(c: Column) -> Column:
    """mobile / web / other families shared by channels and devices."""
    return (F.when(c.isin("mobile_app", "mobile_ios", "mobile_android", "tablet"), "mobile")
             .when(c.isin("web", "desktop_chrome", "desktop_firefox"), "web")
             .otherwise("other"))


def bi_cross_channel_family(risk: DataFrame, n: int = C.CROSS_CHANNEL_N,
                            min_amount: float = C.CROSS_CHANNEL_MIN_AMOUNT) -> DataFrame:
    """Q7 with normalised families: mobile login then web transaction (or vice versa)."""
    tf, lf = channel_family(F.col("tx_channel")), channel_family(F.col("login_device"))
    return risk.filter(F.col("login_device").isNotNull() & (tf != lf) & (tf != "other")
                       & (lf != "other") & (F.col("amount") > min_amount)) \
               .select(*_CROSS_COLS, tf.alias("tx_family"), lf.alias("login_family"), "login_id") \
               .orderBy(F.desc("risk_score"), "transaction_id", "login_id").limit(n).drop("login_id")


def bi_impossible_travel(risk: DataFrame, n: int = C.TRAVEL_N) -> DataFrame:
    """Q8: city and country differ and the transaction follows the login; top-n by score."""
    secs = F.unix_micros("tx_timestamp") - F.unix_micros("login_timestamp")
    return risk.filter((F.col("geo_mismatch") == F.lit(True))
                       & (F.col("login_country") != F.col("tx_country"))
                       & (F.col("tx_timestamp") > F.col("login_timestamp"))) \
               .select("user_id", "login_city", "login_country", "tx_city", "tx_country",
                       "login_timestamp", "tx_timestamp",
                       F.round(secs / F.lit(60_000_000.0), 1).alias("minutes_between"),
                       "amount", "risk_score", "automated_action", "transaction_id", "login_id") \
               .orderBy(F.desc("risk_score"), "transaction_id", "login_id").limit(n) \
               .drop("transaction_id", "login_id")
