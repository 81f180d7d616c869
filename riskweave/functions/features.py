"""Column expressions for masks, buckets and risk flags.

All are built-in Catalyst expressions, so they fuse into whole-stage code
generation with the surrounding scan / project.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave import config as C


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """Timestamp from a timestamp or text column; bad text gives NULL (ANSI-safe)."""
    if dtype is None or isinstance(dtype, T.StringType):
        return F.try_to_timestamp(_c(c).cast("string"))
    return _c(c).cast("timestamp")


def mask_card(c: Column | str) -> Column:
    """Fixed prefix plus the last four characters."""
    return F.concat(F.lit(C.CARD_MASK_PREFIX), F.right(_c(c), F.lit(4)))


def mask_ip(c: Column | str) -> Column:
    """First two dotted parts plus a fixed suffix (short inputs keep what they have)."""
    return F.concat(F.substring_index(_c(c), ".", 2), F.lit(C.IP_MASK_SUFFIX))


def hash_ip(c: Column | str) -> Column:
    return F.sha2(_c(c), 256)


def amount_bucket(c: Column | str = "amount") -> Column:
    col = _c(c)
    out = None
    for bound, name in C.AMOUNT_BUCKETS:
        out = F.when(col < bound, name) if out is None else out.when(col < bound, name)
    return out.otherwise(C.AMOUNT_BUCKET_TOP)


def hour_of_day(c: Column | str) -> Column:
    return F.hour(_c(c)).cast("int")


def day_of_week(c: Column | str) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(_c(c)).cast("int")


def is_high_risk_merchant(c: Column | str = "merchant_category") -> Column:
    return _c(c).isin(*C.HIGH_RISK_CATEGORIES)


def is_off_hours(hour: Column | str = "hour_of_day") -> Column:
    h = _c(hour)
    return (h < C.OFF_HOURS_BEFORE) | (h > C.OFF_HOURS_AFTER)


def is_bot_typing(c: Column | str = "typing_speed_ms") -> Column:
    return _c(c) < C.BOT_TYPING_MS


def is_rapid_fail(c: Column | str = "failed_attempts_before_success") -> Column:
    return _c(c) >= C.RAPID_FAIL_ATTEMPTS


def geo_mismatch(tx_city: Column | str = "tx_city", login_city: Column | str = "login_city") -> Column:
    """City differs; NULL when there is no login (three-valued)."""
    return _c(tx_city) != _c(login_city)


def mfa_then_wire(mfa: Column | str = "mfa_change_flag", tx_type: Column | str = "transaction_type") -> Column:
    return (_c(mfa) == F.lit(True)) & (_c(tx_type) == C.WIRE_TYPE)


def _is_true(c: Column) -> Column:
    return c == F.lit(True)


def gold_risk_score(weights: dict | None = None) -> Column:
    """Additive, uncapped pipeline score over the gold columns; NULL flags count 0."""
    w = dict(C.GOLD_WEIGHTS, **(weights or {}))
    terms = [
        (F.col("amount") > C.HIGH_AMOUNT, w["high_amount"]),
        (_is_true(F.col("is_high_risk_merchant")), w["high_risk_merchant"]),
        (_is_true(F.col("geo_mismatch")), w["geo_mismatch"]),
        (_is_true(F.col("mfa_then_wire")), w["mfa_then_wire"]),
        (_is_true(F.col("is_bot_typing")), w["bot_typing"]),
        (_is_true(F.col("is_rapid_fail")), w["rapid_fail"]),
        (_is_true(F.col("is_off_hours")), w["off_hours"]),
        (_is_true(F.col("is_flagged")), w["is_flagged"]),
    ]
    return reduce(lambda a, b: a + b, [F.when(cond, F.lit(pts)).otherwise(F.lit(0)) for cond, pts in terms])


def _ladder(score: Column, thresholds, bottom: str) -> Column:
    out = None
    for bound, name in thresholds:
        out = F.when(score >= bound, name) if out is None else out.when(score >= bound, name)
    return out.otherwise(bottom)


def risk_level(score: Column | str = "risk_score", upper: bool = False) -> Column:
    lvl = _ladder(_c(score), C.LEVEL_THRESHOLDS, C.LEVEL_BOTTOM)
    return F.upper(lvl) if upper else lvl


def automated_action(score: Column | str = "risk_score") -> Column:
    return _ladder(_c(score), C.ACTION_THRESHOLDS, C.ACTION_BOTTOM)


def is_flagged_action(c: Column | str = "automated_action") -> Column:
    return _c(c).isin(*C.FLAGGED_ACTIONS)


def haversine_miles(lat1: Column | str, lon1: Column | str, lat2: Column | str, lon2: Column | str) -> Column:
    """Great-circle distance in miles."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dphi = p2 - p1
    dlmb = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2 * C.EARTH_RADIUS_MILES) * F.asin(F.sqrt(a))


def seconds_between(later: Column | str, earlier: Column | str) -> Column:
    """Whole-second difference of two timestamps (unix seconds, floor)."""
    return F.unix_timestamp(_c(later)) - F.unix_timestamp(_c(earlier))


def exact_seconds_between(later: Column | str, earlier: Column | str) -> Column:
    """Fractional seconds between two timestamps (microsecond precision)."""
    return (F.unix_micros(_c(later).cast("timestamp")) - F.unix_micros(_c(earlier).cast("timestamp"))) / F.lit(1e6)
