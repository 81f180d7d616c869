"""Nine-factor rule scorer as column expressions.

A factor is declared once (name, weight, condition, text); ``score_frame``
turns a list of factors into a single projection: the weighted sum capped at
100, level and action, the ordered list of fired factor names and their texts.
Records are DataFrame rows; a column the input lacks takes the factor's
default (the scorer's ``record.get(key, default)``), and a NULL value never
fires a numeric rule.  No Python runs per row.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave import config as C
from riskweave.functions import features as fx
from riskweave.functions.text import json_string_list, render


class Rec:
    """Column access with the defaults of a record dict."""

    def __init__(self, df: DataFrame):
        self.dtypes = {f.name: f.dataType for f in df.schema.fields}

    def get(self, name: str, default=None) -> Column:
        if name in self.dtypes:
            return F.col(name)
        return F.lit(default)


@dataclass(frozen=True)
class Factor:
    """A rule: fires on ``condition``; its text is ``template`` filled from the
    record (the raw template when a field is missing, as the scorer does)."""
    name: str
    weight: int
    condition: Callable[[Rec], Column]
    template: str
    defaults: dict | None = None

    def fires(self, r: Rec) -> Column:
        return F.coalesce(self.condition(r), F.lit(False))

    def describe(self, r: Rec) -> Column:
        text = render(self.template, r.dtypes, self.defaults)
        return F.lit(self.template) if text is None else F.coalesce(text, F.lit(self.template))


def _geo(r: Rec) -> Column:
    tx = r.get("tx_country", "")
    return tx != F.coalesce(r.get("login_country", None), tx)


def _wire(r: Rec) -> Column:
    return r.get("transaction_type", "") == C.WIRE_TYPE


def _flag(r: Rec, name: str) -> Column:
    return F.coalesce(r.get(name, False), F.lit(False))


# Rule conditions shared by every text set (nulls never fire numeric rules).
COND = {
    "high_amount": lambda r: r.get("amount", 0) > C.HIGH_AMOUNT,
    "high_risk_merchant": lambda r: fx.is_high_risk_merchant(r.get("merchant_category", "")),
    "geo_mismatch": _geo,
    "mfa_change_then_wire": lambda r: _flag(r, "mfa_change_flag") & _wire(r),
    "bot_typing_detected": lambda r: r.get("typing_speed_ms", 999) < C.BOT_TYPING_MS,
    "rapid_login_failures": lambda r: r.get("failed_attempts_before_success", 0) >= C.RAPID_FAIL_ATTEMPTS,
    "off_hours_activity": lambda r: fx.is_off_hours(r.get("hour_of_day", 12)),
    "international_wire": lambda r: _flag(r, "is_international") & _wire(r),
    "impossible_travel": lambda r: (r.get("distance_miles", 0) > C.TRAVEL_MILES)
    & (r.get("time_diff_minutes", 9999) < C.TRAVEL_MINUTES),
}

# ---------------------------------------------------------------------------
# The nine rules of the scorer, in order, with their weights and
# text templates (record fields in braces, Python format specs).
# ---------------------------------------------------------------------------
SCORER_RULES = [
    ("high_amount", 25, "Transaction amount (${amount:.2f}) exceeds the $10,000 high-value threshold"),
    ("high_risk_merchant", 15, "Merchant category '{merchant_category}' is classified as high-risk"),
    ("geo_mismatch", 20, "Transaction location ({tx_city}, {tx_country}) differs from login location ({login_city}, {login_country})"),
    ("mfa_change_then_wire", 30, "MFA settings were modified prior to initiating a wire transfer - common account takeover pattern"),
    ("bot_typing_detected", 25, "Typing cadence ({typing_speed_ms:.0f}ms avg) suggests automated/bot input rather than human interaction"),
    ("rapid_login_failures", 10, "{failed_attempts_before_success} failed login attempts detected before successful authentication"),
    ("off_hours_activity", 5, "Transaction occurred during off-hours (hour {hour_of_day}), outside normal banking patterns"),
    ("international_wire", 15, "International wire transfer to {tx_country} flagged for enhanced due diligence"),
    ("impossible_travel", 30, "Impossible travel detected: {distance_miles:.0f} miles between events in {time_diff_minutes:.0f} minutes"),
]

SCORER_FACTORS: list[Factor] = [Factor(n, w, COND[n], t) for n, w, t in SCORER_RULES]


def score_frame(df: DataFrame, factors: list[Factor] | None = None, cap: int | None = C.SCORE_CAP,
                prefix: str = "") -> DataFrame:
    """Add ``raw_score``, ``risk_score`` (capped), ``risk_level`` (upper case),
    ``automated_action``, ``factor_names`` and ``factor_texts`` (ordered arrays)."""
    factors = SCORER_FACTORS if factors is None else factors
    r = Rec(df)
    fired = [f.fires(r) for f in factors]
    raw = reduce(lambda a, b: a + b, [F.when(c, F.lit(f.weight)).otherwise(F.lit(0))
                                      for c, f in zip(fired, factors)])
    names = F.array_compact(F.array(*[F.when(c, F.lit(f.name)) for c, f in zip(fired, factors)]))
    texts = F.array_compact(F.array(*[F.when(c, f.describe(r)) for c, f in zip(fired, factors)]))
    out = df.withColumns({f"{prefix}raw_score": raw, f"{prefix}factor_names": names,
                          f"{prefix}factor_texts": texts})
    score = F.least(F.col(f"{prefix}raw_score"), F.lit(cap)) if cap is not None else F.col(f"{prefix}raw_score")
    out = out.withColumn(f"{prefix}risk_score", score.cast("int"))
    return out.withColumns({
        f"{prefix}risk_level": fx.risk_level(f"{prefix}risk_score", upper=True),
        f"{prefix}automated_action": fx.automated_action(f"{prefix}risk_score"),
    })


def triggered_json(names: Column | str = "factor_names") -> Column:
    return json_string_list(F.col(names) if isinstance(names, str) else names)


# ---------------------------------------------------------------------------
# Travel between login and transaction, and the pair records the scorer reads
# ---------------------------------------------------------------------------

def with_travel(pairs: DataFrame) -> DataFrame:
    """``distance_miles`` (great circle) and ``time_diff_minutes`` (transaction
    minus login); NULL when the transaction has no login."""
    return pairs.withColumns({
        "distance_miles": fx.haversine_miles("login_latitude", "login_longitude",
                                             "tx_latitude", "tx_longitude"),
        "time_diff_minutes": fx.exact_seconds_between("tx_timestamp", "login_timestamp") / F.lit(60.0),
    })


def scorer_records(tx: DataFrame, logins: DataFrame, strategy: str = "bucketed") -> DataFrame:
    """Gold pairs plus what the nine rules read: coordinates, failed attempts,
    transaction hour and international flag, then travel."""
    from riskweave.operators.gold import session_join
    pairs = session_join(
        tx, logins, strategy=strategy,
        tx_extra={"latitude": "tx_latitude", "longitude": "tx_longitude", "hour_of_day": "hour_of_day",
                  "is_international": "is_international"},
        login_extra={"latitude": "login_latitude", "longitude": "login_longitude",
                     "failed_attempts_before_success": "failed_attempts_before_success"})
    return with_travel(pairs)


def score_pairs(tx: DataFrame, logins: DataFrame, strategy: str = "bucketed") -> DataFrame:
    """Batch scoring job: pairs -> travel -> nine factors (one projection)."""
    return score_frame(scorer_records(tx, logins, strategy))


def impossible_travel(records: DataFrame, miles: float = C.TRAVEL_MILES) -> DataFrame:
    """Pairs more than ``miles`` apart, with the impossible-travel verdict."""
    return records.filter(F.col("distance_miles") > miles).select(
        "transaction_id", "login_id", "user_id", "tx_city", "login_city",
        F.round("distance_miles", 1).alias("distance_miles"),
        F.round("time_diff_minutes", 2).alias("time_diff_minutes"),
        (F.col("time_diff_minutes") < C.TRAVEL_MINUTES).alias("is_impossible"))
