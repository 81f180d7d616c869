"""Plain-language assessments built as column expressions.

Every text form of the scorer family is a ``concat``/``array_join`` over the
fired-factor arrays of ``scorer.score_frame``: header lines, a numbered list,
an analysis branch, fixed compliance lines and an analysed-at stamp (``now``
is a parameter, rendered in the session time zone, pinned to UTC).

``explain_with`` is the one Python step: a caller-supplied generator (e.g. a
language-model client) runs per Arrow batch in ``mapInPandas``; any failure
falls back to the deterministic text computed on the JVM side.
"""

from __future__ import annotations

from typing import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave import config as C
from riskweave.functions import features as fx
from riskweave.functions.text import Spliced, json_string_list, lines, numbered, or_else, render
from riskweave.operators.scorer import COND, SCORER_FACTORS, Factor, Rec, score_frame

# ---------------------------------------------------------------------------
# Alternative text sets (rule name, template) and fixed lines.
# ---------------------------------------------------------------------------

# Explanation job (eight rules; '?' for a missing place).
EXPLAIN_RULES = [
    ("high_amount", "Transaction amount (${amount:,.2f}) exceeds the $10,000 high-value threshold"),
    ("high_risk_merchant", "Merchant category '{merchant_category}' is classified as high-risk"),
    ("geo_mismatch", "Transaction location ({tx_city}, {tx_country}) differs from login location ({login_city}, {login_country})"),
    ("mfa_change_then_wire", "MFA settings were modified prior to initiating a wire transfer - common account takeover pattern"),
    ("bot_typing_detected", "Typing cadence ({typing_speed_ms:.0f}ms avg) suggests automated/bot input rather than human interaction"),
    ("rapid_login_failures", "{failed_attempts} failed login attempts detected before successful authentication"),
    ("off_hours_activity", "Transaction occurred during off-hours (hour {hour_of_day}), outside normal banking patterns"),
    ("international_wire", "International wire transfer to {tx_country} flagged for enhanced due diligence"),
]

# Notebook explanation step over queue rows (five rules; category read from merchant_name).
TRIAGE_RULES = [
    ("high_amount", "Transaction amount (${amount:,.2f}) exceeds the $10,000 high-value threshold"),
    ("high_risk_merchant", "Merchant category '{merchant_name}' is classified as high-risk"),
    ("geo_mismatch", "Transaction in ({tx_city}, {tx_country}) differs from login ({login_city}, {login_country})"),
    ("mfa_change_then_wire", "MFA settings were modified prior to initiating a wire transfer - common account takeover pattern"),
    ("bot_typing_detected", "Typing cadence suggests automated/bot input rather than human interaction"),
]

# Notebook copy of the scorer (nine rules, shorter texts).
NOTEBOOK_MODEL_RULES = [
    ("high_amount", "Transaction amount (${amount:.2f}) exceeds the $10,000 high-value threshold"),
    ("high_risk_merchant", "Merchant category '{merchant_category}' is classified as high-risk"),
    ("geo_mismatch", "Transaction location ({tx_city}, {tx_country}) differs from login location ({login_city}, {login_country})"),
    ("mfa_change_then_wire", "MFA settings were modified prior to initiating a wire transfer"),
    ("bot_typing_detected", "Typing cadence ({typing_speed_ms:.0f}ms avg) suggests automated/bot input"),
    ("rapid_login_failures", "{failed_attempts_before_success} failed login attempts before authentication"),
    ("off_hours_activity", "Transaction at hour {hour_of_day}, outside normal banking hours"),
    ("international_wire", "International wire transfer to {tx_country}"),
    ("impossible_travel", "Impossible travel: {distance_miles:.0f} miles in {time_diff_minutes:.0f} minutes"),
]

# Rule labels and details of the model-backed scorer ("label: detail (weight: n)").
DETAIL_RULES = [
    ("high_amount", "High-value transaction", "Amount ${amount:,.2f} exceeds $10,000 threshold"),
    ("high_risk_merchant", "High-risk merchant category", "Category: {merchant_category}"),
    ("geo_mismatch", "Geographic mismatch", "Transaction in {tx_city}, {tx_country} but login from {login_city}, {login_country}"),
    ("mfa_change_then_wire", "MFA change before wire transfer", "MFA settings modified prior to wire transfer initiation"),
    ("bot_typing_detected", "Bot-like typing pattern", "Typing speed: {typing_speed_ms:.0f}ms avg (human baseline >80ms)"),
    ("rapid_login_failures", "Multiple failed login attempts", "{failed_attempts_before_success} failed attempts before success"),
    ("off_hours_activity", "Off-hours activity", "Transaction at hour {hour_of_day} (outside 06:00-22:00)"),
    ("international_wire", "International wire transfer", "Wire to {tx_country}"),
    ("impossible_travel", "Impossible travel", "{distance_miles:.0f} miles in {time_diff_minutes:.0f} minutes"),
]

COMPLIANCE_LONG = [
    "This assessment was generated by an automated fraud detection system.",
    "Under GDPR Article 22 and CCPA Section 1798.185, the customer has the",
    "right to request human review of this automated decision.",
]
COMPLIANCE_SHORT = "Under GDPR Art. 22 / CCPA Sec. 1798.185, the customer may request human review."
COMPLIANCE_FALLBACK = "Under GDPR Art. 22 / CCPA Sec. 1798.185, you may request human review."
FALLBACK_NOTE = "NOTE: LLM-generated explanation unavailable; showing rule-based summary."

ANALYSIS_ATO = ["  CRITICAL: Geographic anomaly combined with MFA modification",
                "  strongly suggests an Account Takeover (ATO) attack."]
ANALYSIS_BOT = ["  WARNING: Automated input patterns detected. This may indicate",
                "  credential stuffing or bot-driven fraud using stolen credentials."]
ANALYSIS_DEFAULT = ["  Multiple low-to-medium risk indicators combined to exceed",
                    "  the flagging threshold. Individual factors may be benign but",
                    "  the combination warrants review."]
ACTIONS_BLOCK = ["  1. Verify customer identity via out-of-band contact",
                 "  2. Freeze account pending investigation",
                 "  3. File SAR if confirmed fraudulent"]
ACTIONS_OTHER = ["  1. Review transaction details and customer history",
                 "  2. Contact customer if patterns persist",
                 "  3. Release if verified legitimate"]

_PLACE_DEFAULTS = {"tx_city": "?", "tx_country": "?", "login_city": "?", "login_country": "?"}


def _explain_conditions() -> dict:
    """The explanation job's rules on real columns (booleans, counts)."""
    def flag(n):
        return lambda r: F.coalesce(r.get(n, False), F.lit(False))
    return {
        "high_amount": COND["high_amount"],
        "high_risk_merchant": COND["high_risk_merchant"],
        "geo_mismatch": flag("geo_mismatch"),
        "mfa_change_then_wire": lambda r: flag("mfa_change_flag")(r) & (r.get("transaction_type", "") == C.WIRE_TYPE),
        "bot_typing_detected": lambda r: r.get("typing_speed_ms", None) < C.BOT_TYPING_MS,
        "rapid_login_failures": lambda r: r.get("failed_attempts", None) >= C.RAPID_FAIL_ATTEMPTS,
        "off_hours_activity": lambda r: fx.is_off_hours(r.get("hour_of_day", None)),
        "international_wire": lambda r: flag("is_international")(r) & (r.get("transaction_type", "") == C.WIRE_TYPE),
    }


def _triage_conditions() -> dict:
    def flag(n):
        return lambda r: F.coalesce(r.get(n, False), F.lit(False))
    return {
        "high_amount": COND["high_amount"],
        "high_risk_merchant": lambda r: fx.is_high_risk_merchant(r.get("merchant_name", "")),
        "geo_mismatch": flag("geo_mismatch"),
        "mfa_change_then_wire": lambda r: flag("mfa_changed")(r) & (r.get("transaction_type", "") == C.WIRE_TYPE),
        "bot_typing_detected": flag("bot_detected"),
    }


def _weights() -> dict[str, int]:
    return {f.name: f.weight for f in SCORER_FACTORS}


EXPLAIN_FACTORS = [Factor(n, 0, _explain_conditions()[n], t, _PLACE_DEFAULTS) for n, t in EXPLAIN_RULES]
TRIAGE_FACTORS = [Factor(n, 0, _triage_conditions()[n], t, _PLACE_DEFAULTS) for n, t in TRIAGE_RULES]
NOTEBOOK_MODEL_FACTORS = [Factor(n, _weights()[n], COND[n], t) for n, t in NOTEBOOK_MODEL_RULES]


def _now_col(now) -> Column:
    if now is None:
        return F.current_timestamp()
    return now if isinstance(now, Column) else F.lit(now).cast("timestamp")


def analyzed_at(now=None) -> Column:
    return F.concat(F.lit("Analyzed at: "), F.date_format(_now_col(now), "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC"))


def iso_now(now=None) -> Column:
    """``datetime.isoformat()`` text: microseconds only when non-zero."""
    n = _now_col(now)
    return F.when(F.unix_micros(n) % 1_000_000 == 0, F.date_format(n, "yyyy-MM-dd'T'HH:mm:ss")) \
            .otherwise(F.date_format(n, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def _field(dtypes: dict, name: str, default: str) -> Column:
    if name not in dtypes:
        return F.lit(default)
    return F.coalesce(F.col(name).cast("string"), F.lit("None"))


def _amount_text(dtypes: dict) -> Column:
    if "amount" not in dtypes:
        return F.lit("0.00")
    return F.coalesce(render("{amount:,.2f}", dtypes), F.lit("None"))


def _header(dtypes: dict, width: int, with_type: bool = True) -> list:
    user = F.concat(F.lit("User: "), _field(dtypes, "user_id", "N/A"))
    if with_type:
        user = F.concat(user, F.lit(" | Type: "), _field(dtypes, "transaction_type", "N/A"))
    return [F.concat(F.lit("FRAUD RISK ASSESSMENT - "), _field(dtypes, "transaction_id", "N/A")),
            "=" * width, F.concat(user, F.lit(" | Amount: $"), _amount_text(dtypes))]


def _score_line(prefix: str, level: bool = True) -> Column:
    parts = [F.lit(prefix), F.col("risk_score").cast("string"), F.lit("/100")]
    if level:
        parts += [F.lit(" | Level: "), F.col("risk_level")]
    parts += [F.lit(" | Action: "), F.col("automated_action")]
    return F.concat(*parts)


def _count_line(prefix: str, arr: str = "factor_names") -> Column:
    return F.concat(F.lit(prefix + " ("), F.size(arr).cast("string"), F.lit("):"))


# ---------------------------------------------------------------------------
# Text forms
# ---------------------------------------------------------------------------

def factor_text(df: DataFrame) -> DataFrame:
    """Nine-factor score plus the fired factors' texts as one newline-joined column."""
    s = score_frame(df)
    return s.withColumn("factor_text", F.array_join("factor_texts", "\n"))


def assessment(df: DataFrame, now=None) -> DataFrame:
    """Scorer form: header, score line, numbered factor texts, compliance note."""
    s = score_frame(df)
    d = {f.name: f.dataType for f in s.schema.fields}
    text = lines(*_header(d, 50), _score_line("Risk Score: "), "",
                 _count_line("RISK FACTORS DETECTED"),
                 or_else(numbered(F.col("factor_texts")), "  No significant risk factors detected."),
                 "", "REGULATORY COMPLIANCE NOTE:", *COMPLIANCE_LONG, "", analyzed_at(now))
    return s.withColumn("explanation", text)


def assessment_notebook_model(df: DataFrame) -> DataFrame:
    """Short form of the notebook's scorer copy."""
    s = score_frame(df, NOTEBOOK_MODEL_FACTORS)
    d = {f.name: f.dataType for f in s.schema.fields}
    text = lines(*_header(d, 50, with_type=False), _score_line("Score: "), "",
                 _count_line("RISK FACTORS"),
                 or_else(numbered(F.col("factor_texts")), "  No significant risk factors."),
                 "", COMPLIANCE_SHORT)
    return s.withColumn("explanation", text)


def assessment_triage(triage: DataFrame, now=None) -> DataFrame:
    """Short form over queue rows (five rules; score and action from the row)."""
    s = score_frame(triage, TRIAGE_FACTORS, prefix="__n_")
    s = s.withColumns({"factor_names": F.col("__n_factor_names"), "factor_texts": F.col("__n_factor_texts")})
    s = s.drop(*[c for c in s.columns if c.startswith("__n_")])
    d = {f.name: f.dataType for f in s.schema.fields}
    text = lines(*_header(d, 55), _score_line("Risk Score: ", level=False), "",
                 _count_line("RISK FACTORS DETECTED"),
                 or_else(numbered(F.col("factor_texts")), "  Flagged by aggregate scoring."),
                 "", "REGULATORY COMPLIANCE:", COMPLIANCE_SHORT, "", analyzed_at(now))
    return s.withColumns({"explanation": text, "triggered_factors": json_string_list(F.col("factor_names"))})


def explanation_input(records: DataFrame) -> DataFrame:
    """Flagged pairs in the explanation job's layout: real booleans and counts,
    places blank-filled, international = countries differ (NULL-safe)."""
    r = records
    return r.filter(fx.is_flagged_action()).select(
        "transaction_id", "user_id", F.col("amount").cast("double").alias("amount"), "transaction_type",
        "merchant_category", "tx_channel", F.col("risk_score").cast("int").alias("risk_score"), "risk_level",
        "automated_action", "tx_city", "tx_country",
        F.coalesce("login_city", F.lit("")).alias("login_city"),
        F.coalesce("login_country", F.lit("")).alias("login_country"),
        F.coalesce("geo_mismatch", F.lit(False)).alias("geo_mismatch"),
        F.coalesce("mfa_change_flag", F.lit(False)).alias("mfa_change_flag"),
        F.coalesce("is_bot_typing", F.lit(False)).alias("bot_typing"),
        "typing_speed_ms",
        F.coalesce("failed_attempts_before_success", F.lit(0)).alias("failed_attempts"),
        "hour_of_day",
        F.coalesce("is_off_hours", F.lit(False)).alias("is_off_hours"),
        F.coalesce("mfa_then_wire", F.lit(False)).alias("mfa_then_wire"),
        F.coalesce("is_high_risk_merchant", F.lit(False)).alias("is_high_risk_merchant"),
        (F.col("tx_country") != F.coalesce(F.col("login_country"), F.col("tx_country"))).alias("is_international"),
    )


def assessment_long(expl_input: DataFrame, now=None) -> DataFrame:
    """Explanation-job form: factors, analysis branch, recommended actions."""
    s = score_frame(expl_input, EXPLAIN_FACTORS, prefix="__n_")
    s = s.withColumns({"factor_names": F.col("__n_factor_names"), "factor_texts": F.col("__n_factor_texts"),
                       "risk_level": F.upper("risk_level")})
    s = s.drop(*[c for c in s.columns if c.startswith("__n_")])
    d = {f.name: f.dataType for f in s.schema.fields}
    names = F.col("factor_names")
    has = lambda n: F.array_contains(names, n)
    place = lambda c: F.coalesce(F.col(c), F.lit("?")) if c in d else F.lit("?")
    ato = F.array(*[F.lit(x) for x in ANALYSIS_ATO],
                  F.concat(F.lit("  The user appears to have logged in from "), place("login_city")),
                  F.concat(F.lit("  but initiated a wire transfer from "), place("tx_city"), F.lit(".")))
    value = F.array(F.concat(F.lit("  High-value transaction ($"), _amount_text(d), F.lit(") through a high-risk")),
                    F.lit("  merchant channel requires enhanced scrutiny per BSA/AML policy."))
    analysis = (F.when(has("geo_mismatch") & has("mfa_change_then_wire"), ato)
                 .when(has("bot_typing_detected"), F.array(*[F.lit(x) for x in ANALYSIS_BOT]))
                 .when(has("high_amount") & has("high_risk_merchant"), value)
                 .otherwise(F.array(*[F.lit(x) for x in ANALYSIS_DEFAULT])))
    actions = F.when(F.col("automated_action") == "BLOCK", F.array(*[F.lit(x) for x in ACTIONS_BLOCK])) \
               .otherwise(F.array(*[F.lit(x) for x in ACTIONS_OTHER]))
    text = lines(*_header(d, 55), _score_line("Risk Score: "), "", _count_line("RISK FACTORS DETECTED"),
                 or_else(numbered(F.col("factor_texts")),
                         "  No specific risk factors matched - flagged by aggregate scoring."),
                 "", "ANALYSIS:", Spliced(analysis), "", "RECOMMENDED ACTIONS:", Spliced(actions),
                 "", "REGULATORY COMPLIANCE:", *COMPLIANCE_LONG, "", analyzed_at(now))
    return s.withColumns({"explanation": text, "triggered_factors": json_string_list(names)})


def factor_details(df: DataFrame) -> DataFrame:
    """``label: detail (weight: n)`` per fired factor (label alone if a detail
    field is missing), on top of the nine-factor score."""
    s = score_frame(df)
    r = Rec(s)
    weights = _weights()
    defaults = dict(_PLACE_DEFAULTS, merchant_category="unknown")
    items = []
    for name, label, detail in DETAIL_RULES:
        f = next(x for x in SCORER_FACTORS if x.name == name)
        text = render(detail, r.dtypes, defaults)
        det = F.lit(label) if text is None else F.coalesce(text, F.lit(label))
        items.append(F.when(f.fires(r), F.concat(F.lit(f"{label}: "), det, F.lit(f" (weight: {weights[name]})"))))
    return s.withColumn("factor_details", F.array_compact(F.array(*items)))


def prompt_text(df: DataFrame) -> DataFrame:
    """The user message a language model receives for one record."""
    s = factor_details(df)
    d = {f.name: f.dataType for f in s.schema.fields}

    def v(name, default):
        return _field(d, name, default) if not isinstance(d.get(name), T.BooleanType) else \
            F.when(F.col(name).isNull(), F.lit("None")).when(F.col(name), F.lit("True")).otherwise(F.lit("False"))

    rows = [
        "Transaction to analyze:",
        F.concat(F.lit("- Transaction ID: "), v("transaction_id", "N/A")),
        F.concat(F.lit("- User ID: "), v("user_id", "N/A")),
        F.concat(F.lit("- Amount: $"), _amount_text(d)),
        F.concat(F.lit("- Type: "), v("transaction_type", "N/A")),
        F.concat(F.lit("- Merchant Category: "), v("merchant_category", "N/A")),
        F.concat(F.lit("- Transaction Location: "), v("tx_city", "N/A"), F.lit(", "), v("tx_country", "N/A")),
        F.concat(F.lit("- Login Location: "), v("login_city", "N/A"), F.lit(", "), v("login_country", "N/A")),
        F.concat(F.lit("- MFA Changed: "), v("mfa_change_flag", "False")),
        F.concat(F.lit("- Typing Speed: "), v("typing_speed_ms", "N/A"), F.lit("ms")),
        F.concat(F.lit("- Failed Login Attempts: "), v("failed_attempts_before_success", "0")),
        F.concat(F.lit("- Hour of Day: "), v("hour_of_day", "N/A")),
        F.concat(F.lit("- International: "), v("is_international", "False")),
        "", "Rule Engine Results:",
        F.concat(F.lit("- Risk Score: "), F.col("risk_score").cast("string"), F.lit("/100")),
        F.concat(F.lit("- Risk Level: "), F.col("risk_level")),
        F.concat(F.lit("- Automated Action: "), F.col("automated_action")),
        F.concat(F.lit("- Triggered Factors ("), F.size("factor_names").cast("string"), F.lit("):")),
        or_else(F.transform("factor_details", lambda x: F.concat(F.lit("  - "), x)), "  (none)"),
    ]
    return s.withColumn("prompt_text", F.concat(lines(*rows), F.lit("\n")))


def _fallback_col(scored: DataFrame) -> Column:
    d = {f.name: f.dataType for f in scored.schema.fields}
    return lines(*_header(d, 50, with_type=False), _score_line("Score: "), "", "RISK FACTORS:",
                 or_else(numbered(F.col("factor_details")), "  No risk factors detected."),
                 "", FALLBACK_NOTE, COMPLIANCE_FALLBACK)


def assessment_fallback(df: DataFrame) -> DataFrame:
    """Deterministic text used when no model answer is available."""
    s = factor_details(df)
    return s.withColumn("explanation", _fallback_col(s))


def score_transactions(df: DataFrame, now=None) -> DataFrame:
    """Scorer output table: id, score, level, action, factor list (JSON), text, time."""
    a = assessment(df, now)
    keys = ["transaction_id"] + (["login_id"] if "login_id" in df.columns else [])
    return a.select(*keys, "risk_score", "risk_level", "automated_action",
                    json_string_list(F.col("factor_names")).alias("triggered_factors"),
                    "explanation", iso_now(now).alias("analyzed_at"))


def explain_with(df: DataFrame, generator: Callable[[pd.DataFrame], pd.Series] | None = None,
                 key: str = "transaction_id") -> DataFrame:
    """Narratives from a caller-supplied generator, one Arrow batch at a time.

    ``generator`` receives a pandas frame with ``key``, ``prompt_text`` and the
    score columns and returns one text per row.  A failing batch (or rows it
    leaves empty) keeps the deterministic fallback text, and ``fallback_reason``
    says why (``no generator``, ``empty text`` or the error; null where the
    generator's text was taken), so a generator that always fails shows in a
    count.  The network client, if any, lives in the generator; nothing is
    collected to the driver.
    """
    p = prompt_text(df)
    base = p.withColumn("explanation", _fallback_col(p))
    cols = [key, "prompt_text", "risk_score", "risk_level", "automated_action", "explanation"]
    slim = base.select(*cols)

    def run(batches):
        for pdf in batches:
            out = pdf[cols].copy()
            out["fallback_reason"] = "no generator"
            if generator is not None:
                try:
                    gen = pd.Series(generator(pdf), index=pdf.index)
                    ok = gen.notna() & (gen.astype(str).str.len() > 0)
                    out.loc[ok, "explanation"] = gen[ok].astype(str)
                    out["fallback_reason"] = ok.map({True: None, False: "empty text"})
                except Exception as e:  # noqa: BLE001 - any failure keeps the fallback
                    out["fallback_reason"] = f"{type(e).__name__}: {e}"[:200]
            yield out

    return slim.mapInPandas(run, schema=T.StructType([*slim.schema.fields, T.StructField("fallback_reason", T.StringType())]))
