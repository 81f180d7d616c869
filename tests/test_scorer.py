"""Nine-factor scorer: golden records and exact texts."""
import datetime as dt

from pyspark.sql import Row

from riskweave.operators import narrative, scorer

NOW = dt.datetime(2024, 1, 31, 0, 0, 0)

SAMPLE = dict(transaction_id="TXN-SAMPLE001", user_id="USR-000001", amount=15000.0,
              transaction_type="wire_transfer", merchant_category="wire", tx_city="Lagos", tx_country="NG",
              login_city="New York", login_country="US", mfa_change_flag=True, typing_speed_ms=35.0,
              failed_attempts_before_success=4, hour_of_day=3, is_international=True)
MANUAL = dict(SAMPLE, transaction_id="TXN-TEST001", user_id="USR-999", amount=25000.0, typing_speed_ms=30.0,
              failed_attempts_before_success=5, hour_of_day=2, distance_miles=5500.0, time_diff_minutes=15.0)


def _df(spark, rec):
    return spark.createDataFrame([Row(**rec)])


def test_sample_record_all_but_travel(spark):
    r = scorer.score_frame(_df(spark, SAMPLE)).first()
    assert r.raw_score == 145 and r.risk_score == 100
    assert (r.risk_level, r.automated_action) == ("CRITICAL", "BLOCK")
    assert "impossible_travel" not in r.factor_names and len(r.factor_names) == 8


def test_manual_record_all_nine(spark):
    r = scorer.score_frame(_df(spark, MANUAL)).first()
    assert r.raw_score == 175 and r.risk_score == 100 and len(r.factor_names) == 9
    assert r.factor_texts[-1] == "Impossible travel detected: 5500 miles between events in 15 minutes"


def test_empty_record_defaults(spark):
    df = spark.createDataFrame([Row(transaction_id="TXN-EMPTY")])
    r = narrative.assessment(df, NOW).first()
    assert (r.risk_score, r.risk_level, r.automated_action) == (0, "LOW", "ALLOW")
    assert "  No significant risk factors detected." in r.explanation


def test_sample_assessment_text(spark):
    r = narrative.assessment(_df(spark, SAMPLE), NOW).first()
    expected = "\n".join([
        "FRAUD RISK ASSESSMENT - TXN-SAMPLE001",
        "=" * 50,
        "User: USR-000001 | Type: wire_transfer | Amount: $15,000.00",
        "Risk Score: 100/100 | Level: CRITICAL | Action: BLOCK",
        "",
        "RISK FACTORS DETECTED (8):",
        "  1. Transaction amount ($15000.00) exceeds the $10,000 high-value threshold",
        "  2. Merchant category 'wire' is classified as high-risk",
        "  3. Transaction location (Lagos, NG) differs from login location (New York, US)",
        "  4. MFA settings were modified prior to initiating a wire transfer - common account takeover pattern",
        "  5. Typing cadence (35ms avg) suggests automated/bot input rather than human interaction",
        "  6. 4 failed login attempts detected before successful authentication",
        "  7. Transaction occurred during off-hours (hour 3), outside normal banking patterns",
        "  8. International wire transfer to NG flagged for enhanced due diligence",
        "",
        "REGULATORY COMPLIANCE NOTE:",
        "This assessment was generated by an automated fraud detection system.",
        "Under GDPR Article 22 and CCPA Section 1798.185, the customer has the",
        "right to request human review of this automated decision.",
        "",
        "Analyzed at: 2024-01-31 00:00:00 UTC",
    ])
    assert r.explanation == expected


def test_threshold_edges(spark):
    rows = [dict(transaction_id="a", amount=10000.0), dict(transaction_id="b", amount=10000.01),
            dict(transaction_id="c", amount=1.0, typing_speed_ms=49.9),
            dict(transaction_id="d", amount=1.0, typing_speed_ms=50.0),
            dict(transaction_id="e", amount=1.0, distance_miles=500.0, time_diff_minutes=10.0),
            dict(transaction_id="f", amount=1.0, distance_miles=501.0, time_diff_minutes=60.0)]
    cols = ["transaction_id", "amount", "typing_speed_ms", "distance_miles", "time_diff_minutes"]
    df = spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows],
                               "transaction_id string, amount double, typing_speed_ms double, "
                               "distance_miles double, time_diff_minutes double")
    got = {r.transaction_id: r.raw_score for r in scorer.score_frame(df).collect()}
    assert got == {"a": 0, "b": 25, "c": 25, "d": 0, "e": 0, "f": 0}


def test_missing_field_keeps_template(spark):
    # geo fires (countries differ) but cities are absent -> raw template text.
    df = spark.createDataFrame([Row(transaction_id="x", tx_country="NG", login_country="US")])
    r = scorer.score_frame(df).first()
    assert r.factor_texts == [scorer.SCORER_RULES[2][2]]


def test_triggered_json_format(spark):
    r = scorer.score_frame(_df(spark, SAMPLE)).select(scorer.triggered_json().alias("j")).first()
    assert r.j.startswith('["high_amount", "high_risk_merchant", ')


def test_fallback_and_prompt(spark):
    df = _df(spark, MANUAL)
    fb = narrative.assessment_fallback(df).first().explanation
    assert fb.splitlines()[2] == "User: USR-999 | Amount: $25,000.00"
    assert "  9. Impossible travel: 5500 miles in 15 minutes (weight: 30)" in fb
    pt = narrative.prompt_text(df).first().prompt_text
    assert "- MFA Changed: True\n" in pt and "- Typing Speed: 30.0ms\n" in pt and pt.endswith("(weight: 30)\n")


def test_explain_with_generator_and_fallback(spark):
    df = spark.createDataFrame([Row(**MANUAL), Row(**dict(MANUAL, transaction_id="TXN-2"))])
    ok = {r.transaction_id: r.explanation for r in
          narrative.explain_with(df, lambda pdf: "LLM: " + pdf["transaction_id"]).collect()}
    assert ok == {"TXN-TEST001": "LLM: TXN-TEST001", "TXN-2": "LLM: TXN-2"}

    def boom(pdf):
        raise RuntimeError("endpoint down")
    fb = narrative.explain_with(df, boom).collect()
    assert all("NOTE: LLM-generated explanation unavailable" in r.explanation for r in fb)
    assert {r.fallback_reason for r in fb} == {"RuntimeError: endpoint down"}
    some = {r.transaction_id: r.fallback_reason for r in
            narrative.explain_with(df, lambda pdf: pdf["transaction_id"].where(pdf["transaction_id"] == "TXN-2")).collect()}
    assert some == {"TXN-TEST001": "empty text", "TXN-2": None}
    assert {r.fallback_reason for r in narrative.explain_with(df).collect()} == {"no generator"}
