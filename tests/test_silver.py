"""Silver-layer edge semantics: text timestamps, NULL rules, masks, features."""
import datetime as dt
import os

from pyspark.sql import functions as F

from riskweave.operators import quality, silver, triage as tr
from riskweave.sources import readers, schemas


def _bronze_tx(spark, rows):
    cols = [f.name for f in schemas.TRANSACTIONS.fields]
    full = [tuple(r.get(c) for c in cols) for r in rows]
    schema = schemas.TRANSACTIONS
    return spark.createDataFrame(full, schema)


def test_text_timestamps_bad_values_become_null(spark):
    df = spark.createDataFrame([("t1", "U", "2024-01-05 23:30:00", 10.0), ("t2", "U", "not a time", 10.0)],
                               "transaction_id string, user_id string, timestamp string, amount double")
    df = df.withColumns({c: F.lit(None).cast("string") for c in ("card_number", "merchant_category")})
    out = {r.transaction_id: r for r in silver.silver_transactions(df).collect()}
    assert out["t1"].timestamp == dt.datetime(2024, 1, 5, 23, 30) and out["t1"].hour_of_day == 23
    assert out["t1"].is_off_hours is True and out["t1"].day_of_week == 6
    assert out["t2"].timestamp is None and out["t2"].hour_of_day is None


def test_rules_drop_null_and_non_positive(spark):
    rows = [dict(transaction_id="a", user_id="U", amount=5.0), dict(transaction_id="b", user_id=None, amount=5.0),
            dict(transaction_id="c", user_id="U", amount=None), dict(transaction_id="d", user_id="U", amount=0.0)]
    df = _bronze_tx(spark, rows)
    assert [r.transaction_id for r in silver.silver_transactions(df).collect()] == ["a"]
    rep = {r.rule: (r.passed, r.failed) for r in quality.quality_report(df, quality.TRANSACTION_RULES).collect()}
    assert rep == {"valid_amount": (2, 2), "valid_user": (3, 1)}


def test_silver_drops_raw_pii(spark):
    df = _bronze_tx(spark, [dict(transaction_id="a", user_id="U", amount=5.0, card_number="4000123412341234",
                                 timestamp=dt.datetime(2024, 1, 1))])
    out = silver.silver_transactions(df)
    assert "card_number" not in out.columns and out.first().card_number_masked == "****-****-****-1234"


def test_ordered_extract_limit(spark):
    risk = spark.createDataFrame(
        [(f"t{k}", "U", 1.0, "p2p", "p2p", "web", "X", "US", None, None, None, None, None, None, None, s,
          "high", "YELLOW_FLAG", None) for k, s in enumerate([45, 60, 50, 41])],
        "transaction_id string, user_id string, amount double, transaction_type string, merchant_category string, "
        "tx_channel string, tx_city string, tx_country string, login_city string, login_country string, "
        "geo_mismatch boolean, mfa_then_wire boolean, is_bot_typing boolean, is_off_hours boolean, "
        "mfa_change_flag boolean, risk_score int, risk_level string, automated_action string, tx_timestamp timestamp")
    got = [r.transaction_id for r in tr.to_triage(risk, limit=2).collect()]
    assert got == ["t1", "t2"]


def test_merged_schema_read(spark, tmp_dir):
    p = os.path.join(tmp_dir, "m")
    spark.createDataFrame([(1, "a")], "id int, x string").write.parquet(p + "/v=1")
    spark.createDataFrame([(2, 3.5)], "id int, y double").write.parquet(p + "/v=2")
    df = readers.read_parquet_merged(spark, p)
    assert set(df.columns) >= {"id", "x", "y"} and df.count() == 2
