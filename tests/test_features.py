"""Column functions on literal rows, NULLs and threshold edges."""
from pyspark.sql import functions as F

from riskweave.functions import features as fx


def _one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_mask_ip(spark):
    out = _one(spark, [("1.2.3.4",), ("1.2",), ("",), (None,)], "ip string", fx.mask_ip("ip"))
    assert out == ["1.2.xxx.xxx", "1.2.xxx.xxx", ".xxx.xxx", None]


def test_mask_card(spark):
    out = _one(spark, [("4000123456789012",), ("123",), (None,)], "c string", fx.mask_card("c"))
    assert out == ["****-****-****-9012", "****-****-****-123", None]


def test_amount_bucket_edges(spark):
    rows = [(99.99,), (100.0,), (999.99,), (1000.0,), (9999.99,), (10000.0,), (None,)]
    out = _one(spark, rows, "amount double", fx.amount_bucket("amount"))
    assert out == ["low", "medium", "medium", "high", "high", "very_high", "very_high"]


def test_off_hours_edges(spark):
    out = _one(spark, [(5,), (6,), (22,), (23,), (0,)], "h int", fx.is_off_hours("h"))
    assert out == [True, False, False, True, True]


def test_bot_and_rapid_fail(spark):
    assert _one(spark, [(49.9,), (50.0,)], "t double", fx.is_bot_typing("t")) == [True, False]
    assert _one(spark, [(2,), (3,)], "n int", fx.is_rapid_fail("n")) == [False, True]


def test_level_and_action_edges(spark):
    rows = [(19,), (20,), (39,), (40,), (69,), (70,), (150,)]
    lv = _one(spark, rows, "s int", fx.risk_level("s"))
    ac = _one(spark, rows, "s int", fx.automated_action("s"))
    assert lv == ["low", "medium", "medium", "high", "high", "critical", "critical"]
    assert ac == ["ALLOW", "MONITOR", "MONITOR", "YELLOW_FLAG", "YELLOW_FLAG", "BLOCK", "BLOCK"]


def test_gold_score_nulls_count_zero(spark):
    df = spark.createDataFrame(
        [(15000.0, True, None, None, None, None, True, False)],
        "amount double, is_high_risk_merchant boolean, geo_mismatch boolean, mfa_then_wire boolean, "
        "is_bot_typing boolean, is_rapid_fail boolean, is_off_hours boolean, is_flagged boolean")
    assert df.select(fx.gold_risk_score()).first()[0] == 25 + 15 + 5


def test_haversine_known_distance(spark):
    # New York -> London is about 3,460 miles.
    d = spark.range(1).select(fx.haversine_miles(F.lit(40.71), F.lit(-74.01), F.lit(51.51), F.lit(-0.13))).first()[0]
    assert 3440 < d < 3480


def test_day_of_week_sunday_is_one(spark):
    out = _one(spark, [("2024-01-07 10:00:00",)], "t string", fx.day_of_week(F.col("t").cast("timestamp")))
    assert out == [1]
