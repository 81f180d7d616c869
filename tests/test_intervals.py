"""Interval joins: inclusive ends, fan-out, bucketed == plain == brute force."""
import datetime as dt
import random

import pytest

from riskweave.operators.intervals import interval_join, interval_micros

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def _frames(spark, txs, logins):
    tx = spark.createDataFrame(txs, "tid string, user_id string, tts timestamp")
    lg = spark.createDataFrame(logins, "lid string, user_id string, lts timestamp")
    return tx, lg


def _pairs(df):
    return sorted((r.tid, r.lid or "") for r in df.collect())


def test_interval_micros():
    assert interval_micros("1 hour") == 3_600_000_000
    assert interval_micros("24 hours") == 86_400_000_000
    assert interval_micros("-30 minutes") == -1_800_000_000


def test_inclusive_window_ends(spark):
    s = dt.timedelta(seconds=1)
    h = dt.timedelta(hours=1)
    txs = [("a", "u", T0 - s), ("b", "u", T0), ("c", "u", T0 + h), ("d", "u", T0 + h + s)]
    tx, lg = _frames(spark, txs, [("L", "u", T0)])
    for strategy in ("plain", "bucketed"):
        out = interval_join(tx, lg, "user_id", "tts", "lts", upper="1 hour", how="left", strategy=strategy)
        assert _pairs(out) == [("a", ""), ("b", "L"), ("c", "L"), ("d", "")]
        inner = interval_join(tx, lg, "user_id", "tts", "lts", upper="1 hour", how="inner", strategy=strategy)
        assert _pairs(inner) == [("b", "L"), ("c", "L")]


def test_fan_out_two_logins(spark):
    tx, lg = _frames(spark, [("t", "u", T0 + dt.timedelta(minutes=20))],
                     [("L1", "u", T0), ("L2", "u", T0 + dt.timedelta(minutes=10))])
    out = interval_join(tx, lg, "user_id", "tts", "lts", upper="1 hour", how="left")
    assert _pairs(out) == [("t", "L1"), ("t", "L2")]


def test_bucketed_equals_plain_and_brute_force_on_hot_user(spark):
    rnd = random.Random(7)
    txs, logins = [], []
    for i in range(600):
        user = "hot" if rnd.random() < 0.34 else f"u{rnd.randrange(20)}"
        txs.append((f"t{i}", user, T0 + dt.timedelta(seconds=rnd.randrange(0, 3 * 86400))))
    for i in range(300):
        user = "hot" if rnd.random() < 0.34 else f"u{rnd.randrange(20)}"
        logins.append((f"l{i}", user, T0 + dt.timedelta(seconds=rnd.randrange(-3600, 3 * 86400))))
    txs.append(("tnull", None, T0))
    tx, lg = _frames(spark, txs, logins)
    expect = []
    for tid, tu, tts in txs:
        hits = [lid for lid, lu, lts in logins if lu == tu and tu is not None and lts <= tts <= lts + dt.timedelta(hours=1)]
        expect += [(tid, h) for h in hits] or [(tid, None)]
    expect = sorted((t, l or "") for t, l in expect)
    for strategy in ("plain", "bucketed"):
        got = interval_join(tx, lg, "user_id", "tts", "lts", upper="1 hour", how="left", strategy=strategy)
        assert _pairs(got) == expect


def test_custom_bucket_width_same_rows(spark):
    rnd = random.Random(3)
    txs = [(f"t{i}", "u", T0 + dt.timedelta(seconds=rnd.randrange(0, 86400))) for i in range(200)]
    logins = [(f"l{i}", "u", T0 + dt.timedelta(seconds=rnd.randrange(0, 86400))) for i in range(100)]
    tx, lg = _frames(spark, txs, logins)
    a = interval_join(tx, lg, "user_id", "tts", "lts", upper="1 hour", how="inner", strategy="plain")
    b = interval_join(tx, lg, "user_id", "tts", "lts", upper="1 hour", how="inner", bucket="10 minutes")
    c = interval_join(tx, lg, "user_id", "tts", "lts", upper="1 hour", how="inner", bucket="6 hours")
    assert _pairs(a) == _pairs(b) == _pairs(c)


@pytest.mark.parametrize("bucket", ["1 second", "0 seconds", "-1 hours"])
def test_too_narrow_bucket_is_an_error(spark, bucket):
    tx = spark.createDataFrame([], "user_id string, tts timestamp")
    lg = spark.createDataFrame([], "user_id string, lts timestamp")
    with pytest.raises(ValueError, match="too narrow"):
        interval_join(tx, lg, "user_id", "tts", "lts", upper="24 hours", bucket=bucket)


def test_bucketed_plan_has_bucket_equi_key(spark):
    tx, lg = _frames(spark, [("t", "u", T0)], [("L", "u", T0)])
    out = interval_join(tx, lg, "user_id", "tts", "lts", upper="1 hour", how="left")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "__lb" in plan and "__rb" in plan
