"""Declared patterns against brute force, with hot keys and chunk borders."""
import datetime as dt
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from riskweave.operators import catalogue, chunks, first_seen as fs, patterns as P
from riskweave.plans.patterns import sync_first_seen
from riskweave.plans.registry import inputs_for
from riskweave.sources import fixtures
from riskweave.sources.writers import snapshot_read
from tests.conftest import SF_SMALL

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def secs(t):
    return (t.replace(tzinfo=dt.timezone.utc) - START).total_seconds()


def tx_rows(rng, n, users=5, days=4, hot=0.5):
    """Half of the rows belong to one user; many lie on chunk borders."""
    rows = []
    for k in range(n):
        s = rng.choice([rng.uniform(0, days * 86400), rng.randint(0, days) * 86400, rng.randint(0, days * 24) * 3600])
        user = "hot" if rng.random() < hot else f"u{rng.randint(1, users)}"
        rows.append((f"t{k:04d}", user, at(round(s, 3)), float(rng.choice([0.5, 0.99, 1.0, 5, 20000, 11000]))))
    return rows


SCHEMA = "transaction_id string, user_id string, timestamp timestamp, amount double"


@pytest.mark.parametrize("window,chunk", [("1 hour", "1 day"), ("1 hour", "1 hour"), ("30 minutes", "2 hours")])
def test_trailing_equals_brute_force(spark, window, chunk):
    rows = tx_rows(random.Random(3), 400) + [("n1", None, at(5), 1.0), ("n2", "u1", None, 1.0)]
    got = chunks.trailing(spark.createDataFrame(rows, SCHEMA), "user_id", "timestamp", window,
                          {"n": F.count("*"), "s": F.sum("amount")}, chunk).collect()
    width = {"1 hour": 3600, "30 minutes": 1800}[window]
    want = {}
    for t, u, ts, _ in rows:
        if u and ts:
            seen = [a for _, v, s, a in rows if v == u and s and 0 <= (ts - s).total_seconds() <= width]
            want[t] = (len(seen), round(sum(seen), 6))
    assert {r.transaction_id: (r.n, round(r.s, 6)) for r in got} == want and len(got) == len(want)
    with pytest.raises(ValueError, match="no longer"):
        chunks.trailing(spark.createDataFrame(rows, SCHEMA), "user_id", "timestamp", "2 days", {}, "1 day")


@pytest.mark.parametrize("chunk", ["1 hour", "1 day", "30 days"])
def test_previous_row_across_chunks(spark, chunk):
    rows = tx_rows(random.Random(4), 300) + [("n1", None, at(5), 1.0), ("n2", "u1", None, 1.0)]
    got = chunks.with_previous(spark.createDataFrame(rows, SCHEMA), "user_id", "timestamp", "transaction_id",
                               ["transaction_id", "amount"], chunk).collect()
    ordered = sorted((r for r in rows if r[1] and r[2]), key=lambda r: (r[1], r[2], r[0]))
    want = {b[0]: ((a[0], a[3]) if a[1] == b[1] else None) for a, b in zip(ordered, ordered[1:])} | {ordered[0][0]: None}
    assert {r.transaction_id: tuple(r.previous) if r.previous else None for r in got} == want


def test_window_keys_are_user_and_chunk(spark):
    df = spark.createDataFrame(tx_rows(random.Random(1), 20), SCHEMA)
    for out in (P.velocity_spike(df), P.card_testing(df), P.dormant_reactivation(df.withColumn("transaction_type", F.lit("wire_transfer")))):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(user_id" in plan and "__chunk" in plan.split("Window")[1]
        assert "BroadcastNestedLoop" not in plan and "Cartesian" not in plan


def test_velocity_spike_equals_brute_force(spark):
    rows = tx_rows(random.Random(5), 300)
    got = {r.transaction_id: r.recent_count for r in P.velocity_spike(spark.createDataFrame(rows, SCHEMA), factor=3.0).collect()}
    want = {}
    for t, u, ts, _ in rows:
        mine = [s for _, v, s, _ in rows if v == u]
        n = sum(0 <= (ts - s).total_seconds() <= 3600 for s in mine)
        span = max((max(mine) - min(mine)).total_seconds() / 3600, 1)
        if n >= 3 and n > 3 * len(mine) / span:
            want[t] = n
    assert got == want and len(want) > 3


def test_card_testing_declared_thresholds(spark):
    rows = [("a", "u", at(0), 0.5), ("b", "u", at(300), 0.99), ("c", "u", at(600), 0.01), ("d", "u", at(601), 1.0),
            ("e", "u", at(901), 0.2), ("f", "v", at(300), 0.5)]
    got = {r.transaction_id: (r.recent_count, round(r.recent_amount, 2)) for r in P.card_testing(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {"c": (3, 1.5)}  # e sees b (601 s before) no more, and c


def test_geo_hop_and_reactivation_borders(spark):
    ny, la, near = (40.71, -74.01), (34.05, -118.24), (40.9, -74.2)
    rows = [("a", 86400 - 300, ny), ("b", 86400 + 300, la), ("c", 86400 + 901, ny), ("d", 86400 + 1000, near),
            ("e", 86400 + 1000, la)]
    df = spark.createDataFrame([("u", at(s), e, "x", *p) for e, s, p in rows],
                               "user_id string, timestamp timestamp, event_id string, city string, latitude double, longitude double")
    got = [(r.event_id, r.previous_event_id, r.seconds_between) for r in P.rapid_geo_hop(df).orderBy("event_id").collect()]
    assert got == [("b", "a", 600.0), ("e", "d", 0.0)]  # c comes 601 s after b; d is near c
    day = 86400
    wires = [("a", "u", at(0), 1.0, "wire_transfer"), ("b", "u", at(90 * day), 1.0, "wire_transfer"),
             ("c", "u", at(180 * day + 1), 1.0, "wire_transfer"), ("d", "u", at(300 * day), 1.0, "p2p")]
    df = spark.createDataFrame(wires, SCHEMA + ", transaction_type string")
    assert [(r.transaction_id, r.previous_transaction_id) for r in P.dormant_reactivation(df).collect()] == [("c", "b")]


@pytest.mark.parametrize("minutes,accounts", [(60, 4), (1, 2), (7, 3)])
def test_credential_stuffing_equals_brute_force(spark, minutes, accounts):
    rng = random.Random(minutes)
    rows = [("hot" if k % 2 else f"ip{rng.randint(1, 6)}", f"u{rng.randint(1, 12)}", at(rng.randint(0, 6 * 3600))) for k in range(500)]
    rows += [(None, "u1", at(1)), ("ip1", None, at(1)), ("ip1", "u1", None)] + rows[:20]
    df = spark.createDataFrame(rows, "ip_address string, user_id string, timestamp timestamp").repartition(6)
    got = {(r.address, secs(r.minute) // 60): (r.accounts, r.recent_attempts) for r in
           P.credential_stuffing(df, accounts=accounts, minutes=minutes).collect()}
    full = [(a, u, int(secs(t) // 60)) for a, u, t in rows if a and u and t]
    want = {}
    for a, m in {(a, m) for a, _, m in full}:
        near = [u for b, u, k in full if b == a and m - minutes < k <= m]
        if len(set(near)) >= accounts:
            want[(a, m)] = (len(set(near)), len(near))
    assert got == want and any(a == "hot" for a, _ in want)


def test_row_level_patterns(spark):
    tx = spark.createDataFrame(
        [("a", "u", at(3600), 1.0, "atm_withdrawal", True, "x", "GB"), ("b", "u", at(4 * 3600), 1.0, "atm_withdrawal", True, "x", "GB"),
         ("c", "u", at(2 * 3600), 1.0, "atm_withdrawal", False, "x", "US"), ("d", "u", at(2 * 3600), 1.0, "p2p", True, "x", "GB")],
        SCHEMA + ", transaction_type string, is_international boolean, city string, country string")
    assert [r.transaction_id for r in P.midnight_atm(tx).collect()] == ["a"]
    lg = spark.createDataFrame([("l1", "u", at(0), 3, True), ("l2", "u", at(0), 2, True), ("l3", "u", at(0), 5, False), ("l4", "u", at(0), None, True)],
                               "login_id string, user_id string, timestamp timestamp, failed_attempts_before_success int, login_successful boolean")
    assert [r.login_id for r in P.multiple_failed_mfa(lg).collect()] == ["l1"]


def first_rows(rows, keys):
    out = {}
    for r in rows:
        k = tuple(r[c] for c in keys)
        if all(k) and r["timestamp"] and (k not in out or (r["timestamp"], r["transaction_id"]) < (out[k]["timestamp"], out[k]["transaction_id"])):
            out[k] = r
    return sorted((v["transaction_id"], v["timestamp"], v["amount"]) for v in out.values())


def device_rows(n, seed=7):
    rng = random.Random(seed)
    return [{"transaction_id": f"t{k:03d}", "user_id": "hot" if k % 2 else rng.choice(["u1", "u2", None]),
             "device_type": rng.choice(["ios", "web", "atm", None]), "timestamp": at(rng.randint(0, 5) * 43200),
             "amount": float(rng.choice([10, 20000]))} for k in range(n)]


DEV = "transaction_id string, user_id string, device_type string, timestamp timestamp, amount double"


@pytest.mark.parametrize("in_order", [True, False])
def test_daily_increments_equal_one_full_run(spark, tmp_dir, in_order):
    rows = device_rows(120)
    df = spark.createDataFrame(rows, DEV)
    keys = ["user_id", "device_type"]
    full = sorted((r.transaction_id, r.timestamp.replace(tzinfo=dt.timezone.utc), r.amount) for r in fs.first_seen(df, keys).collect())
    assert full == first_rows(rows, keys) and len(full) == 9
    days = range(3) if in_order else (2, 0, 1)
    root, brought = os.path.join(tmp_dir, "seen"), {}
    for d in days:
        new = df.where((F.col("timestamp") >= F.lit(at(d * 86400))) & (F.col("timestamp") < F.lit(at((d + 1) * 86400))))
        for again in range(2):  # the second run of a day brings nothing
            rows_in = sync_first_seen(spark, new, root, keys).collect()
            assert not (again and rows_in)
            brought |= {(r.user_id, r.device_type): r.transaction_id for r in rows_in}
    table = snapshot_read(spark, root)
    got = sorted((r.transaction_id, r.timestamp.replace(tzinfo=dt.timezone.utc), r.amount) for r in table.collect())
    assert got == full and sorted(brought.values()) == [t for t, _, _ in full]
    large = {r.transaction_id for r in P.new_device_large(df).collect()}
    assert large == {t for t, _, a in full if a > 10000}


def test_first_seen_reduces_before_the_shuffle(spark):
    plan = fs.first_seen(spark.createDataFrame(device_rows(10), DEV), ["user_id", "device_type"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and plan.count("Exchange") == 1


def test_round_wire_only_when_the_merchant_is_new(spark):
    rows = [("a", "u", at(0), 12000.0, "wire_transfer", "m"), ("b", "u", at(9), 13000.0, "wire_transfer", "m"),
            ("c", "u", at(1), 12500.0, "wire_transfer", "n"), ("d", "v", at(0), 5.0, "p2p", "m"), ("e", "v", at(1), 20000.0, "wire_transfer", "m"),
            ("f", "w", at(1), 10000.0, "wire_transfer", "m")]
    df = spark.createDataFrame(rows, SCHEMA + ", transaction_type string, merchant_id string")
    assert [r.transaction_id for r in P.round_amount_wire(df).collect()] == ["a"]


def test_hits_in_one_scan_with_checked_broadcast(spark):
    i = inputs_for(spark, SF_SMALL)
    sig = fixtures.signatures(spark)
    per = {r.pattern_name: r for r in catalogue.per_pattern(sig).collect()}
    assert len(per) == 15 and sum(r.signatures for r in per.values()) == 200 and per["bot_typing"].severity == "critical"
    tx = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(
        F.col("event_id").cast("string").alias("transaction_id"), F.lit("l").alias("login_id"), F.col("value").alias("amount"), "user_id")
    conditions = {f"p{k}": F.col("user_id") % 5 == k for k in range(5)}
    hits = catalogue.with_severity(catalogue.pattern_hits(tx, conditions), sig)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "BroadcastHashJoin" in plan
    small = catalogue.with_severity(catalogue.pattern_hits(tx, conditions), sig, broadcast_rows=3)
    assert "SortMergeJoin" in small._jdf.queryExecution().executedPlan().toString() or \
        spark.conf.get("spark.sql.autoBroadcastJoinThreshold") != "-1"
    assert hits.count() == tx.count() == small.count()
    mixed = spark.createDataFrame([("p", "medium", 0.1), ("p", "critical", 0.3), ("p", None, None)],
                                  "pattern_name string, severity string, false_positive_rate double")
    r = catalogue.per_pattern(mixed).first()
    assert (r.severity, r.signatures) == ("critical", 3) and math.isclose(r.false_positive_rate, 0.2)
    report = catalogue.pattern_report(catalogue.with_severity(catalogue.pattern_hits(i.risk), sig))
    assert {x.pattern_name for x in report.collect()} <= set(per)
