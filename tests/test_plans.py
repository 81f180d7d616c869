"""Physical-plan properties the scale design relies on."""
import datetime as dt
import os

from hypothesis import given, settings, strategies as st

from riskweave.operators import gold, silver
from riskweave.operators.intervals import interval_join
from riskweave.plans.registry import inputs_for
from riskweave.session import RECOMMENDED_CONF
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return fn()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_session_join_is_bucketed_sort_merge_without_estimate_broadcast(spark):
    i = inputs_for(spark, SF_SMALL)
    conf = {"spark.sql.autoBroadcastJoinThreshold": RECOMMENDED_CONF["spark.sql.autoBroadcastJoinThreshold"]}
    plan = _with_conf(spark, conf, lambda: _plan(gold.session_join(i.silver_tx, i.silver_logins)))
    assert "SortMergeJoin" in plan and "__lb" in plan and "__rb" in plan
    assert "BroadcastExchange" not in plan
    assert "Generate explode(sequence(" in plan  # logins copied to the buckets they touch


def test_dedupe_limits_groups_before_the_shuffle(spark):
    i = inputs_for(spark, SF_SMALL)
    plan = _plan(gold.dedupe_per_transaction(i.risk))
    # The plan prints top-down: above the exchange runs after the shuffle (final
    # top-1), below it runs in the map tasks (partial top-1).
    after_shuffle, _, map_side = plan.partition("Exchange hashpartitioning(transaction_id")
    assert "WindowGroupLimit" in after_shuffle and "WindowGroupLimit" in map_side


def test_quality_rules_and_projection_reach_parquet(spark, tmp_dir):
    i = inputs_for(spark, SF_SMALL)
    path = os.path.join(tmp_dir, "bronze")
    i.bronze_tx.write.parquet(path)
    df = silver.silver_transactions(spark.read.parquet(path)).select("transaction_id", "amount_bucket")
    scan = [l for l in _plan(df).splitlines() if "FileScan" in l][0]
    assert "PushedFilters: [IsNotNull(amount), GreaterThan(amount,0.0), IsNotNull(user_id)]" in scan
    assert "ReadSchema: struct<transaction_id:string,user_id:string,amount:double>" in scan


def test_aggregations_combine_map_side(spark):
    from riskweave.operators import bi, kpis
    i = inputs_for(spark, SF_SMALL)
    for df in (kpis.fraud_kpis(i.risk), bi.bi_top_risky_users(i.risk), bi.bi_account_takeover(i.risk)):
        assert "partial_" in _plan(df)
    assert "TakeOrderedAndProject" in _plan(bi.bi_top_risky_users(i.risk))


T0 = dt.datetime(2024, 1, 1)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 20_000)), min_size=1, max_size=25),
       st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(-4000, 20_000)), min_size=0, max_size=25),
       st.integers(1, 7200), st.sampled_from([None, "7 minutes", "2 hours"]))
def test_interval_join_matches_brute_force(spark, txs, logins, window_s, bucket):
    tx = spark.createDataFrame([(f"t{k}", u, T0 + dt.timedelta(seconds=s)) for k, (u, s) in enumerate(txs)],
                               "tid string, user_id string, tts timestamp")
    lg = spark.createDataFrame([(f"l{k}", u, T0 + dt.timedelta(seconds=s)) for k, (u, s) in enumerate(logins)],
                               "lid string, user_id string, lts timestamp")
    out = interval_join(tx, lg, "user_id", "tts", "lts", upper=f"{window_s} seconds", how="left", bucket=bucket)
    got = sorted((r.tid, r.lid or "") for r in out.collect())
    expect = []
    for k, (u, s) in enumerate(txs):
        hits = [f"l{j}" for j, (lu, ls) in enumerate(logins) if lu == u and ls <= s <= ls + window_s]
        expect += [(f"t{k}", h) for h in hits] or [(f"t{k}", "")]
    assert got == sorted(expect)


def test_hot_user_hour_bucket_is_split_by_aqe_skew_join(spark):
    """70% of all transactions belong to one user inside one hour, so one
    (user, hour) bucket dominates; AQE's skew join must split that bucket's
    transaction side across tasks (the preserved side of the left join, which
    Spark may split) and the rows must equal the plain join's."""
    from pyspark.sql import functions as F
    base = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp")

    def at(secs):
        return base + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs.cast("decimal(18,6)"))
    tx = spark.range(20000).select(
        F.col("id").alias("tid"), F.when(F.col("id") % 10 < 7, F.lit(0)).otherwise(F.col("id") % 50).alias("user_id"),
        at(F.col("id") % 3000).alias("tx_ts"), F.lpad(F.col("id").cast("string"), 40, "x").alias("pad"))
    lg = spark.range(1000).select(F.col("id").alias("lid"), (F.col("id") % 50).alias("user_id"),
                                  at(F.col("id") * 7 % 3000).alias("l_ts"))
    conf = {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.autoBroadcastJoinThreshold": "-1"}

    def run():
        b = interval_join(tx, lg, "user_id", "tx_ts", "l_ts", "0 seconds", "1 hour").select("tid", "lid")
        p = interval_join(tx, lg, "user_id", "tx_ts", "l_ts", "0 seconds", "1 hour", strategy="plain") \
            .select("tid", "lid")
        n = len(b.collect())                                  # runs b's own plan to its final form
        return n, _plan(b), b.exceptAll(p).count(), p.exceptAll(b).count()
    n, plan, extra, missing = _with_conf(spark, conf, run)
    assert "isFinalPlan=true" in plan and "SortMergeJoin(skew=true)" in plan
    assert "coalesced and skewed" in plan
    assert extra == 0 and missing == 0 and n > 20000
