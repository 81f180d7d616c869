"""Stream joins keyed by (user, time bucket), and jobs that ignore re-landed files."""
import os

import pytest
from pyspark.sql import functions as F

from riskweave.operators import gold, kpis, silver
from riskweave.plans.registry import inputs_for
from riskweave.sources import schemas
from riskweave.sources.writers import snapshot_read
from riskweave.streaming import pipeline as sp
from tests.conftest import SF_SMALL
from tests.test_streaming import _land_in_time_order, _rows

BOUNDS = ["2024-01-01", "2024-01-09", "2024-01-17", "2024-01-25", "2024-02-02"]


def _hot(spark):
    """The fixture rows with half of all users folded into one."""
    i = inputs_for(spark, SF_SMALL)
    fold = F.when(F.substring("user_id", -1, 1).isin("0", "1", "2", "3", "4"), F.lit("USR-HOT")).otherwise(F.col("user_id"))
    tx = i.bronze_tx.drop("ingestion_timestamp").withColumn("user_id", fold)
    lg = i.bronze_logins.drop("ingestion_timestamp").withColumn("user_id", fold)
    return silver.silver_transactions(tx), silver.silver_login_logs(lg), tx, lg


def _streams(spark, tmp_dir, tx, lg):
    paths = [os.path.join(tmp_dir, n) for n in ("tx", "lg")]
    _land_in_time_order(tx, paths[0], BOUNDS)
    _land_in_time_order(lg, paths[1], BOUNDS)
    return (silver.silver_transactions(sp.read_stream(spark, paths[0], schemas.TRANSACTIONS, "parquet", 1)),
            silver.silver_login_logs(sp.read_stream(spark, paths[1], schemas.LOGIN_LOGS, "parquet", 1)))


def _run(df, tmp_dir, name):
    out, ckpt = os.path.join(tmp_dir, name), os.path.join(tmp_dir, name + "-ckpt")
    df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt) \
      .trigger(availableNow=True).start().awaitTermination()
    return df.sparkSession.read.parquet(out), ckpt


@pytest.mark.parametrize("bucket", [None, "10 minutes"])
def test_left_join_by_bucket_equals_batch_with_a_hot_user(spark, tmp_dir, bucket):
    s_tx, s_lg, tx, lg = _hot(spark)
    assert s_tx.where("user_id = 'USR-HOT'").count() * 2 >= s_tx.count() * 0.9
    t, g = _streams(spark, tmp_dir, tx, lg)
    got, ckpt = _run(sp.stream_session_join(t, g, how="left", bucket=bucket), tmp_dir, "pairs")
    batch = gold.session_join(s_tx, s_lg)
    cols = ["transaction_id", "login_id"]
    assert _rows(got.where("login_id IS NOT NULL"), cols) == _rows(batch.where("login_id IS NOT NULL"), cols)
    unmatched = got.where("login_id IS NULL")
    assert unmatched.count() == unmatched.distinct().count() > 0
    assert set(_rows(unmatched, cols)) <= set(_rows(batch.where("login_id IS NULL"), cols))
    late = got.agg(F.max("tx_timestamp")).first()[0]
    closed = batch.where((F.col("login_id").isNull()) & (F.col("tx_timestamp") <= F.lit(late) - F.expr("INTERVAL 6 HOURS")))
    assert set(_rows(closed, cols)) <= set(_rows(unmatched, cols))


def test_hot_user_s_state_lies_in_several_partitions(spark, tmp_dir):
    _, _, tx, lg = _hot(spark)
    t, g = _streams(spark, tmp_dir, tx, lg)
    # a long delay keeps all state
    joined = sp.stream_session_join(t, g, tx_delay="60 days", login_delay="60 days", how="inner")
    _, ckpt = _run(joined, tmp_dir, "pairs")
    state = spark.read.format("statestore").option("path", ckpt).option("joinSide", "left").load()
    assert state.select("key.*").columns[0] == "field0"
    hot = state.where("key.field0 = 'USR-HOT'")
    assert hot.select("partition_id").distinct().count() >= 4 and hot.select("key").distinct().count() > 100


def test_wire_after_mfa_by_bucket_equals_batch(spark, tmp_dir):
    s_tx, s_lg, tx, lg = _hot(spark)
    t, g = _streams(spark, tmp_dir, tx, lg)
    got, _ = _run(sp.stream_wire_after_mfa(t, g, delay="2 days"), tmp_dir, "wires")
    want = gold.wire_after_mfa(s_tx, s_lg)
    assert got.columns == want.columns and want.count() > 10
    assert _rows(got, want.columns) == _rows(want, want.columns)


def test_too_narrow_buckets_are_an_error(spark, tmp_dir):
    _, _, tx, lg = _hot(spark)
    t, g = _streams(spark, tmp_dir, tx, lg)
    with pytest.raises(ValueError, match="narrow"):
        sp.stream_session_join(t, g, bucket="1 second")


def test_rows_without_an_id_are_repeats_only_when_equal(spark, tmp_dir):
    path = os.path.join(tmp_dir, "rows")
    rows = spark.createDataFrame([("a", 1), ("a", 2), (None, 1), (None, 1), (None, 2), ("row:x", 1)], "id string, v int") \
        .withColumn("timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    rows.coalesce(1).write.parquet(path)
    stream = sp.read_stream(spark, path, rows.schema, "parquet")
    got, _ = _run(sp.dedupe_stream(stream, "id"), tmp_dir, "out")
    assert sorted((r.id or "", r.v) for r in got.collect()) == [("", 1), ("", 2), ("a", 1), ("row:x", 1)]


@pytest.mark.parametrize("again", ["same batch", "later"])
def test_re_landed_files_change_neither_queue_nor_kpis(spark, tmp_dir, again):
    i = inputs_for(spark, SF_SMALL)
    tx, lg = i.bronze_tx.drop("ingestion_timestamp"), i.bronze_logins.drop("ingestion_timestamp")

    def run(name, repeat):
        tx_path, lg_path = (os.path.join(tmp_dir, name, p) for p in ("tx", "lg"))
        for n, (lo, hi) in enumerate(zip(BOUNDS[:-1], BOUNDS[1:])):
            part = f"timestamp >= '{lo}' AND timestamp < '{hi}'"
            for df, path in ((tx, tx_path), (lg, lg_path)):
                df.where(part).coalesce(1).write.mode("append").parquet(path)
                if repeat == "same batch" and n == 1 or repeat == "next trigger" and n == 2:
                    df.where(part).coalesce(1).write.mode("append").parquet(path)
                if repeat == "later" and n == 3:
                    df.where(f"timestamp < '{BOUNDS[1]}'").coalesce(1).write.mode("append").parquet(path)
        files = 2 if repeat == "same batch" else 1
        args = dict(fmt="parquet", trigger={"availableNow": True}, max_files_per_trigger=files)
        root, out = os.path.join(tmp_dir, name, "queue"), os.path.join(tmp_dir, name, "kpis")
        sp.start_session_risk_stream(spark, tx_path, lg_path, root, os.path.join(tmp_dir, name, "c1"), now=i.now,
                                     **args).awaitTermination()
        sp.start_kpi_stream(spark, tx_path, lg_path, out, os.path.join(tmp_dir, name, "c2"), **args).awaitTermination()
        return snapshot_read(spark, root), spark.read.parquet(out)

    queue, kpi = run("again", again)
    assert queue.count() == queue.select("transaction_id").distinct().count()
    want = kpis.fraud_kpis(i.risk)
    last = kpi.agg(F.max("hour")).first()[0]
    cols = ["hour", "risk_level", "automated_action", "transaction_count", "true_fraud_count"]
    assert kpi.count() > 300 and _rows(kpi, cols) == _rows(want.where(F.col("hour") <= F.lit(last)), cols)
    once, _ = run("once", None)
    both = [c for c in once.columns if c not in ("created_at", "updated_at", "expires_at")]
    ids = {r.transaction_id for r in once.collect()} & {r.transaction_id for r in queue.collect()}
    pick = lambda df: _rows(df.where(F.col("transaction_id").isin(sorted(ids))), both)
    assert len(ids) >= 70 and pick(once) == pick(queue)
