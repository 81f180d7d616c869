"""Streaming forms agree with batch: silver, interval joins, hourly KPIs,
queue upsert (idempotent replay), duplicate suppression, incremental load."""
import os

import pytest
from pyspark.sql import functions as F

from riskweave.operators import gold, kpis, silver
from riskweave.plans.registry import inputs_for
from riskweave.sources import readers, schemas
from riskweave.sources.writers import batch_base_version, snapshot_read, snapshot_write
from riskweave.sources.writers import snapshot_versions as writers_versions
from riskweave.streaming import pipeline as sp
from tests.conftest import SF_SMALL


def _land(spark, df, path, parts=4):
    df.repartition(parts).write.mode("overwrite").parquet(path)


def _drain(df, name):
    q = df.writeStream.format("memory").queryName(name).outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    return df.sparkSession.table(name)


def _bronze(spark, tmp_dir):
    i = inputs_for(spark, SF_SMALL)
    tx_path, lg_path = os.path.join(tmp_dir, "tx"), os.path.join(tmp_dir, "lg")
    _land(spark, i.bronze_tx.drop("ingestion_timestamp"), tx_path)
    _land(spark, i.bronze_logins.drop("ingestion_timestamp"), lg_path)
    tx = sp.read_stream(spark, tx_path, schemas.TRANSACTIONS, fmt="parquet")
    lg = sp.read_stream(spark, lg_path, schemas.LOGIN_LOGS, fmt="parquet")
    return i, tx, lg


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_streaming_silver_equals_batch(spark, tmp_dir):
    i, tx, _ = _bronze(spark, tmp_dir)
    got = _drain(silver.silver_transactions(tx), "silver_stream")
    cols = ["transaction_id", "amount_bucket", "hour_of_day", "is_off_hours", "card_number_masked"]
    assert _rows(got, cols) == _rows(i.silver_tx, cols)


def test_stream_stream_inner_join_equals_batch(spark, tmp_dir):
    i, tx, lg = _bronze(spark, tmp_dir)
    joined = sp.stream_session_join(silver.silver_transactions(tx), silver.silver_login_logs(lg), how="inner")
    got = _drain(joined, "pairs_stream")
    batch = gold.session_join(i.silver_tx, i.silver_logins).filter(F.col("login_id").isNotNull())
    assert _rows(got, ["transaction_id", "login_id"]) == _rows(batch, ["transaction_id", "login_id"])


def test_stream_wire_after_mfa_equals_batch(spark, tmp_dir):
    i, tx, lg = _bronze(spark, tmp_dir)
    got = _drain(sp.stream_wire_after_mfa(silver.silver_transactions(tx), silver.silver_login_logs(lg)), "wire_stream")
    cols = ["transaction_id", "mfa_login_id", "seconds_between"]
    assert _rows(got, cols) == _rows(i.wires, cols)


def test_stream_left_join_matches_present(spark, tmp_dir):
    i, tx, lg = _bronze(spark, tmp_dir)
    joined = sp.stream_session_join(silver.silver_transactions(tx), silver.silver_login_logs(lg), how="left")
    got = _drain(joined, "pairs_left_stream")
    batch = gold.session_join(i.silver_tx, i.silver_logins)
    matched = batch.filter(F.col("login_id").isNotNull())
    # All matches appear; unmatched rows appear only once the watermark passes them.
    got_pairs = set(_rows(got.filter(F.col("login_id").isNotNull()), ["transaction_id", "login_id"]))
    assert got_pairs == set(_rows(matched, ["transaction_id", "login_id"]))
    assert set(_rows(got, ["transaction_id"])) <= set(_rows(batch, ["transaction_id"]))


def test_stream_kpis_closed_windows_equal_batch(spark, tmp_dir):
    i = inputs_for(spark, SF_SMALL)
    path = os.path.join(tmp_dir, "risk")
    _land(spark, i.risk, path)
    stream = spark.readStream.schema(i.risk.schema).parquet(path)
    got = _drain(sp.stream_kpis(stream, delay="2 hours"), "kpi_stream")
    batch = kpis.fraud_kpis(i.risk)
    last = got.agg(F.max("hour")).first()[0]
    cols = ["hour", "risk_level", "automated_action", "transaction_count", "true_fraud_count", "false_positive_count"]
    assert got.count() > 0
    assert _rows(got, cols) == _rows(batch.filter(F.col("hour") <= last), cols)


def test_triage_sink_replay_is_noop(spark, tmp_dir):
    i = inputs_for(spark, SF_SMALL)
    root = os.path.join(tmp_dir, "triage")
    sink = sp.TriageSink(root, now=i.now)
    sink(i.risk, 0)
    first = sorted(tuple(r) for r in snapshot_read(spark, root).collect())
    sink(i.risk, 0)  # replay of the same batch id
    assert sorted(tuple(r) for r in snapshot_read(spark, root).collect()) == first
    assert len(first) == 87
    sink(i.risk, 1)  # the next batch with the same rows only refreshes them
    assert snapshot_read(spark, root).count() == 87


def test_dedupe_within_watermark(spark, tmp_dir):
    i = inputs_for(spark, SF_SMALL)
    path = os.path.join(tmp_dir, "dups")
    tx = i.bronze_tx.drop("ingestion_timestamp")
    _land(spark, tx.unionByName(tx), path)
    stream = sp.read_stream(spark, path, schemas.TRANSACTIONS, fmt="parquet")
    got = _drain(sp.dedupe_stream(stream), "dedupe_stream")
    assert got.count() == tx.count()


def test_incremental_load_skips_loaded_files(spark, tmp_dir):
    i = inputs_for(spark, SF_SMALL)
    land, target, ckpt = (os.path.join(tmp_dir, p) for p in ("land", "target", "ckpt"))
    i.bronze_tx.drop("ingestion_timestamp").limit(50).write.mode("overwrite").option("header", "true").csv(land)
    readers.load_incremental(spark, land, schemas.TRANSACTIONS, target, ckpt)
    n1 = spark.read.parquet(target).count()
    readers.load_incremental(spark, land, schemas.TRANSACTIONS, target, ckpt)
    assert spark.read.parquet(target).count() == n1 == 50


def _land_in_time_order(df, path, bounds):
    """One file per time slice, written oldest first (a feed arriving in order)."""
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        df.filter((F.col("timestamp") >= lo) & (F.col("timestamp") < hi)).coalesce(1) \
          .write.mode("append").parquet(path)


def test_end_to_end_stream_queue_agrees_with_batch(spark, tmp_dir):
    i = inputs_for(spark, SF_SMALL)
    tx_path, lg_path = os.path.join(tmp_dir, "tx"), os.path.join(tmp_dir, "lg")
    bounds = ["2024-01-01", "2024-01-09", "2024-01-17", "2024-01-25", "2024-02-02"]
    _land_in_time_order(i.bronze_tx.drop("ingestion_timestamp"), tx_path, bounds)
    _land_in_time_order(i.bronze_logins.drop("ingestion_timestamp"), lg_path, bounds)
    root, ckpt = os.path.join(tmp_dir, "queue"), os.path.join(tmp_dir, "ckpt")
    q = sp.start_session_risk_stream(spark, tx_path, lg_path, root, ckpt, fmt="parquet", now=i.now,
                                     trigger={"availableNow": True}, max_files_per_trigger=1)
    q.awaitTermination()
    got = {r.transaction_id: r for r in snapshot_read(spark, root).collect()}
    from riskweave.operators import triage as tr
    batch = {r.transaction_id: r for r in tr.upsert(None, tr.to_triage(
        gold.dedupe_per_transaction(i.risk), created_at=F.col("tx_timestamp")), now=i.now).collect()}
    assert got and set(got) <= set(batch)
    for tid, r in got.items():
        assert (r.risk_score, r.automated_action) == (batch[tid].risk_score, batch[tid].automated_action)
    matched = {t for t, r in batch.items() if r.login_city != ""}
    assert matched <= set(got)
    assert len(writers_versions(spark, root)) > 1  # several micro-batches ran


def test_chained_join_then_kpi_window_equals_batch(spark, tmp_dir):
    i = inputs_for(spark, SF_SMALL)
    tx_path, lg_path = os.path.join(tmp_dir, "tx"), os.path.join(tmp_dir, "lg")
    bounds = ["2024-01-01", "2024-01-09", "2024-01-17", "2024-01-25", "2024-02-02"]
    _land_in_time_order(i.bronze_tx.drop("ingestion_timestamp"), tx_path, bounds)
    _land_in_time_order(i.bronze_logins.drop("ingestion_timestamp"), lg_path, bounds)
    out, ckpt = os.path.join(tmp_dir, "kpis"), os.path.join(tmp_dir, "ckpt")
    q = sp.start_kpi_stream(spark, tx_path, lg_path, out, ckpt, fmt="parquet",
                            trigger={"availableNow": True}, max_files_per_trigger=1)
    q.awaitTermination()
    got = spark.read.parquet(out)
    last = got.agg(F.max("hour")).first()[0]
    cols = ["hour", "risk_level", "automated_action", "transaction_count", "true_fraud_count"]
    assert got.count() > 400
    assert _rows(got, cols) == _rows(kpis.fraud_kpis(i.risk).filter(F.col("hour") <= last), cols)


def test_decision_stream_sink_first_wins_and_replay(spark, tmp_dir):
    i = inputs_for(spark, SF_SMALL)
    root = os.path.join(tmp_dir, "queue")
    sp.TriageSink(root, now=i.now)(i.risk, 0)
    sink = sp.DecisionSink(root, outcome_path=os.path.join(tmp_dir, "outcomes"), now=i.now)
    sink(i.decisions, 0)
    decided = snapshot_read(spark, root).filter("analyst_decision IS NOT NULL").count()
    assert decided == 36
    sink(i.decisions, 0)  # replay: skipped
    assert len(writers_versions(spark, root)) == 2
    sink(i.decisions, 1)  # same decisions again: all already reviewed, nothing changes
    assert snapshot_read(spark, root).filter("analyst_decision IS NOT NULL").count() == 36
    outcomes = spark.read.parquet(os.path.join(tmp_dir, "outcomes"))
    counts = {(r.batch_id, r.status): r["count"] for r in outcomes.groupBy("batch_id", "status").count().collect()}
    assert counts[(0, "applied")] == 36 and counts[(1, "already_reviewed")] == 36


def test_decision_sink_replay_after_crash_is_exact(spark, tmp_dir):
    """A driver dies after the outcome rows were written but before the next
    queue version committed; the replayed batch must give the same outcome
    rows once (not twice, not re-labelled) and the same queue."""
    from riskweave.operators import triage as tr
    i = inputs_for(spark, SF_SMALL)
    root, out = os.path.join(tmp_dir, "queue"), os.path.join(tmp_dir, "outcomes")
    sp.TriageSink(root, now=i.now)(i.risk, 0)
    sink = sp.DecisionSink(root, outcome_path=out, now=i.now)
    base = batch_base_version(spark, root, sink.writer, 7)   # the crashed attempt, step 1
    tr.decision_outcome(snapshot_read(spark, root), i.decisions).write.mode("overwrite") \
      .parquet(os.path.join(out, f"writer={sink.writer}", "batch_id=7"))  # step 2; dies before the snapshot
    sink(i.decisions, 7)                                      # replay
    assert writers_versions(spark, root) == [base, base + 1]
    got = spark.read.parquet(out)
    counts = {r.status: r["count"] for r in got.groupBy("status").count().collect()}
    assert counts["applied"] == 36 and got.count() == i.decisions.count()
    assert snapshot_read(spark, root).filter("analyst_decision IS NOT NULL").count() == 36
    sink(i.decisions, 7)                                      # replay after completion: no-op
    assert writers_versions(spark, root) == [base, base + 1] and spark.read.parquet(out).count() == got.count()


def test_upsert_sink_batch_after_another_writer_is_applied(spark, tmp_dir):
    """Versions written by other jobs between micro-batches (decisions,
    explanations) must not make a later upsert batch look done."""
    i = inputs_for(spark, SF_SMALL)
    root = os.path.join(tmp_dir, "queue")
    half_a, half_b = (i.risk.filter(f"pmod(hash(transaction_id), 2) = {k}") for k in (0, 1))
    sink = sp.TriageSink(root, now=i.now)
    sink(half_a, 0)
    snapshot_write(snapshot_read(spark, root), root)          # another job's version 2
    sink(half_b, 1)                                           # must build version 3
    sink(half_b, 1)                                           # replay: no-op
    assert writers_versions(spark, root) == [1, 2, 3]
    whole = os.path.join(tmp_dir, "whole")
    sp.TriageSink(whole, now=i.now)(i.risk, 0)
    cols = ["transaction_id", "risk_score", "automated_action"]
    assert _rows(snapshot_read(spark, root), cols) == _rows(snapshot_read(spark, whole), cols)


def test_snapshot_expire_keeps_newest_and_replayable(spark, tmp_dir):
    from riskweave.sources.writers import snapshot_expire
    i = inputs_for(spark, SF_SMALL)
    root = os.path.join(tmp_dir, "queue")
    parts = [i.risk.filter(f"pmod(hash(transaction_id), 3) = {k}") for k in range(3)]
    sink = sp.TriageSink(root, now=i.now, keep_versions=2)
    for b, part in enumerate(parts):
        sink(part, b)
    assert writers_versions(spark, root) == [2, 3]
    sink(parts[2], 2)                                        # replay of the last batch: still a no-op
    assert writers_versions(spark, root) == [2, 3]
    def names(d):  # the local file system adds .crc side files
        return sorted(n for n in os.listdir(d) if not n.endswith(".crc"))
    assert names(os.path.join(root, "_batches", sink.writer)) == ["batch=0", "batch=1", "batch=2"]
    sink(parts[0], 0)                                        # a replay after its base expired: a no-op too
    assert writers_versions(spark, root) == [2, 3]
    assert names(os.path.join(root, "_tags")) == ["v=000000000002", "v=000000000003"]
    whole = os.path.join(tmp_dir, "whole")
    sp.TriageSink(whole, now=i.now)(i.risk, 0)
    cols = ["transaction_id", "risk_score", "automated_action"]
    assert _rows(snapshot_read(spark, root), cols) == _rows(snapshot_read(spark, whole), cols)
    assert snapshot_expire(spark, root, keep=1) == [2] and writers_versions(spark, root) == [3]


def test_table_sink_equals_snapshot_sink_and_replay_is_noop(spark, tmp_dir):
    i = inputs_for(spark, SF_SMALL)
    parts = [i.risk.filter(f"pmod(hash(transaction_id), 3) = {k}") for k in range(3)]
    loc = os.path.join(tmp_dir, "tbl")
    sink = sp.TriageTableSink("rw_stream_queue", now=i.now, buckets=8, location=loc)
    for b, part in enumerate(parts):
        sink(part, b)
    assert len([n for n in os.listdir(loc) if n.startswith("v=")]) == 2   # the current copy and one before
    cols = ["transaction_id", "risk_score", "automated_action", "created_at", "updated_at", "expires_at"]
    once = _rows(spark.table("rw_stream_queue"), cols)
    sink(parts[2], 2)                                         # replayed batch
    sink(parts[1], 1)                                         # even an older one
    assert _rows(spark.table("rw_stream_queue"), cols) == once
    whole = os.path.join(tmp_dir, "whole")
    sp.TriageSink(whole, now=i.now)(i.risk, 0)
    assert once == _rows(snapshot_read(spark, whole), cols) and len(once) == 87


def test_new_checkpoint_gets_its_own_batch_records(spark, tmp_dir):
    """Batch ids restart at 0 under a new checkpoint: the new stream's batch 0
    must be applied, not mistaken for the old stream's batch 0."""
    i = inputs_for(spark, SF_SMALL)
    root = os.path.join(tmp_dir, "queue")
    half_a, half_b = (i.risk.filter(f"pmod(hash(transaction_id), 2) = {k}") for k in (0, 1))
    sp.TriageSink(root, now=i.now, writer=sp.stream_writer_name("upsert", "/ckpt/one"))(half_a, 0)
    sp.TriageSink(root, now=i.now, writer=sp.stream_writer_name("upsert", "/ckpt/two"))(half_b, 0)
    assert writers_versions(spark, root) == [1, 2]
    assert snapshot_read(spark, root).count() == 87


@pytest.mark.parametrize("higher_first", [True, False])
def test_queue_rows_do_not_depend_on_how_pairs_are_batched(spark, tmp_dir, higher_first):
    from pyspark.sql import Window
    i = inputs_for(spark, SF_SMALL)
    top = F.max("risk_score").over(Window.partitionBy("transaction_id"))
    pairs = i.risk.withColumn("__top", top)
    high = pairs.where(F.col("risk_score") == F.col("__top")).drop("__top")
    low = pairs.where(F.col("risk_score") < F.col("__top")).drop("__top")
    split, whole = os.path.join(tmp_dir, "split"), os.path.join(tmp_dir, "whole")
    sink = sp.TriageSink(split, now=i.now)
    for n, batch in enumerate([high, low] if higher_first else [low, high]):
        sink(batch, n)
    sp.TriageSink(whole, now=i.now)(i.risk, 0)
    got, want = snapshot_read(spark, split), snapshot_read(spark, whole)
    assert got.columns == want.columns and want.count() > 0
    assert _rows(got, got.columns) == _rows(want, want.columns)


def test_higher_pair_clears_the_old_explanation_unless_decided(spark):
    from riskweave.operators import triage as tr
    row = "transaction_id string, risk_score int, login_city string, mfa_changed boolean"
    known = tr.with_triage_defaults(spark.createDataFrame(
        [("a", 50, "NY", False, "old", None), ("b", 50, "NY", False, "old", "BLOCK"), ("c", 90, "NY", False, "old", None)],
        row + ", explanation string, analyst_decision string"))
    new = spark.createDataFrame([(t, 80, "Lagos", True) for t in "abc"], row)
    got = {r["transaction_id"]: r for r in tr.upsert(known, new, only_if_higher=True).collect()}
    pick = lambda r: (r["risk_score"], r["login_city"], r["mfa_changed"], r["explanation"])
    assert pick(got["a"]) == (80, "Lagos", True, None)
    assert pick(got["b"]) == (80, "Lagos", True, "old") and got["b"]["analyst_decision"] == "BLOCK"
    assert pick(got["c"]) == (90, "NY", False, "old")
