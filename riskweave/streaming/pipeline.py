"""Structured Streaming forms of ingest, silver, the interval joins, the
hourly KPIs and the queue upsert.

* Silver is stateless, so the batch functions apply to streaming frames as is.
* Stream-stream interval joins keep state per side only until the other
  side's watermark passes the window; the left outer form emits unmatched
  transactions once the login watermark has moved beyond their window.
* KPIs are an event-time tumbling window with a lateness bound, in append mode.
* The queue upsert and decision sinks are ``foreachBatch`` sinks writing a
  new snapshot version per micro-batch; the version a batch starts from is
  recorded and the version it writes is tagged with the batch, so a replayed
  batch rebuilds exactly the same result or, once committed, is skipped.

Checkpoints and snapshots go under the shared root named by the session's
``spark.checkpoint.dir`` (see ``riskweave.session.shared_path``).
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave import config as C
from riskweave.operators import gold, kpis, triage as tr
from riskweave.operators.intervals import bucket_width, interval_micros, time_bucket, window_buckets
from riskweave.session import shared_path
from riskweave.sources import partitions, schemas
from riskweave.sources.rejects import Checked, check, reject_root
from riskweave.sources.writers import (PUBLISH_TRIES, RETRY_SECONDS, VersionTaken, batch_base_version, batch_done,
                                       read_bucketed, snapshot_current_version, snapshot_expire, snapshot_next_version,
                                       snapshot_published, snapshot_read_version, snapshot_write, swap_bucketed)


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Files arriving in a landing folder as a stream (explicit schema)."""
    r = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        r = r.option("header", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def stream_bronze_transactions(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_stream(spark, path, schemas.TRANSACTIONS, fmt).withColumn(
        "ingestion_timestamp", F.current_timestamp())


def stream_bronze_login_logs(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_stream(spark, path, schemas.LOGIN_LOGS, fmt).withColumn(
        "ingestion_timestamp", F.current_timestamp())


def _watermarked(df: DataFrame, ts: str, delay: str | None) -> DataFrame:
    """``delay=None``: the input already carries a watermark on ``ts``."""
    return df.withWatermark(ts, delay) if delay else df


def _bucketed_join(left: DataFrame, right: DataFrame, left_ts: str, right_ts: str, right_key: str, window: str,
                   how: str, bucket: str | None) -> DataFrame:
    """Stream-stream join on (user, time bucket) with the range on the event
    times.  The right side is copied to the buckets its window touches (two at
    most by default) and a left row keeps its one bucket, so every pair and every
    unmatched left row comes once, and the state of one heavy user is spread
    over its buckets.  Watermarks stay on the event times, so the engine still
    bounds the state."""
    hi_us = interval_micros(window)
    width = bucket_width(0, hi_us, bucket)
    lt = left.withColumn("__lb", time_bucket(left_ts, width))
    rt = right.withColumn("__rb", F.explode(window_buckets(right_ts, 0, hi_us, width)))
    cond = ((F.col("user_id") == F.col(right_key)) & (F.col("__lb") == F.col("__rb"))
            & (F.col(left_ts) >= F.col(right_ts))
            & (F.col(left_ts) <= F.col(right_ts) + F.expr(f"INTERVAL {window}")))
    return lt.join(rt, cond, how).drop("__lb", "__rb", right_key)


def stream_session_join(tx: DataFrame, logins: DataFrame, window: str = C.SESSION_WINDOW,
                        tx_delay: str | None = "2 hours", login_delay: str | None = "2 hours",
                        how: str = "left", bucket: str | None = None) -> DataFrame:
    """Stream-stream interval join of silver transactions and logins, keyed by
    (user, time bucket) (``bucket``: its width, by default the window).

    Both sides carry watermarks (a delay of None: the input has one already);
    the range ``login <= tx <= login + window`` is written on the event-time
    columns so the engine can bound the state.  Output columns match
    ``gold.session_join``.
    """
    t = _watermarked(gold._tx_side(tx), "tx_timestamp", tx_delay)
    lg = _watermarked(gold._login_side(logins).withColumnRenamed("user_id", "__luser"), "login_timestamp", login_delay)
    joined = _bucketed_join(t, lg, "tx_timestamp", "login_timestamp", "__luser", window, how, bucket)
    return joined.select(*gold.PAIR_COLUMNS)


def stream_wire_after_mfa(tx: DataFrame, logins: DataFrame, window: str = C.MFA_WIRE_WINDOW,
                          delay: str | None = "1 day", bucket: str | None = None) -> DataFrame:
    """Inner stream-stream form of the wire-after-MFA join, keyed by (user, time bucket)."""
    wires = _watermarked(gold.wire_side(tx, C.MFA_WIRE_MIN_AMOUNT), "wire_timestamp", delay)
    mfa = _watermarked(gold.mfa_side(logins).withColumnRenamed("user_id", "__muser"), "mfa_change_timestamp", delay)
    joined = _bucketed_join(wires, mfa, "wire_timestamp", "mfa_change_timestamp", "__muser", window, "inner", bucket)
    return gold.wire_pairs(joined)


def stream_kpis(risk: DataFrame, delay: str | None = "2 hours") -> DataFrame:
    """Hourly KPIs as an event-time tumbling window; a window is emitted once
    the watermark passes its end (append mode).  ``delay=None`` when the input
    already carries a watermark on ``tx_timestamp`` (e.g. straight behind
    ``stream_session_join``: the join's event time flows through)."""
    src = _watermarked(risk, "tx_timestamp", delay)
    return kpis.kpi_table(src, F.window("tx_timestamp", "1 hour")).withColumn("hour", F.col("hour.start"))


def dedupe_stream(df: DataFrame, key: str = "transaction_id", ts: str = "timestamp",
                  delay: str = "1 hour") -> DataFrame:
    """Drop replayed rows with the same key arriving within the lateness bound;
    a repeat that comes later is behind the watermark and dropped as late.  Rows
    without a key are repeats when all their columns are equal.  The result
    carries the watermark on ``ts``."""
    same = F.coalesce(F.concat(F.lit("key:"), F.col(key).cast("string")),
                      F.concat(F.lit("row:"), F.xxhash64(*df.columns).cast("string")))
    return (df.withWatermark(ts, delay).withColumn("__same", same)
            .dropDuplicatesWithinWatermark(["__same"]).drop("__same"))


def _landed_pairs(spark: SparkSession, tx_path: str, login_path: str, fmt: str, delay: str,
                  max_files_per_trigger: int | None) -> DataFrame:
    """Landing files -> silver -> repeats dropped -> session join -> score: a
    file that lands again adds nothing to any job behind it."""
    from riskweave.operators import silver
    tx = silver.silver_transactions(read_stream(spark, tx_path, schemas.TRANSACTIONS, fmt, max_files_per_trigger))
    lg = silver.silver_login_logs(read_stream(spark, login_path, schemas.LOGIN_LOGS, fmt, max_files_per_trigger))
    tx, lg = dedupe_stream(tx, "transaction_id", delay=delay), dedupe_stream(lg, "login_id", delay=delay)
    return gold.with_risk(stream_session_join(tx, lg, tx_delay=None, login_delay=None, how="left"))


def _replay_base(spark: SparkSession, root: str, writer: str, batch_id: int) -> int | None:
    """Version a batch of ``writer`` builds on, or None when the batch is
    already complete (a committed version carries its tag ``writer:batch_id``,
    or it is recorded as done).  If another job published meanwhile, the batch
    is re-based on the current version."""
    if batch_done(spark, root, writer, batch_id):
        return None
    base = batch_base_version(spark, root, writer, batch_id)
    if snapshot_published(spark, root, f"{writer}:{batch_id}", after=base):
        return None
    if snapshot_current_version(spark, root) != base:
        base = batch_base_version(spark, root, writer, batch_id, rebase=True)
    return base


def _write_batch(spark: SparkSession, root: str, writer: str, batch_id: int, build) -> bool:
    """Publish ``build(queue the batch starts from)`` as the batch's version,
    re-based on the newer queue when another job published first; False when
    the batch was complete before."""
    for _ in range(PUBLISH_TRIES):
        version = snapshot_next_version(spark, root)
        base = _replay_base(spark, root, writer, batch_id)
        if base is None:
            return False
        current = snapshot_read_version(spark, root, base) if base else None
        try:
            snapshot_write(build(current), root, version=version, tag=f"{writer}:{batch_id}", base=base)
            return True
        except VersionTaken as e:
            taken = e
            time.sleep(RETRY_SECONDS)
    raise taken


class TriageSink:
    """``foreachBatch`` sink: dedupe the batch per transaction, lay it out as
    queue rows and upsert it into the queue (a known transaction is updated
    only by a higher-scoring pair), writing the next version.  Replay-safe:
    the version a batch starts from is recorded, so a replay rebuilds the same
    next version, and a batch whose version is committed is skipped.  Other
    jobs may publish versions between and during batches: the batch is then
    built again on theirs."""

    writer = "upsert"

    def __init__(self, root: str, now=None, factors: str = "object", keep_versions: int | None = None,
                 writer: str | None = None, rejects: str | None = None):
        self.root, self.now, self.factors, self.keep = root, now, factors, keep_versions
        self.writer = writer or self.writer
        self.rejects = rejects or reject_root(root)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if _replay_base(spark, self.root, self.writer, batch_id) is None:
            return
        checked = _checked(batch, self.factors, self.rejects, self.writer, batch_id)
        fresh = _write_batch(spark, self.root, self.writer, batch_id,
                             lambda queue: tr.upsert(queue, checked.accepted, now=self.now, only_if_higher=True))
        checked.publish_done()
        if fresh and self.keep:
            snapshot_expire(spark, self.root, self.keep)


def _checked(batch: DataFrame, factors: str, rejects: str, writer: str, batch_id: int) -> Checked:
    """A micro-batch as queue rows, those that break a constraint set aside."""
    rows = tr.to_triage(gold.dedupe_per_transaction(batch), factors=factors, created_at=F.col("tx_timestamp"))
    return check(rows, rejects, f"{writer}-{batch_id}")


class TriageTableSink:
    """``foreachBatch`` sink into a catalog queue table bucketed and sorted by
    ``transaction_id`` (the streaming form of ``plans.review.sync_queue_table``).
    The upsert join scans the queue with no exchange; only the micro-batch is
    shuffled into the table's buckets, so the queue does not move across the
    network on every trigger.  The new table is written aside and swapped in
    (an interrupted swap is finished on the next read).  Replay-safe by
    idempotence: a known transaction changes only for a strictly higher score
    and a present one is never inserted again, so applying a batch twice
    leaves the table as applying it once."""

    writer = "upsert"

    def __init__(self, table: str, now=None, factors: str = "object", buckets: int = 64,
                 location: str | None = None, writer: str | None = None, rejects: str | None = None):
        self.table, self.now, self.factors = table, now, factors
        self.buckets, self.location, self.rejects = buckets, location, rejects
        self.writer = writer or self.writer

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        checked = _checked(batch, self.factors, self.rejects or shared_path(spark, "rejects", self.table), self.writer, batch_id)
        merged = tr.upsert(read_bucketed(spark, self.table), checked.accepted, now=self.now, only_if_higher=True)
        swap_bucketed(merged, self.table, "transaction_id", self.buckets, self.location)
        checked.publish_done()


class TriageBucketSink:
    """``foreachBatch`` sink into a queue of key buckets (``sources.partitions``):
    a micro-batch rewrites the buckets of its transactions and no others, so the
    bytes written follow the batch.  Replay-safe by idempotence, as the table
    sink is."""

    writer = "upsert"

    def __init__(self, root: str, now=None, factors: str = "object", buckets: int = partitions.BUCKETS,
                 writer: str | None = None, rejects: str | None = None):
        self.root, self.now, self.factors, self.buckets = root, now, factors, buckets
        self.writer = writer or self.writer
        self.rejects = rejects or reject_root(root)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        checked = _checked(batch, self.factors, self.rejects, self.writer, batch_id)
        partitions.upsert(batch.sparkSession, checked.accepted, self.root, now=self.now, only_if_higher=True, buckets=self.buckets)
        checked.publish_done()


class DecisionSink:
    """``foreachBatch`` sink for a stream of analyst decisions: each micro-batch
    is applied first-wins to the queue (undecided rows only) and written as
    the next version; the per-decision outcome rows go to
    ``<outcome_path>/writer=<writer>/batch_id=<id>``.

    Replay-exact: a replay reads the version the batch started from, so it
    recomputes the same outcomes (the batch's partition is overwritten, never
    appended twice) and the same next version; a batch whose version is
    committed is skipped (see ``TriageSink`` for other writers).  Pass
    ``writer=stream_writer_name("decisions", checkpoint)`` so a stream started
    on a new checkpoint (batch ids from 0 again) keeps its own records."""

    writer = "decisions"

    def __init__(self, root: str, outcome_path: str | None = None, now=None, keep_versions: int | None = None,
                 writer: str | None = None):
        self.root, self.outcome_path, self.now, self.keep = root, outcome_path, now, keep_versions
        self.writer = writer or self.writer

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession

        def build(queue: DataFrame | None) -> DataFrame:
            if queue is None:
                raise FileNotFoundError(f"no queue snapshot under {self.root}")
            if self.outcome_path:
                tr.decision_outcome(queue, batch).write.mode("overwrite") \
                  .parquet(f"{self.outcome_path.rstrip('/')}/writer={self.writer}/batch_id={batch_id}")
            return tr.apply_decisions(queue, batch, now=self.now)

        if _write_batch(spark, self.root, self.writer, batch_id, build) and self.keep:
            snapshot_expire(spark, self.root, self.keep)


def stream_writer_name(kind: str, checkpoint: str) -> str:
    """Ledger name of a stream's sink: batch ids restart at 0 under a new
    checkpoint, so the batch records are kept per checkpoint location."""
    import hashlib
    return f"{kind}-{hashlib.sha1(checkpoint.encode('utf-8')).hexdigest()[:12]}"


def _checkpoint(spark: SparkSession, checkpoint: str | None, name: str) -> str:
    """An explicit location, else one under the session's shared checkpoint root."""
    return checkpoint or shared_path(spark, "streams", name)


def start_triage_upsert(risk_stream: DataFrame, root: str, checkpoint: str | None = None, now=None, trigger=None,
                        keep_versions: int | None = 10):
    """Continuously upsert flagged pairs of a gold stream into the queue
    snapshot, keeping the newest ``keep_versions`` versions (None: all)."""
    ckpt = _checkpoint(risk_stream.sparkSession, checkpoint, "triage_upsert")
    sink = TriageSink(root, now, keep_versions=keep_versions, writer=stream_writer_name("upsert", ckpt))
    w = risk_stream.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def start_triage_table_upsert(risk_stream: DataFrame, table: str, location: str | None = None,
                              buckets: int = 64, checkpoint: str | None = None, now=None, trigger=None):
    """Continuously upsert flagged pairs of a gold stream into a bucketed
    queue table (``location``: external data on shared storage)."""
    ckpt = _checkpoint(risk_stream.sparkSession, checkpoint, f"triage_table_{table}")
    sink = TriageTableSink(table, now, buckets=buckets, location=location, writer=stream_writer_name("upsert", ckpt))
    w = risk_stream.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def start_triage_bucket_upsert(risk_stream: DataFrame, root: str, buckets: int = partitions.BUCKETS,
                               checkpoint: str | None = None, now=None, trigger=None):
    """Continuously upsert flagged pairs of a gold stream into a queue of key
    buckets, rewriting only the touched ones."""
    ckpt = _checkpoint(risk_stream.sparkSession, checkpoint, "triage_buckets")
    sink = TriageBucketSink(root, now, buckets=buckets, writer=stream_writer_name("upsert", ckpt))
    w = risk_stream.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def start_session_risk_stream(spark: SparkSession, tx_path: str, login_path: str, queue_root: str,
                              checkpoint: str | None = None, fmt: str = "csv", now=None, delay: str = "2 hours",
                              trigger: dict | None = None, max_files_per_trigger: int | None = None):
    """Landing files -> silver -> stream-stream session join -> gold score ->
    queue upsert, as one streaming query.  Matched pairs flow as soon as both
    sides arrive; transactions without a login are emitted (and may be
    queued) once the login watermark passes their window."""
    risk = _landed_pairs(spark, tx_path, login_path, fmt, delay, max_files_per_trigger)
    return start_triage_upsert(risk, queue_root, checkpoint, now=now, trigger=trigger)


def start_kpi_stream(spark: SparkSession, tx_path: str, login_path: str, sink_path: str,
                     checkpoint: str | None = None, fmt: str = "csv", delay: str = "2 hours", trigger: dict | None = None,
                     max_files_per_trigger: int | None = None):
    """Landing files -> silver -> stream-stream join -> score -> hourly KPI
    window, appended to Parquet as each hour closes (two stateful operators in
    one query; event time is carried through the join)."""
    risk = _landed_pairs(spark, tx_path, login_path, fmt, delay, max_files_per_trigger)
    w = (stream_kpis(risk, delay=None).writeStream.format("parquet").option("path", sink_path)
         .option("checkpointLocation", _checkpoint(spark, checkpoint, "kpi_stream")).outputMode("append"))
    return w.trigger(**trigger).start() if trigger else w.start()
