"""Review-queue jobs over a materialised gold table.

``sync_queue``      flagged gold pairs -> deduplicated queue rows -> constraint
                    check -> upsert into the queue snapshot (new version).
``apply_decision_batch``  a table of analyst decisions -> first-wins update
                    (new version) and the per-decision outcome table.
``explain_queue``   rows still without an explanation -> long-form texts ->
                    explanation update (new version).

Each job reads the current committed version and publishes the next one, so a
job that dies part-way leaves the queue as it was and can simply be rerun; a
job that another writer overtakes builds again on that writer's version.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators import gold, narrative, triage as tr
from riskweave.session import shared_path
from riskweave.sources import partitions
from riskweave.sources.rejects import check, reject_root
from riskweave.sources.writers import read_bucketed, snapshot_expire, snapshot_update, swap_bucketed


def _queue(current: DataFrame | None, root: str) -> DataFrame:
    if current is None:
        raise FileNotFoundError(f"no queue snapshot under {root}")
    return current


def _retain(spark: SparkSession, root: str, keep: int | None) -> None:
    """Optional retention after a job committed its version (None: keep all)."""
    if keep:
        snapshot_expire(spark, root, keep)


def queue_batch(risk: DataFrame, factors: str = "object", limit: int | None = None) -> DataFrame:
    """Flagged gold pairs as one queue row per transaction."""
    return tr.to_triage(gold.dedupe_per_transaction(risk), factors=factors, created_at=F.col("tx_timestamp"), limit=limit)


def sync_queue(spark: SparkSession, risk: DataFrame, root: str, now=None, factors: str = "object",
               buckets: int | None = None, keep: int | None = None, rejects: str | None = None) -> str:
    """Rows that break a queue constraint go to ``rejects`` (default: beside
    the queue) with their reasons; the others are upserted."""
    checked = check(queue_batch(risk, factors), rejects or reject_root(root), uuid.uuid4().hex)
    path = snapshot_update(spark, root, lambda current, _: tr.upsert(current, checked.accepted, now=now),
                           buckets=buckets, key="transaction_id" if buckets else None)
    checked.publish_done()
    _retain(spark, root, keep)
    return path


def sync_queue_table(spark: SparkSession, risk: DataFrame, table: str, now=None, buckets: int = 64,
                     location: str | None = None, factors: str = "object", rejects: str | None = None) -> DataFrame:
    """``sync_queue`` against a catalog table bucketed by ``transaction_id``:
    the upsert join reads the (large, growing) queue without an exchange and
    shuffles only the incoming batch into the table's buckets."""
    checked = check(queue_batch(risk, factors), rejects or shared_path(spark, "rejects", table), uuid.uuid4().hex)
    merged = tr.upsert(read_bucketed(spark, table), checked.accepted, now=now)
    swap_bucketed(merged, table, "transaction_id", buckets, location)
    checked.publish_done()
    return spark.table(table)


def sync_queue_buckets(spark: SparkSession, risk: DataFrame, root: str, now=None, buckets: int = partitions.BUCKETS,
                       factors: str = "object", rejects: str | None = None) -> int:
    """``sync_queue`` into a table of key buckets (``sources.partitions``), of
    which only the buckets of the batch's transactions are rewritten."""
    checked = check(queue_batch(risk, factors), rejects or reject_root(root), uuid.uuid4().hex)
    touched = partitions.upsert(spark, checked.accepted, root, now=now, buckets=buckets)
    checked.publish_done()
    return touched


def apply_decision_batch(spark: SparkSession, decisions: DataFrame, root: str, now=None,
                         outcome_path: str | None = None, keep: int | None = None) -> tuple[str, DataFrame]:
    """First-wins update as the next version.  With ``outcome_path`` the
    per-decision outcomes are written there first, from the same base
    version, so a rerun after a failure before the commit recomputes both
    exactly."""
    outcome = None

    def build(current: DataFrame | None, _: int) -> DataFrame:
        nonlocal outcome
        outcome = tr.decision_outcome(_queue(current, root), decisions)
        if outcome_path:
            outcome.write.mode("overwrite").parquet(outcome_path)
            outcome = spark.read.parquet(outcome_path)
        return tr.apply_decisions(current, decisions, now=now)

    path = snapshot_update(spark, root, build)
    if outcome_path:  # without it the lazy outcome still reads the base version
        _retain(spark, root, keep)
    return path, outcome


def explain_queue(spark: SparkSession, records: DataFrame, root: str, now=None, keep: int | None = None) -> str:
    """``records``: gold pairs with the scorer's extra fields
    (``scorer.scorer_records`` + ``gold.with_risk``)."""
    known = narrative.explanation_input(gold.dedupe_per_transaction(records))

    def build(current: DataFrame | None, _: int) -> DataFrame:
        todo = tr.missing_explanation(_queue(current, root)).select("transaction_id")
        inputs = known.join(todo, "transaction_id", "left_semi")
        texts = narrative.assessment_long(inputs, now).select("transaction_id", "explanation", "triggered_factors")
        return tr.apply_explanations(current, texts)

    path = snapshot_update(spark, root, build)
    _retain(spark, root, keep)
    return path
