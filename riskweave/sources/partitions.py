"""Review queue as a Parquet table of key buckets, of which a change rewrites
only the touched ones.

Layout: ``<root>/part=<open | created day>/bucket=<n>/``.  Open rows lie under
``part=open``; rows that are decided or expired move to the day they were
created.  A change reads the open buckets of its keys (partition pruning), and
of the closed rows only the ids in those buckets; what it writes is the touched
open buckets and the (day, bucket) partitions that receive or hold a changed
closed row, by Spark's dynamic partition overwrite.  Bytes written follow the
change, not the queue.

A partition left without rows would not be overwritten, so every written open
bucket carries one row without an id, which readers drop (ids are never null:
``operators.quality``).  A commit replaces partition after partition: a job that
dies in it leaves some buckets new and some old, and its rerun (or the stream's
replay) completes it, as the change applied twice equals the change applied
once.  Jobs that change one table take turns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.operators import triage as tr
from riskweave.session import ensure_checkpoint_dir
from riskweave.sources.schemas import TRIAGE
from riskweave.sources.writers import get_text, put_text

BUCKETS = 1024
OPEN = "open"
_SCHEMA = T.StructType([*TRIAGE.fields, T.StructField("part", T.StringType()), T.StructField("bucket", T.IntegerType())])


def bucket_of(key: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def bucket_count(spark: SparkSession, root: str, buckets: int | None = None) -> int | None:
    """The number of buckets the table was made with; a new table gets ``buckets``."""
    known = get_text(spark, f"{root}/_buckets")
    if known is None and buckets:
        put_text(spark, f"{root}/_buckets", str(buckets))
        return buckets
    return int(known) if known else None


def read(spark: SparkSession, root: str) -> DataFrame | None:
    """All rows, with ``part`` and ``bucket``; None where no table is yet."""
    if bucket_count(spark, root) is None:
        return None
    return spark.read.schema(_SCHEMA).parquet(root).where("transaction_id IS NOT NULL")


def queue(spark: SparkSession, root: str, closed: bool = True) -> DataFrame:
    """The queue's rows; without ``closed`` only the open partition is listed."""
    rows = read(spark, root)
    if rows is None:
        return tr.empty_triage(spark)
    return (rows if closed else rows.where(F.col("part") == OPEN)).drop("part", "bucket")


def lookup(spark: SparkSession, root: str, transaction_id: str) -> DataFrame:
    """One transaction: its bucket alone is read, with the id pushed to the files."""
    rows = read(spark, root)
    if rows is None:
        return tr.empty_triage(spark)
    wanted = F.lit(transaction_id)
    return rows.where((F.col("bucket") == bucket_of(wanted, bucket_count(spark, root)))
                      & (F.col("transaction_id") == wanted)).drop("part", "bucket")


def _part(now: Column) -> Column:
    closed = F.col("analyst_decision").isNotNull() | F.coalesce(F.col("expires_at") <= now, F.lit(False))
    return F.when(closed, F.coalesce(F.date_format("created_at", "yyyy-MM-dd"), F.lit("unknown"))).otherwise(F.lit(OPEN))


def change(spark: SparkSession, root: str, ids: DataFrame, build: Callable[[DataFrame | None], DataFrame], now=None,
           buckets: int = BUCKETS) -> int:
    """Replace the rows of the buckets of ``ids(transaction_id)`` by
    ``build(their open rows and the closed rows among ids)``; the number of open
    buckets rewritten.  ``build`` is given None while there is no table."""
    ensure_checkpoint_dir(spark)
    stored, known = read(spark, root), bucket_count(spark, root)
    n = known or buckets
    wanted = ids.select("transaction_id", bucket_of("transaction_id", n).alias("bucket")).checkpoint()
    touched = [r["bucket"] for r in wanted.select("bucket").distinct().collect()]
    if not touched:
        return 0
    current = None
    if stored is not None:
        near = stored.where(F.col("bucket").isin(touched))
        again = near.where(F.col("part") != OPEN).join(wanted.select("transaction_id"), "transaction_id", "left_semi")
        current = near.where(F.col("part") == OPEN).unionByName(again).drop("part", "bucket")
    at = tr._now(now)
    made = build(current).withColumns({"bucket": bucket_of("transaction_id", n), "part": _part(at)}).checkpoint()
    out = made
    moved = made.where(F.col("part") != OPEN).select("part", "bucket").distinct()
    if stored is not None:
        parts, places = [r["part"] for r in moved.select("part").distinct().collect()], ["part", "bucket"]
        stay = (stored.where(F.col("part").isin(parts) & F.col("bucket").isin(touched)).join(moved, places, "left_semi")
                .join(made.select("transaction_id"), "transaction_id", "left_anti"))
        out = out.unionByName(stay.select(*out.columns))
    marks = spark.createDataFrame([(b,) for b in touched], "bucket int").withColumn("part", F.lit(OPEN))
    out = out.unionByName(marks, allowMissingColumns=True)
    (out.repartition("part", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("part", "bucket").parquet(root))
    if known is None:
        bucket_count(spark, root, buckets)
    return len(touched)


def upsert(spark: SparkSession, batch: DataFrame, root: str, now=None, only_if_higher: bool = False,
           buckets: int = BUCKETS) -> int:
    """``triage.upsert`` of a deduplicated batch in the triage layout; a known
    transaction is updated wherever it lies, closed rows included."""
    ensure_checkpoint_dir(spark)
    batch = batch.checkpoint()
    return change(spark, root, batch, lambda rows: tr.upsert(rows, batch, now=now, only_if_higher=only_if_higher), now, buckets)


def decide(spark: SparkSession, decisions: DataFrame, root: str, now=None) -> int:
    """First-wins decisions; decided rows leave the open partition."""
    if read(spark, root) is None:
        raise FileNotFoundError(f"no queue under {root}")
    return change(spark, root, decisions.where("transaction_id IS NOT NULL"),
                  lambda rows: tr.apply_decisions(rows, decisions, now=now), now)


def archive(spark: SparkSession, root: str, now=None) -> int:
    """Move the expired rows that no change has touched since; the number of buckets rewritten."""
    rows = read(spark, root)
    if rows is None:
        return 0
    due = rows.where((F.col("part") == OPEN) & (F.col("expires_at") <= tr._now(now)))
    return change(spark, root, due, lambda current: current, now)
