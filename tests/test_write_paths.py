"""Constraints, quarantine, touched buckets, load counts and table properties."""
import os

import pytest
from pyspark.sql import functions as F

from riskweave.operators import gold, quality, triage as tr
from riskweave.plans import medallion, review
from riskweave.plans.registry import inputs_for
from riskweave.sources import partitions as pq, readers, rejects, schemas, writers
from riskweave.streaming import pipeline as sp
from tests.conftest import SF_SMALL


def _bad_risk(spark):
    """The fixture pairs, a tenth of the users and some amounts and ids gone."""
    i = inputs_for(spark, SF_SMALL)
    h = F.pmod(F.hash("transaction_id"), F.lit(10))
    return i, i.risk.withColumns({"user_id": F.when(h != 3, F.col("user_id")), "amount": F.when(h != 4, F.col("amount")),
                                  "risk_level": F.when(h != 5, F.col("risk_level")).otherwise(F.lit("odd"))})


def _files(root):
    return {os.path.join(d, n) for d, _, names in os.walk(root) for n in names if n.endswith(".parquet")}


def _as_rows(df, cols=None):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=str)


@pytest.mark.parametrize("path", ["sync", "table", "buckets", "stream", "stream table", "stream buckets"])
def test_every_queue_write_sets_rejects_aside(spark, tmp_dir, path):
    i, risk = _bad_risk(spark)
    root, at = os.path.join(tmp_dir, "queue"), os.path.join(tmp_dir, "rejects")
    name = "rw_rejects_" + path.replace(" ", "_")
    batch = review.queue_batch(risk)
    judged = quality.validate_triage(batch.withColumn("analyst_decision", F.lit(None).cast("string")))
    want = {tuple(r) for r in judged.where("NOT is_valid").select("transaction_id", F.array_join("violations", ",")).collect()}
    assert len(want) > 10
    for _ in range(2):  # a replay or second sync repeats nothing in the queue
        if path == "sync":
            review.sync_queue(spark, risk, root, now=i.now, rejects=at)
        elif path == "table":
            review.sync_queue_table(spark, risk, name, now=i.now, buckets=4, rejects=at, location=root)
        elif path == "buckets":
            review.sync_queue_buckets(spark, risk, root, now=i.now, buckets=8, rejects=at)
        elif path == "stream":
            sp.TriageSink(root, now=i.now, rejects=at)(risk, 0)
        elif path == "stream table":
            sp.TriageTableSink(name, now=i.now, buckets=4, rejects=at, location=root)(risk, 0)
        else:
            sp.TriageBucketSink(root, now=i.now, buckets=8, rejects=at)(risk, 0)
    queue = spark.table(name) if "table" in path else pq.queue(spark, root) if "buckets" in path else writers.snapshot_read(spark, root)
    kept = {r[0] for r in queue.select("transaction_id").collect()}
    assert kept == {r[0] for r in judged.where("is_valid").select("transaction_id").collect()}
    got = rejects.rejected(spark, at, batch.schema)
    runs = {r[0] for r in got.select("run").distinct().collect()}
    assert len(runs) == (1 if "stream" in path else 2)
    assert {tuple(r) for r in got.select("transaction_id", F.array_join("violations", ",")).collect()} == want
    assert got.count() == len(want) * len(runs)
    assert not [d for d, _, _ in os.walk(at) if d.endswith("is_valid=true")]


def test_counts_of_the_split_equal_the_validation(spark, tmp_dir):
    _, risk = _bad_risk(spark)
    batch = review.queue_batch(risk)
    c = rejects.check(batch, os.path.join(tmp_dir, "r"), "one")
    judged = quality.validate_triage(batch.withColumn("analyst_decision", F.lit(None).cast("string")))
    per = {r[0]: r[1] for r in judged.select(F.explode("violations").alias("v")).groupBy("v").count().collect()}
    valid = judged.where("is_valid").count()
    assert c.counts == {"rows": judged.count(), "accepted": valid, "rejected": judged.count() - valid} | per and len(per) == 3
    assert c.accepted.columns == batch.columns and c.accepted.count() == valid and c.rejected.count() == c.counts["rejected"]
    assert set(quality.TRIAGE_CONSTRAINTS) == {n for n, _ in quality._triage_checks()}
    empty = rejects.check(batch.limit(0), os.path.join(tmp_dir, "r"), "none")
    assert empty.counts == {"rows": 0, "accepted": 0, "rejected": 0} and empty.accepted.count() == 0


def test_batch_run_writes_rejects(spark, tmp_dir):
    i = inputs_for(spark, SF_SMALL)
    tx = i.bronze_tx.withColumn("merchant_category", F.col("merchant_category"))
    paths = medallion.run_batch(spark, tx, i.bronze_logins, os.path.join(tmp_dir, "run"), now=i.now)
    at = rejects.reject_root(paths["triage"])
    assert rejects.rejected(spark, at, review.queue_batch(i.risk).schema).count() == 0
    assert writers.snapshot_read(spark, paths["triage"]).count() == 87


# --- touched buckets ---------------------------------------------------------------

def test_bucket_queue_equals_the_snapshot_queue(spark, tmp_dir):
    i = inputs_for(spark, SF_SMALL)
    whole, root = os.path.join(tmp_dir, "whole"), os.path.join(tmp_dir, "buckets")
    parts = [i.risk.filter(f"pmod(hash(transaction_id), 3) = {k}") for k in range(3)]
    for n, part in enumerate([*parts, parts[1]]):
        sp.TriageSink(whole, now=i.now)(part, n)
        sp.TriageBucketSink(root, now=i.now, buckets=16)(part, n)
    plain = writers.snapshot_read(spark, whole)
    got = pq.queue(spark, root)
    assert got.columns == plain.columns and got.count() == 87
    assert _as_rows(got) == _as_rows(plain)
    # decisions close rows, which leave the open partition, and are found all the same
    pq.decide(spark, i.decisions, root, now=i.now)
    assert _as_rows(pq.queue(spark, root)) == _as_rows(tr.apply_decisions(plain, i.decisions, now=i.now))
    opened = pq.queue(spark, root, closed=False)
    assert opened.where("analyst_decision IS NOT NULL").count() == 0
    pq.archive(spark, root, now=i.now)
    assert _as_rows(pq.queue(spark, root)) == _as_rows(tr.apply_decisions(plain, i.decisions, now=i.now))
    live = F.col("analyst_decision").isNull() & (F.col("expires_at") > i.now)
    assert pq.queue(spark, root, closed=False).count() == pq.queue(spark, root).where(live).count()
    # a new score for closed rows changes them in place, nothing is inserted twice
    higher = plain.withColumn("risk_score", F.lit(100)).drop("analyst_decision")
    pq.upsert(spark, higher, root, now=i.now, only_if_higher=True)
    after = pq.queue(spark, root)
    assert after.count() == 87 and after.where("risk_score = 100").count() == 87
    assert after.where("analyst_decision IS NOT NULL").count() == 36


def test_a_change_rewrites_only_its_buckets(spark, tmp_dir):
    root = os.path.join(tmp_dir, "q")
    base = tr.with_triage_defaults(spark.range(2000).select(
        F.concat(F.lit("t"), "id").alias("transaction_id"), F.lit(50).alias("risk_score"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("created_at")))
    assert pq.upsert(spark, base, root, now="2024-01-01 01:00:00", buckets=64) == 64
    before, size = _files(root), sum(map(os.path.getsize, _files(root)))
    one = base.where("transaction_id IN ('t1', 't2')").withColumn("risk_score", F.lit(60))
    assert pq.upsert(spark, one, root, now="2024-01-01 02:00:00", only_if_higher=True) == 2
    fresh = _files(root) - before
    assert len(fresh) == 2 and len(before - _files(root)) == 2  # two buckets, one file each
    assert sum(map(os.path.getsize, fresh)) < 0.1 * size
    rows = pq.queue(spark, root)
    assert rows.count() == 2000 and rows.where("risk_score = 60").count() == 2
    decisions = spark.createDataFrame([("t5", "a", "APPROVE", None, None), ("none", "a", "APPROVE", None, None)],
                                      schemas.DECISIONS)
    before = _files(root)
    pq.decide(spark, decisions, root, now="2024-01-01 03:00:00")
    fresh = _files(root) - before
    assert len(fresh) == 3 and any("part=2024-01-01" in f for f in fresh)
    assert pq.queue(spark, root, closed=False).count() == 1999 and pq.queue(spark, root).count() == 2000
    # a second closed row of the same day and bucket joins the first
    t5 = pq.bucket_of(F.lit("t5"), 64)
    mate = pq.read(spark, root).where((F.col("bucket") == t5) & (F.col("part") == "open")).first()["transaction_id"]
    pq.decide(spark, spark.createDataFrame([(mate, "a", "ESCALATE", None, None)], schemas.DECISIONS), root, now="2024-01-01 04:00:00")
    closed = pq.read(spark, root).where("part <> 'open'")
    assert sorted(r[0] for r in closed.select("transaction_id").collect()) == sorted(["t5", mate])
    # the day after everything is closed, bucket by bucket, and open partitions read as empty
    pq.archive(spark, root, now="2024-01-03 00:00:00")
    assert pq.queue(spark, root, closed=False).count() == 0 and pq.queue(spark, root).count() == 2000
    assert pq.archive(spark, root, now="2024-01-03 00:00:00") == 0


def test_lookup_reads_one_bucket_with_the_id_pushed_down(spark, tmp_dir):
    root = os.path.join(tmp_dir, "q")
    assert pq.lookup(spark, root, "t7").count() == 0 and pq.queue(spark, root).count() == 0
    base = tr.with_triage_defaults(spark.range(300).select(F.concat(F.lit("t"), "id").alias("transaction_id"), F.lit(50).alias("risk_score")))
    pq.upsert(spark, base, root, buckets=16)
    found = pq.lookup(spark, root, "t7")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(transaction_id,t7)" in plan and "PartitionFilters: [isnotnull(bucket" in plan
    assert [r.transaction_id for r in found.collect()] == ["t7"] and pq.lookup(spark, root, "nope").count() == 0


# --- malformed lines -----------------------------------------------------------------

HEAD = ",".join(schemas.TRANSACTIONS.names)
GOOD = "TXN-{0},USR-1,4000-1,2024-01-01T00:00:00.000Z,12.5,USD,M,Shop,retail,purchase,web,NY,US,40.7,-74.0,tablet,false,false"


def test_broken_lines_are_kept_with_their_text_and_counted(spark, tmp_dir):
    csv = os.path.join(tmp_dir, "tx.csv")
    broken = [GOOD.format("b1").replace("12.5", "twelve"), GOOD.format("b2").replace("2024-01-01T00:00:00.000Z", "yesterday"),
              GOOD.format("b3") + ",one,field,too,many", "TXN-b4,USR-1", GOOD.format("b5").replace("false", "maybe", 1)]
    lines = [HEAD, *(GOOD.format(k) for k in range(20)), *broken, GOOD.format("last").replace("12.5", "")]
    with open(csv, "w") as f:
        f.write("\n".join(lines) + "\n")
    b = readers.load_bronze(spark, csv, schemas.TRANSACTIONS, os.path.join(tmp_dir, "bronze"), now="2024-01-31 00:00:00")
    assert (b.rows, b.malformed) == (26, 5) and b.good.count() == 21
    assert sorted(r.line for r in b.quarantine.collect()) == sorted(broken)
    assert all(r.source_file.endswith("tx.csv") for r in b.quarantine.collect())
    assert b.good.columns == [*schemas.TRANSACTIONS.names, "ingestion_timestamp"]
    # an empty amount is a null, not a broken line; asking for few columns changes nothing
    assert b.good.where("amount IS NULL").select("transaction_id").first()[0] == "TXN-last"
    logins = os.path.join(tmp_dir, "lg")
    inputs_for(spark, SF_SMALL).bronze_logins.drop("ingestion_timestamp").write.option("header", "true").csv(logins)
    root = os.path.join(tmp_dir, "run")
    paths = medallion.run_from_csv(spark, csv, logins, root, now="2024-01-31 00:00:00")
    assert spark.read.parquet(paths["silver_transactions"]).count() == 20  # an amount is needed
    assert spark.read.parquet(paths["bronze_transactions"]).where("malformed = 'true'").count() == 5


# --- counts, comments, progress --------------------------------------------------------

def test_stored_counts_read_no_data_column(spark, tmp_dir):
    paths = {}
    for n, size in (("a", 1000), ("b", 7)):
        paths[n] = os.path.join(tmp_dir, n)
        spark.range(size).withColumn("text", F.lit("x" * 50)).write.parquet(paths[n])
    counts = writers.stored_counts(spark, paths)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<>") == 2 and plan.count("ReadSchema") == 2
    assert {r.table_name: r.row_count for r in counts.collect()} == {"a": 1000, "b": 7}


def test_layers_are_described_in_the_catalog(spark, tmp_dir):
    i = inputs_for(spark, SF_SMALL)
    paths = medallion.run_batch(spark, i.bronze_tx, i.bronze_logins, os.path.join(tmp_dir, "run"), now=i.now,
                                partition_gold_by_date=True)
    spark.sql("CREATE DATABASE IF NOT EXISTS rw_layers")
    for _ in range(2):
        names = medallion.publish_datasets(spark, paths, "rw_layers")
    assert len(names) == 5 and set(names) == {f"rw_layers.{n}" for n in paths if n in medallion.DATASETS}
    for name in names:
        layer, text = medallion.DATASETS[name.split(".")[1]]
        told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
        assert told["Comment"] == text and f"quality={layer}" in told["Table Properties"]
        assert spark.table(name).count() == spark.read.parquet(paths[name.split(".")[1]]).count() > 0
    writers.publish_table(spark, paths["silver_transactions"], "rw_layers.quoted", r"it's a \ table", {"a'b": "c"})
    told = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE EXTENDED rw_layers.quoted").collect()}
    assert told["Comment"] == r"it's a \ table"


def test_load_counts_beyond_the_progress_a_query_keeps(spark, tmp_dir):
    land = os.path.join(tmp_dir, "land")
    spark.range(1100).repartition(110).write.parquet(land)
    args = (spark, land, spark.range(1).schema, os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "c"))
    got = readers.load_incremental(*args, fmt="parquet", max_files_per_trigger=1)
    assert (got.batches, got.rows) == (110, 1100) and spark.read.parquet(args[3]).count() == 1100
    assert readers.load_incremental(*args, fmt="parquet") == readers.Loaded(0, 0)
    spark.range(5).coalesce(1).write.mode("append").parquet(land)
    assert readers.load_incremental(*args, fmt="parquet") == readers.Loaded(1, 5)
