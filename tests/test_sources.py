"""Sources and sinks: CSV scans, landing count, table writes, snapshots, SQL functions."""
import os

from pyspark.sql import functions as F

from riskweave.functions.sql_functions import register_sql_functions
from riskweave.plans.registry import inputs_for
from riskweave.sources import readers, schemas, writers
from tests.conftest import SF_SMALL

SIGNATURES = [(f"SIG-{i:03d}", p, "d", "HIGH", "rule", 0.05, "2024-01-01", "2024-01-30", i, "text")
              for i, p in enumerate(["rapid_geo_hop", "velocity_spike", "mfa_then_wire", "new_device_large_tx",
                                     "midnight_atm", "round_amount_wire", "bot_typing", "multiple_failed_mfa",
                                     "ip_tor_exit", "account_drain", "sim_swap_pattern", "cross_channel_rapid",
                                     "dormant_reactivation", "credential_stuffing", "card_testing"])]


def test_csv_round_trip_and_landing_count(spark, tmp_dir):
    i = inputs_for(spark, SF_SMALL)
    path = os.path.join(tmp_dir, "tx_csv")
    i.bronze_tx.drop("ingestion_timestamp").write.option("header", "true").csv(path)
    df = readers.read_transactions(spark, path, now="2024-01-31 00:00:00")
    assert df.count() == 600 and df.schema["amount"].dataType == schemas.TRANSACTIONS["amount"].dataType
    inferred = readers.read_transactions(spark, path, infer=True)
    assert inferred.count() == 600
    assert readers.landing_count(spark, path).first().row_count == 600


def test_signatures_scan(spark, tmp_dir):
    path = os.path.join(tmp_dir, "sig")
    spark.createDataFrame(SIGNATURES, schemas.FRAUD_SIGNATURES).write.option("header", "true").csv(path)
    sig = readers.read_signatures(spark, path)
    assert sig.count() == 15 and sig.agg(F.sum("trigger_count_30d")).first()[0] == sum(range(15))


def test_ctas_replace_and_counts(spark, tmp_dir):
    i = inputs_for(spark, SF_SMALL)
    t = writers.ctas(spark, i.silver_logins, "rw_silver_logins_test", comment="silver logins")
    assert t.count() == 400
    r = writers.replace_table(spark, i.silver_logins.limit(10), "rw_silver_logins_test")
    assert r.count() == 10
    counts = {x.table_name: x.row_count for x in writers.table_counts({"a": i.bronze_tx, "b": i.bronze_logins}).collect()}
    assert counts == {"a": 600, "b": 400}


def test_snapshots_versioned_and_readable_while_writing(spark, tmp_dir):
    root = os.path.join(tmp_dir, "snap")
    assert writers.snapshot_current(spark, root) is None
    v1 = writers.snapshot_write(spark.range(5), root)
    cur = writers.snapshot_read(spark, root)
    v2 = writers.snapshot_write(cur.union(spark.range(5, 8)), root, buckets=2, key="id")
    assert v1 != v2 and writers.snapshot_read(spark, root).count() == 8
    assert spark.read.parquet(v1).count() == 5


def test_sql_mask_functions(spark):
    register_sql_functions(spark)
    r = spark.sql("SELECT mask_card_number('4000123456789012') AS c, mask_ip_address('10.1.2.3') AS i").first()
    assert (r.c, r.i) == ("****-****-****-9012", "10.1.xxx.xxx")


def test_batch_plan_writes_layers(spark, tmp_dir):
    from riskweave.plans.medallion import run_batch
    i = inputs_for(spark, SF_SMALL)
    paths = run_batch(spark, i.bronze_tx, i.bronze_logins, os.path.join(tmp_dir, "run"), now=i.now)
    assert spark.read.parquet(paths["gold_user_session_risk"]).count() == 596
    assert spark.read.parquet(paths["gold_wire_after_mfa_change"]).count() == 10
    assert writers.snapshot_read(spark, paths["triage"]).count() == 87


def test_review_jobs_version_by_version(spark, tmp_dir):
    from riskweave.operators import gold, scorer
    from riskweave.plans import review
    i = inputs_for(spark, SF_SMALL)
    root = os.path.join(tmp_dir, "queue")
    review.sync_queue(spark, i.risk, root, now=i.now)
    assert writers.snapshot_versions(spark, root) == [1]
    path, outcome = review.apply_decision_batch(spark, i.decisions, root, now=i.now)
    assert writers.snapshot_versions(spark, root) == [1, 2]
    assert outcome.filter("status = 'applied'").count() == 36
    records = gold.with_risk(scorer.scorer_records(i.silver_tx, i.silver_logins))
    review.explain_queue(spark, records, root, now=i.now)
    q = writers.snapshot_read(spark, root)
    assert q.count() == 87 and q.filter("explanation = ''").count() == 0
    assert q.filter("analyst_decision IS NOT NULL").count() == 36
    review.sync_queue(spark, i.risk, root, now=i.now)  # a rerun keeps decisions and texts
    q = writers.snapshot_read(spark, root)
    assert q.filter("analyst_decision IS NOT NULL").count() == 36 and q.filter("explanation = ''").count() == 0


def test_batch_plan_date_partitioned_gold(spark, tmp_dir):
    from riskweave.plans.medallion import run_batch
    i = inputs_for(spark, SF_SMALL)
    paths = run_batch(spark, i.bronze_tx, i.bronze_logins, os.path.join(tmp_dir, "run"), now=i.now,
                      partition_gold_by_date=True)
    g = spark.read.parquet(paths["gold_user_session_risk"])
    assert g.count() == 596 and "tx_date" in g.columns
    assert writers.snapshot_read(spark, paths["triage"]).count() == 87


def test_bucketed_queue_table_sync_reads_queue_without_shuffle(spark, tmp_dir):
    from riskweave.operators import gold, triage as tr
    from riskweave.plans import review
    from pyspark.sql import functions as F
    i = inputs_for(spark, SF_SMALL)
    loc = os.path.join(tmp_dir, "queue_tbl")
    q = review.sync_queue_table(spark, i.risk, "rw_queue_test", now=i.now, buckets=8, location=loc)
    assert q.count() == 87
    batch = tr.to_triage(gold.dedupe_per_transaction(i.risk), created_at=F.col("tx_timestamp"))
    plan = tr.upsert(spark.table("rw_queue_test"), batch, now=i.now)._jdf.queryExecution().executedPlan().toString()
    queue_scan = [l for l in plan.splitlines() if "rw_queue_test" in l][0]
    above = plan.split(queue_scan.strip())[0].splitlines()[-3:]
    assert not any("Exchange" in l for l in above)
    q = review.sync_queue_table(spark, i.risk, "rw_queue_test", now=i.now, buckets=8, location=loc)
    assert q.count() == 87
    # an interrupted swap (table dropped, next kept) is finished on the next read
    spark.sql("ALTER TABLE rw_queue_test RENAME TO rw_queue_test__next")
    assert writers.read_bucketed(spark, "rw_queue_test").count() == 87


def test_uncommitted_version_is_ignored(spark, tmp_dir):
    root = os.path.join(tmp_dir, "snap2")
    writers.snapshot_write(spark.range(3), root)
    # a writer that died mid-job leaves a version directory without _SUCCESS
    os.makedirs(os.path.join(root, "v=000000000002"))
    open(os.path.join(root, "v=000000000002", "part-0000.parquet"), "wb").write(b"partial")
    assert writers.snapshot_versions(spark, root) == [1]
    assert writers.snapshot_read(spark, root).count() == 3
    # the rerun overwrites the abandoned directory and commits it
    writers.snapshot_write(spark.range(5), root)
    assert writers.snapshot_versions(spark, root) == [1, 2] and writers.snapshot_read(spark, root).count() == 5


def test_cli_batch_and_decisions_from_csv(spark, tmp_dir):
    from riskweave.plans import cli
    i = inputs_for(spark, SF_SMALL)
    tx_csv, lg_csv, dec_csv = (os.path.join(tmp_dir, n) for n in ("tx_csv", "lg_csv", "dec_csv"))
    i.bronze_tx.drop("ingestion_timestamp").write.option("header", "true").csv(tx_csv)
    i.bronze_logins.drop("ingestion_timestamp").write.option("header", "true").csv(lg_csv)
    i.decisions.write.option("header", "true").csv(dec_csv)
    out = os.path.join(tmp_dir, "run")
    assert cli.main(["batch", "--transactions", tx_csv, "--logins", lg_csv, "--out", out,
                     "--now", "2024-01-31 00:00:00"]) == 0
    assert spark.read.parquet(os.path.join(out, "gold_user_session_risk")).count() == 596
    assert cli.main(["decisions", "--queue", os.path.join(out, "triage"), "--decisions", dec_csv,
                     "--now", "2024-01-31 00:00:00"]) == 0
    q = writers.snapshot_read(spark, os.path.join(out, "triage"))
    assert q.count() == 87 and q.filter("analyst_decision IS NOT NULL").count() == 36
    outcome = spark.read.parquet(os.path.join(out, "triage", "_outcomes", "v=000000000002"))
    assert outcome.filter("status = 'applied'").count() == 36


def test_decision_batch_rerun_before_commit_is_exact(spark, tmp_dir):
    """The job died after writing the outcomes but before the new queue
    version committed: the rerun recomputes the same outcomes from the same
    base version."""
    from riskweave.plans import review
    i = inputs_for(spark, SF_SMALL)
    root, out = os.path.join(tmp_dir, "queue"), os.path.join(tmp_dir, "outcome")
    review.sync_queue(spark, i.risk, root, now=i.now)
    from riskweave.operators import triage as tr
    tr.decision_outcome(writers.snapshot_read(spark, root), i.decisions).write.parquet(out)  # crashed run
    path, outcome = review.apply_decision_batch(spark, i.decisions, root, now=i.now, outcome_path=out)
    assert writers.snapshot_versions(spark, root) == [1, 2]
    assert outcome.filter("status = 'applied'").count() == 36 and outcome.count() == i.decisions.count()


def test_review_jobs_retention(spark, tmp_dir):
    from riskweave.plans import review
    i = inputs_for(spark, SF_SMALL)
    root = os.path.join(tmp_dir, "queue")
    for _ in range(3):
        review.sync_queue(spark, i.risk, root, now=i.now, keep=2)
    assert writers.snapshot_versions(spark, root) == [2, 3]
    assert writers.snapshot_read(spark, root).count() == 87


def test_two_writers_from_one_version_both_survive(spark, tmp_dir):
    """A job that publishes while another is building is not lost, in either order."""
    from riskweave.operators import gold, triage as tr
    from riskweave.plans import review
    i = inputs_for(spark, SF_SMALL)
    half_a, half_b = (i.risk.filter(f"pmod(hash(transaction_id), 2) = {k}") for k in (0, 1))
    whole = os.path.join(tmp_dir, "whole")
    review.sync_queue(spark, i.risk, whole, now=i.now)
    review.apply_decision_batch(spark, i.decisions, whole, now=i.now)
    ids = {r[0] for r in writers.snapshot_read(spark, whole).select("transaction_id").collect()}
    batch = tr.to_triage(gold.dedupe_per_transaction(half_b), created_at=F.col("tx_timestamp"))
    jobs = {"sync": lambda current, _: tr.upsert(current, batch, now=i.now),
            "decide": lambda current, _: tr.apply_decisions(current, i.decisions, now=i.now)}
    for slow, quick in (("sync", "decide"), ("decide", "sync")):
        root = os.path.join(tmp_dir, slow)
        review.sync_queue(spark, half_a, root, now=i.now)
        first = writers.snapshot_read(spark, root).join(i.decisions, "transaction_id", "left_semi").count()
        bases = []

        def build(current, base):
            if not bases:
                writers.snapshot_update(spark, root, jobs[quick])
            bases.append(base)
            return jobs[slow](current, base)

        writers.snapshot_update(spark, root, build)
        assert bases == [1, 2] and writers.snapshot_versions(spark, root) == [1, 2, 3]
        q = writers.snapshot_read(spark, root)
        assert {r[0] for r in q.select("transaction_id").collect()} == ids and first > 0
        assert q.filter("analyst_decision IS NOT NULL").count() > 0


def test_cli_session_keeps_the_launchers_settings(tmp_dir):
    import subprocess
    import pyspark
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script, ckpt = os.path.join(tmp_dir, "probe.py"), os.path.join(tmp_dir, "ckpt")
    with open(script, "w") as f:
        f.write(f"import sys; sys.path.insert(0, {root!r})\n"
                "from riskweave.plans import cli\n"
                "s = cli._session()\n"
                "print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'),\n"
                "      s.sparkContext.getConf().get('spark.checkpoint.dir'), s.conf.get('spark.sql.session.timeZone'))\n")
    submit = os.path.join(os.path.dirname(pyspark.__file__), "bin", "spark-submit")
    out = subprocess.run([submit, "--master", "local[2]", "--conf", "spark.ui.enabled=false", "--conf",
                          "spark.sql.shuffle.partitions=7", "--conf", f"spark.checkpoint.dir={ckpt}", script],
                         capture_output=True, text=True, timeout=120).stdout
    assert f"GOT local[2] 7 {ckpt} UTC" in out
