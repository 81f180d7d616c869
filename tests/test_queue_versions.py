"""Late and dead writers of the versioned queue, and the bucketed switch at each step."""
import os

import pytest
from pyspark.sql import functions as F

from riskweave.operators import triage as tr
from riskweave.sources import writers as W
from riskweave.streaming import pipeline as sp

QUEUE = "transaction_id string, risk_score int"


def rows(spark, *ids):
    return tr.with_triage_defaults(spark.createDataFrame([(i, 50) for i in ids], QUEUE), "2024-01-01 00:00:00")


def ids(df):
    return sorted(r[0] for r in df.select("transaction_id").collect())


def publish(spark, root, n, keep=None):
    for k in range(n):
        W.snapshot_update(spark, root, lambda cur, _: (cur.unionByName(rows(spark, f"other{k}")) if cur else rows(spark, "other")))
    if keep:
        W.snapshot_expire(spark, root, keep)


def test_late_update_after_retention_is_built_again(spark, tmp_dir):
    root = os.path.join(tmp_dir, "q")
    publish(spark, root, 1)
    bases = []

    def late(current, base):
        if not bases:  # four versions come, and the base goes, while this one is built
            current = spark.createDataFrame(current.collect(), current.schema)
            publish(spark, root, 4, keep=2)
        bases.append(base)
        return current.unionByName(rows(spark, "late"))

    W.snapshot_update(spark, root, late)
    assert bases == [1, 5] and W.snapshot_versions(spark, root) == [4, 5, 6]
    assert "late" in ids(W.snapshot_read(spark, root)) and "other3" in ids(W.snapshot_read(spark, root))


def test_late_write_of_a_freed_number_is_refused(spark, tmp_dir):
    root = os.path.join(tmp_dir, "q")
    publish(spark, root, 5, keep=2)
    before = sorted(n for n in os.listdir(root) if n.startswith("v="))
    with pytest.raises(W.VersionTaken):
        W.snapshot_write(rows(spark, "late"), root, version=2, base=1, tag="w:0")
    assert W.snapshot_versions(spark, root) == [4, 5] and sorted(n for n in os.listdir(root) if n.startswith("v=")) == before
    # a marker that a crash left behind between create and second look does not count
    W._publish(spark, W._tag_path(root, 2), "v=gone\nw:0")
    assert W.snapshot_versions(spark, root) == [4, 5] and not W.snapshot_published(spark, root, "w:0")


@pytest.mark.parametrize("kind", ["upsert", "decisions"])
def test_sinks_overtaken_across_retention_keep_their_batch(spark, tmp_dir, kind, monkeypatch):
    root = os.path.join(tmp_dir, "q")
    W.snapshot_write(rows(spark, "a", "b"), root)
    built = []

    def overtaken(plain):
        def run(queue, *args, **kwargs):
            if not built:
                queue = spark.createDataFrame(queue.collect(), queue.schema)
                publish(spark, root, 4, keep=2)
            built.append(1)
            return plain(queue, *args, **kwargs)
        return run

    if kind == "upsert":
        monkeypatch.setattr(sp.tr, "upsert", overtaken(tr.upsert))
        sink = sp.TriageSink(root, now="2024-01-01 00:00:00")
        monkeypatch.setattr(sp.tr, "to_triage", lambda *a, **k: spark.createDataFrame([("late", "u", 1.0, 60, "HIGH", "BLOCK")], SRC))
        monkeypatch.setattr(sp.gold, "dedupe_per_transaction", lambda b: b)
        batch = spark.range(1)
        done = lambda q: "late" in ids(q)
    else:
        monkeypatch.setattr(sp.tr, "apply_decisions", overtaken(tr.apply_decisions))
        sink = sp.DecisionSink(root, now="2024-01-01 00:00:00")
        batch = spark.createDataFrame([("a", "x", "APPROVE", None, None)],
                                      "transaction_id string, analyst_id string, decision string, notes string, decided_at timestamp")
        done = lambda q: q.where("transaction_id = 'a'").first()["analyst_decision"] == "APPROVE"
    sink(batch, 0)
    assert len(built) == 2 and done(W.snapshot_read(spark, root)) and "other3" in ids(W.snapshot_read(spark, root))
    newest = W.snapshot_current_version(spark, root)
    sink(batch, 0)  # a replay is a no-op
    assert W.snapshot_current_version(spark, root) == newest


SRC = "transaction_id string, user_id string, amount double, risk_score int, risk_level string, automated_action string"


def test_a_writer_that_dies_inside_the_create_is_stepped_over(spark, tmp_dir, monkeypatch):
    root = os.path.join(tmp_dir, "q")
    publish(spark, root, 2)
    W._publish(spark, W._tag_path(root, 3), "")
    assert W.snapshot_versions(spark, root) == [1, 2] and W.snapshot_next_version(spark, root) == 3
    monkeypatch.setattr(W, "PUBLISH_TRIES", 2)
    with pytest.raises(W.VersionTaken):  # it may still be writing
        publish(spark, root, 1)
    monkeypatch.setattr(W, "STALE_SECONDS", 0.0)
    publish(spark, root, 2)
    assert W.snapshot_versions(spark, root) == [1, 2, 4, 5] and "other1" in ids(W.snapshot_read(spark, root))
    W.snapshot_expire(spark, root, 1)
    assert W.snapshot_versions(spark, root) == [5]


def test_switch_survives_a_crash_at_each_step(spark, tmp_dir):
    loc, name = os.path.join(tmp_dir, "tbl"), "rw_switch_test"
    table = lambda: ids(W.read_bucketed(spark, name))
    swap = lambda *i: W.swap_bucketed(rows(spark, *i), name, "transaction_id", 4, loc)
    swap("a")
    other = os.path.join(loc, "v=crashed")
    # died after writing the next content: the old one is read, the next swap works
    rows(spark, "x").write.bucketBy(4, "transaction_id").sortBy("transaction_id").option("path", other).saveAsTable(name + "__next")
    assert table() == ["a"]
    swap("a", "b")
    assert table() == ["a", "b"] and not spark.catalog.tableExists(name + "__next")
    # died after the switch, before the helper name was dropped
    path = os.path.join(loc, "v=switched")
    rows(spark, "c").write.bucketBy(4, "transaction_id").sortBy("transaction_id").option("path", path).saveAsTable(name + "__next")
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(name)
    assert table() == ["c"]
    merged = W.read_bucketed(spark, name).unionByName(rows(spark, "d"))  # built on the content it replaces
    W.swap_bucketed(merged, name, "transaction_id", 4, loc)
    assert table() == ["c", "d"] and len([n for n in os.listdir(loc) if n.startswith("v=")]) == 2
    # another number of buckets is replaced as a whole
    W.swap_bucketed(rows(spark, "e"), name, "transaction_id", 2, loc)
    assert table() == ["e"] and W._bucket_layout(spark, name) == ("EXTERNAL", "2")
    spark.sql(f"DROP TABLE {name}")
    W.swap_bucketed(rows(spark, "f"), name, "transaction_id", 2)
    W.swap_bucketed(W.read_bucketed(spark, name).unionByName(rows(spark, "g")), name, "transaction_id", 2)
    assert table() == ["f", "g"]
    one = rows(spark, "f").select("transaction_id", F.lit(1).alias("k"))
    joined = spark.table(name).hint("merge").join(one, "transaction_id")
    assert "Bucketed: true" in joined._jdf.queryExecution().executedPlan().toString() and ids(joined) == ["f"]
