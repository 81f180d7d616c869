"""End-to-end batch run: bronze -> silver -> gold -> KPIs / wire-after-MFA ->
review-queue snapshot, each layer written once and read back by its
consumers (the lineage cut; nothing is recomputed per action).

Layout under ``root`` (shared storage, e.g. under ``spark.checkpoint.dir``):
``silver_transactions/``, ``silver_login_logs/``, ``gold_user_session_risk/``
(optionally partitioned by transaction date),
``gold_fraud_kpis/``, ``gold_wire_after_mfa_change/`` and ``triage/`` (versioned).
"""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators import gold, kpis, silver
from riskweave.plans.review import sync_queue
from riskweave.sources import schemas
from riskweave.sources.writers import publish_table, write_table


# Named tables of the batch run: layer and description (table comments).
DATASETS = {
    "bronze_transactions": ("bronze", "Transactions as they landed, one row per CSV record"),
    "bronze_login_logs": ("bronze", "Logins as they landed, one row per CSV record"),
    "silver_transactions": ("silver", "Cleaned transactions with masked PII and derived features"),
    "silver_login_logs": ("silver", "Cleaned login logs with masked IP and anomaly features"),
    "gold_user_session_risk": ("gold", "Transactions paired with logins in the hour before, scored for fraud risk"),
    "gold_fraud_kpis": ("gold", "Counts, amounts and false-positive share per hour, level and action"),
    "gold_wire_after_mfa_change": ("gold", "Wire transfers over 10,000 within 24 hours after an MFA change"),
}


def _together(*jobs) -> list:
    """Run independent write jobs concurrently (Spark schedules their stages
    side by side on the same executors, filling the cores one job's tail
    leaves idle); returns their results and re-raises the first failure."""
    if len(jobs) == 1:
        return [jobs[0]()]
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = [pool.submit(j) for j in jobs]
        return [f.result() for f in futures]


def run_batch(spark: SparkSession, bronze_tx: DataFrame, bronze_logins: DataFrame, root: str,
              now=None, strategy: str = "bucketed", partition_gold_by_date: bool = False) -> dict[str, str]:
    """``partition_gold_by_date``: write the pair table partitioned by
    transaction date, for deployments whose reports filter on recent days (the
    certified reports scan every day, so it is off by default and each task
    writes one file).  Layers that do not depend on each other are written
    concurrently; every write overwrites its own path, so a rerun after a
    failure starts clean."""
    paths = {k: os.path.join(root, k) for k in (
        "silver_transactions", "silver_login_logs", "gold_user_session_risk", "gold_fraud_kpis",
        "gold_wire_after_mfa_change", "triage")}
    _together(lambda: write_table(silver.silver_transactions(bronze_tx), paths["silver_transactions"]),
              lambda: write_table(silver.silver_login_logs(bronze_logins), paths["silver_login_logs"]))
    s_tx = spark.read.parquet(paths["silver_transactions"])
    s_lg = spark.read.parquet(paths["silver_login_logs"])

    risk = gold.session_risk(s_tx, s_lg, strategy=strategy)
    if partition_gold_by_date:
        risk = risk.withColumn("tx_date", F.to_date("tx_timestamp")).sortWithinPartitions("tx_date")
        write_risk = lambda: write_table(risk, paths["gold_user_session_risk"], partition_by=["tx_date"])
    else:
        write_risk = lambda: write_table(risk, paths["gold_user_session_risk"])
    _together(write_risk, lambda: write_table(gold.wire_after_mfa(s_tx, s_lg, strategy=strategy),
                                              paths["gold_wire_after_mfa_change"]))
    g = spark.read.parquet(paths["gold_user_session_risk"])
    g_pairs = g.drop("tx_date") if "tx_date" in g.columns else g
    _together(lambda: write_table(kpis.fraud_kpis(g), paths["gold_fraud_kpis"]),
              lambda: sync_queue(spark, g_pairs, paths["triage"], now=now))
    return paths


def publish_datasets(spark: SparkSession, paths: dict[str, str], database: str = "default") -> list[str]:
    """The written layers as catalog tables, with the description and the layer
    (property ``quality``) of ``DATASETS``; returns their names."""
    names = []
    for name, (layer, description) in DATASETS.items():
        if name in paths:
            publish_table(spark, paths[name], f"{database}.{name}", description, {"quality": layer})
            names.append(f"{database}.{name}")
    return names


def run_from_csv(spark: SparkSession, transactions_csv: str, logins_csv: str, root: str, now=None,
                 infer_schema: bool = False, **kwargs) -> dict[str, str]:
    """Bronze CSV landing files -> every layer under ``root`` (see ``run_batch``).
    Lines that do not fit the schema are kept with their text under
    ``bronze_<name>/malformed=true`` and leave the run there (with
    ``infer_schema`` the types follow the files, and nothing is set aside)."""
    from riskweave.sources import readers
    if infer_schema:
        return run_batch(spark, readers.read_transactions(spark, transactions_csv, now=now, infer=True),
                         readers.read_login_logs(spark, logins_csv, now=now, infer=True), root, now=now, **kwargs)
    loads = {"bronze_transactions": (transactions_csv, schemas.TRANSACTIONS), "bronze_login_logs": (logins_csv, schemas.LOGIN_LOGS)}
    at = {name: os.path.join(root, name) for name in loads}
    tx, lg = _together(*[lambda n=n, c=c, sch=sch: readers.load_bronze(spark, c, sch, at[n], now=now) for n, (c, sch) in loads.items()])
    return at | run_batch(spark, tx.good, lg.good, root, now=now, **kwargs)
