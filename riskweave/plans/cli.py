"""Command line for the batch jobs.

    python -m riskweave.plans.cli batch --transactions T.csv --logins L.csv --out ROOT [--now TS]
    python -m riskweave.plans.cli decisions --queue ROOT/triage --decisions D.csv [--now TS]
    python -m riskweave.plans.cli explain --queue ROOT/triage --transactions T.csv --logins L.csv [--now TS]

Under ``spark-submit`` the launcher's master, sizing and ``spark.checkpoint.dir``
hold; started by plain Python, a ``local[*]`` session is built.
"""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import SparkSession

from riskweave.sources import schemas


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from riskweave.session import build_session, launched_session
    if "PYSPARK_GATEWAY_PORT" in os.environ:  # Python was started by spark-submit
        return launched_session()
    return build_session(master="local[*]")


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="riskweave")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("batch", help="bronze CSV -> silver, gold, KPIs, wire/MFA, queue")
    b.add_argument("--transactions", required=True)
    b.add_argument("--logins", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--now")
    b.add_argument("--infer-schema", action="store_true")
    d = sub.add_parser("decisions", help="apply a decision file to the queue (first wins)")
    d.add_argument("--queue", required=True)
    d.add_argument("--decisions", required=True)
    d.add_argument("--now")
    e = sub.add_parser("explain", help="write the missing explanations of the queue")
    e.add_argument("--queue", required=True)
    e.add_argument("--transactions", required=True)
    e.add_argument("--logins", required=True)
    e.add_argument("--now")
    args = ap.parse_args(argv)
    spark = _session()
    if args.cmd == "batch":
        from riskweave.plans.medallion import run_from_csv
        paths = run_from_csv(spark, args.transactions, args.logins, args.out, now=args.now,
                             infer_schema=args.infer_schema)
        print(json.dumps(paths))
    elif args.cmd == "explain":
        from riskweave.operators import gold, scorer, silver
        from riskweave.plans.review import explain_queue
        from riskweave.sources import readers
        tx = silver.silver_transactions(readers.read_transactions(spark, args.transactions, now=args.now))
        lg = silver.silver_login_logs(readers.read_login_logs(spark, args.logins, now=args.now))
        path = explain_queue(spark, gold.with_risk(scorer.scorer_records(tx, lg)), args.queue, now=args.now)
        print(json.dumps({"queue_version": path}))
    else:
        from riskweave.plans.review import apply_decision_batch
        from riskweave.sources.writers import snapshot_current_version
        dec = spark.read.option("header", "true").schema(schemas.DECISIONS).csv(args.decisions)
        nxt = snapshot_current_version(spark, args.queue) + 1
        out = os.path.join(args.queue, "_outcomes", f"v={nxt:012d}")
        path, _ = apply_decision_batch(spark, dec, args.queue, now=args.now, outcome_path=out)
        print(json.dumps({"queue_version": path, "outcome": out}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
