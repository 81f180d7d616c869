"""Constraints on the write path: one pass splits a batch into accepted and
rejected queue rows.

The batch is written once, partitioned by the verdict, with counts taken by
``observe`` in the same job.  The accepted half is read back (so the upsert
never recomputes the batch) and dropped after the publish; the rejected half,
with its reasons, stays under its run.  A rerun of a run overwrites its own rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.operators import quality
from riskweave.sources.writers import delete_path


def reject_root(queue_root: str) -> str:
    """Where a queue's rejected rows lie: beside it."""
    return f"{queue_root.rstrip('/')}-checked"


@dataclass
class Checked:
    accepted: DataFrame
    rejected: DataFrame
    counts: dict[str, int]  # rows, accepted, rejected and one entry per violated constraint
    path: str

    def publish_done(self) -> None:
        """Drop the accepted copy once the queue holds it."""
        delete_path(self.accepted.sparkSession, f"{self.path}/is_valid=true")


def check(batch: DataFrame, root: str, run: str) -> Checked:
    """Split ``batch`` (triage layout) under ``root/run=<run>``."""
    spark = batch.sparkSession
    rows = batch if "analyst_decision" in batch.columns else batch.withColumn("analyst_decision", F.lit(None).cast("string"))
    judged = quality.validate_triage(rows)
    seen = Observation()
    names = quality.TRIAGE_CONSTRAINTS
    path = f"{root}/run={run}"
    (judged.observe(seen, F.count("*").alias("rows"), F.count_if("is_valid").alias("accepted"),
                    F.count_if(~F.col("is_valid")).alias("rejected"),
                    *[F.count_if(F.array_contains("violations", n)).alias(n) for n in names])
     .write.mode("overwrite").partitionBy("is_valid").parquet(path))
    stored = T.StructType([f for f in judged.schema.fields if f.name != "is_valid"] + [T.StructField("is_valid", T.BooleanType())])
    back = spark.read.schema(stored).parquet(path)
    counts = {k: v for k, v in seen.get.items() if v or k in ("rows", "accepted", "rejected")}
    return Checked(back.where("is_valid").select(*batch.columns), back.where("NOT is_valid").drop("is_valid"), counts, path)


def rejected(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Rejected rows of all runs under ``root``: the batch's columns (``schema``),
    ``violations`` and ``run``."""
    full = T.StructType([*schema.fields, T.StructField("violations", T.ArrayType(T.StringType())),
                         T.StructField("run", T.StringType()), T.StructField("is_valid", T.BooleanType())])
    return spark.read.schema(full).parquet(root).where("NOT is_valid").drop("is_valid")
