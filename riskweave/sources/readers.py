"""File sources: bronze CSV scans, header-only landing counts, incremental
loads, and the Parquet reads of upstream tables.

Scans use an explicit schema by default (``inferSchema`` costs an extra full
pass over the files and can change types between runs); inference stays
available for parity with the original loads.
"""

from __future__ import annotations

import threading
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from riskweave.sources import schemas


def _now(now) -> Column:
    if now is None:
        return F.current_timestamp()
    return now if isinstance(now, Column) else F.lit(now).cast("timestamp")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             infer: bool = False) -> DataFrame:
    r = spark.read.option("header", "true").option("mode", "PERMISSIVE")
    if schema is not None and not infer:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", "true")
    return r.csv(path)


CORRUPT = "_corrupt_record"


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a column ``_corrupt_record``: the whole line where it does not
    fit the schema (a value of another type, too few or too many fields), else
    null; and the file it came from."""
    kept = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = (spark.read.option("header", "true").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).schema(kept).csv(path))
    return rows.withColumn("source_file", F.col("_metadata.file_path"))


@dataclass
class Bronze:
    good: DataFrame
    quarantine: DataFrame  # line, source_file, ingestion_timestamp
    rows: int
    malformed: int


def load_bronze(spark: SparkSession, path: str, schema: T.StructType, target: str, now=None) -> Bronze:
    """Land CSV as a bronze table: good rows under ``malformed=false``, broken
    lines with their text and file under ``malformed=true``, counted in the
    write itself."""
    seen = Observation()
    rows = with_ingestion_time(read_csv_checked(spark, path, schema), now)
    rows = rows.withColumns({"malformed": F.col(CORRUPT).isNotNull(), "line": F.col(CORRUPT)}).drop(CORRUPT)
    (rows.observe(seen, F.count("*").alias("rows"), F.count_if("malformed").alias("malformed"))
     .write.mode("overwrite").partitionBy("malformed").parquet(target))
    back = spark.read.schema(rows.schema).parquet(target)
    good = back.where("NOT malformed").select(*schema.names, "ingestion_timestamp")
    return Bronze(good, back.where("malformed").select("line", "source_file", "ingestion_timestamp"),
                  seen.get["rows"], seen.get["malformed"])


def with_ingestion_time(df: DataFrame, now=None) -> DataFrame:
    return df.withColumn("ingestion_timestamp", _now(now))


def read_transactions(spark: SparkSession, path: str, schema: T.StructType | None = schemas.TRANSACTIONS,
                      now=None, infer: bool = False) -> DataFrame:
    """Bronze transactions: header CSV plus ingestion time."""
    return with_ingestion_time(read_csv(spark, path, schema, infer), now)


def read_login_logs(spark: SparkSession, path: str, schema: T.StructType | None = schemas.LOGIN_LOGS,
                    now=None, infer: bool = False) -> DataFrame:
    """Bronze login logs: header CSV plus ingestion time."""
    return with_ingestion_time(read_csv(spark, path, schema, infer), now)


def read_signatures(spark: SparkSession, path: str,
                    schema: T.StructType | None = schemas.FRAUD_SIGNATURES, infer: bool = False) -> DataFrame:
    """Known fraud signatures (pattern catalogue)."""
    return read_csv(spark, path, schema, infer)


def landing_count(spark: SparkSession, path: str) -> DataFrame:
    """Row count of a landed CSV read with a header and all-string columns.
    Returned as a one-row DataFrame (the count runs as a distributed job)."""
    return spark.read.option("header", "true").csv(path).agg(F.count("*").alias("row_count"))


def read_parquet_merged(spark: SparkSession, path: str) -> DataFrame:
    """Parquet with schema merging across files written at different versions."""
    return spark.read.option("mergeSchema", "true").parquet(path)


@dataclass
class Loaded:
    batches: int
    rows: int


class _Progress(StreamingQueryListener):
    """Counts of one query, from every progress event (a query object keeps
    only its latest ones)."""

    def __init__(self, name: str):
        self.name, self.run = name, None
        self.batches: dict[int, int] = {}
        self.over = threading.Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.run = event.runId

    def onQueryProgress(self, event) -> None:
        if event.progress.name == self.name and event.progress.numInputRows:
            self.batches[event.progress.batchId] = event.progress.numInputRows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId == self.run:
            self.over.set()


def load_incremental(spark: SparkSession, source_path: str, schema: T.StructType, target_path: str,
                     checkpoint: str, fmt: str = "csv", now=None, max_files_per_trigger: int | None = None) -> Loaded:
    """Idempotent copy of new files from a landing folder into a Parquet table.

    A file stream with an ``availableNow`` trigger processes every file not yet
    recorded in ``checkpoint`` and stops; files already loaded are skipped on
    the next call.  ``checkpoint`` and ``target_path`` must be on shared storage.
    Returns the micro-batches that brought rows and the rows, however many.
    """
    reader = spark.readStream.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = with_ingestion_time(reader.format(fmt).load(source_path), now)
    progress = _Progress(f"load-{uuid.uuid4().hex}")
    spark.streams.addListener(progress)
    try:
        q = (stream.writeStream.format("parquet").queryName(progress.name).option("path", target_path)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
        if not progress.over.wait(60):  # events come in order; the last one follows the last batch
            raise TimeoutError("the load ended, but its last progress did not arrive")
    finally:
        spark.streams.removeListener(progress)
    return Loaded(len(progress.batches), sum(progress.batches.values()))
