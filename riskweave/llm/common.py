"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.session import shared_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from the driver's source folder
    (a cluster without it there gets the package by ``--py-files``)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint root and read it back.

    Cuts the lineage with files that every executor can read again, so a lost
    executor never forces the work behind ``df`` to be redone, and gives later
    joins a plain scan whose exchanges adaptive execution may split.
    """
    spark = df.sparkSession
    path = shared_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Intermediate tables of one run, each deleted once what was made from it is
    written (and so needs no file of it when an executor is lost)."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self.paths[name] = shared_path(self.spark, "llm", f"{name}-{uuid.uuid4().hex}")
        df.write.parquet(self.paths[name])
        return self.spark.read.schema(df.schema).parquet(self.paths[name])

    def drop(self, *names: str) -> None:
        for name in names:
            removed(self.spark, self.paths.pop(name))


class Rounds:
    """Written tables of an iteration: each write deletes the table before it,
    which nothing but the new one was made from."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.path = spark, name, None

    def write(self, df: DataFrame) -> DataFrame:
        path, before = shared_path(self.spark, "llm", f"{self.name}-{uuid.uuid4().hex}"), self.path
        df.write.parquet(path)
        self.path = path
        if before:
            removed(self.spark, before)
        return self.spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own intermediate files."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def temp_name(stem: str) -> str:
    """A column name that cannot clash with an input's own columns."""
    return f"__{stem}_{uuid.uuid4().hex[:12]}"


def held_out(doc_id: str | Column, modulus: int, remainder: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``, equals ``remainder``.

    A row without an id counts as held out: nothing is learned from it.
    """
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % modulus == remainder, F.lit(True))


def hash_order(doc_id: str, seed: int) -> Column:
    """A fixed pseudo-random order of ids, for bounded training samples."""
    return F.xxhash64(F.lit(seed), F.col(doc_id))


def thinned(doc_id: str, seed: int, rows: int, count: int) -> Column:
    """True for a hash-chosen share of ids in which about twice ``rows`` of
    ``count`` ids are left, so that a bounded sample is ordered over a bounded
    number of rows however large the table is."""
    share = min(1.0, 2.0 * rows / max(1, count))
    return F.pmod(F.xxhash64(F.lit(~seed), F.col(doc_id)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
