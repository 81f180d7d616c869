"""Corpus pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; :func:`run`
writes what a stage returns as Parquet under the shared checkpoint root and
reads it again as the next stage's ``docs``.

1. *quality*: rows that the pairwise ranking scores below its threshold go.
2. *near_duplicates*: of each SimHash component one row of the smallest id stays.
3. *repeated_passages*: passages that repeat an earlier document are cut; a row
   with nothing left goes.
4. *benchmark*: rows that contain a benchmark item go.
5. *mixture*: rows are sampled by the raked weight of their source, language
   and topic.

A null text passes the quality stage on its score like an empty one; rows
without an id are kept by stage 2 and never cut by stage 3; rows that repeat a
kept id come once after stage 2, or once for each component the id is the smallest
of where its texts differ.  Empty tables give empty
results.  Other columns are carried along unchanged (``n_chars`` follows a cut
text).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import decontaminate, mixture, quality, simhash, substring
from riskweave.llm.common import importable, table, temp_name, written


def _own(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    score = temp_name("score")
    return docs.withColumn(score, quality.score_column(model)).where(F.col(score) >= quality.CUT).select(*_own(docs))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    found = written(simhash.near_duplicates(docs, labels_too=True), "pipeline-components").where("doc_id is not null")
    stays = F.col("doc_id") == F.col("component_id")
    ids = found.groupBy("doc_id").agg(F.count("*").alias("n"), F.max(stays.cast("int")).alias("stays"))
    # ids that leave, and ids that come more than once: far fewer than the texts
    leaves = written(ids.where("stays = 0").select("doc_id"), "pipeline-leaves")
    again = written(ids.where("stays = 1 and n > 1").select("doc_id"), "pipeline-again")
    once = docs.join(leaves.unionByName(again), "doc_id", "left_anti")
    # of an id's rows one for each component that the id is the smallest of
    label, mark = temp_name("label"), temp_name("fingerprint")
    heads = (found.where(stays).join(again, "doc_id", "left_semi").groupBy("doc_id", F.col("label").alias(label))
             .agg(F.min("fingerprint").alias(mark)))
    first = (docs.join(again, "doc_id", "left_semi").withColumn(mark, simhash.digits(simhash.fingerprint_column("text")))
             .join(written(heads, "pipeline-heads"), ["doc_id", mark]).dropDuplicates(["doc_id", label]))
    return once.select(*_own(docs)).unionByName(first.select(*_own(docs)))


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return substring.remove_repeats(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixture_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixture.sample(docs)


STAGES = [("quality", quality_stage), ("near_duplicates", near_duplicate_stage), ("repeated_passages", passage_stage),
          ("benchmark", benchmark_stage), ("mixture", mixture_stage)]

#: SQL cannot express the trained, hashed and aligned stages; the tests compare
#: the pipeline with brute force on small fixtures.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
