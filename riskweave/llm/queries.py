"""Registered queries of this subpackage: each applies its operator, with
production parameters, to its whole table."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskweave.llm import centroids, decontaminate, digest, gnat, htmltext, langid, mixture, quality, rules, simhash, substring, toxicity, warc
from riskweave.llm.common import importable, table
from riskweave.session import shared_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return fn(spark, sf_dir)
    QUERIES[fn.__name__] = run
    return run


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query
def op2_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix(table(spark, sf_dir, "documents"))


SQL["op2_mixture"] = mixture.mix_sql()


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


@query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "llm", f"warc-{uuid.uuid4().hex}")
    warc.write(warc.page_records(table(spark, sf_dir, "pages")), path)
    return warc.page_index(spark, path)


SQL["op7_warc"] = warc.PAGES_SQL


@query
def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(table(spark, sf_dir, "documents"))


@query
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_passages(table(spark, sf_dir, "documents"))


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gnat.hard_negatives(table(spark, sf_dir, "embeddings"))


SQL["op12_hard_negatives"] = gnat.HARD_NEGATIVES_SQL


@query
def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


SQL["op13_centroids"] = centroids.cluster_sql()


@query
def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.edited_fingerprints(table(spark, sf_dir, "documents"))
