"""The pipeline on a small fixture, stage by stage, and the registered queries."""

import random

import pytest

import corpus_pipeline
from riskweave.llm import queries
from tests.llm.test_operators import DOCS, EDGE, LABELS, STOCK, prose


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(12)
    path = str(tmp_path_factory.mktemp("corpus"))
    passage, item = [f"{rng.choice(STOCK)}{i}" for i in range(70)], prose(rng, 30, [f"{s}q" for s in STOCK])
    rows, labels = [], []
    for i in range(100, 300):
        words = [f"{rng.choice(STOCK)}{rng.randrange(5000)}" for _ in range(150)]
        if i % 5 == 0:
            words = ["###" + w.upper() for w in words]
        if i % 20 in (1, 2):
            words[10:10] = passage
        if i % 20 == 3:
            words += item.split()
        rows.append((i, " ".join(words), "en", "ab"[i % 2], len(" ".join(words))))
        labels.append((i, int(i % 5 != 0), 0))
    rows += [(1000 + r[0], *r[1:]) for r in rows[6:9]] + EDGE + [rows[7]]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, passage


def test_stages(spark, folder):
    path, rows, passage = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = [r for r in docs.collect()]
    ids = {n: [r["doc_id"] for r in rs if (r["doc_id"] or 0) >= 100] for n, rs in kept.items()}
    good = {i for i in range(100, 300) if i % 5}
    assert set(ids["quality"]) == good | {1106, 1107, 1108}
    assert sorted(ids["near_duplicates"]) == sorted(good)  # copies and the repeated row are gone
    text = {r["doc_id"]: r["text"] for r in kept["repeated_passages"]}
    part = " ".join(passage[5:15])
    assert part in text[101] and all(part not in text[i] for i in good if i % 20 in (1, 2) and i != 101)
    assert set(ids["benchmark"]) == {i for i in good if i % 20 != 3}
    assert set(ids["mixture"]) <= set(ids["benchmark"])
    assert sorted(r["doc_id"] or -1 for r in corpus_pipeline.run(spark, path).collect()) == sorted(
        r["doc_id"] or -1 for r in kept["mixture"])


def test_ids_with_two_texts_keep_one_row_of_each_component(spark, tmp_path):
    rng = random.Random(31)
    a, b, c, d, e = (prose(rng, 120, STOCK) for _ in range(5))
    rows = [(5, a), (5, b), (3, b), (8, a), (9, a),  # 5 is the smallest of a's rows but not of b's
            (20, c), (20, d), (21, c), (22, d),      # 20 is the smallest of both
            (30, e), (30, e), (31, e)]               # a repeated row
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], DOCS)
    kept = sorted((r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicate_stage(spark, docs, str(tmp_path)).collect())
    assert kept == sorted([(5, a), (3, b), (20, c), (20, d), (30, e)])


def test_empty_tables(spark, tmp_path):
    path = str(tmp_path)
    spark.createDataFrame([], DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, path).count() == 0


def test_registered_queries_cover_their_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs, pages = (spark.read.parquet(f"{sf}/{t}.parquet").count() for t in ("documents", "pages"))
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 11))
    for name in ("op2_mixture", "op3_simhash", "op4_quality_rules", "op6_quality_classifier", "op8_langid"):
        assert queries.QUERIES[name](spark, sf).count() == docs
    for name in ("op5_html_extract", "op7_warc"):
        assert queries.QUERIES[name](spark, sf).count() == pages
