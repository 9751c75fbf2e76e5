"""Stages of the corpus pipeline, one by one against plain versions, and all together."""

from __future__ import annotations

import brute
import corpus_pipeline
import samples
from pyspark.sql import functions as F

STAGES = dict(corpus_pipeline.STAGES)


def documents(spark, rows):
    return samples.frame(spark, rows).withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text").cast("long"))


def test_language_keeps_all_with_letters(spark, sf_dir):
    rows = samples.documents()
    kept = STAGES["language"](spark, documents(spark, rows), sf_dir)
    assert kept.columns == corpus_pipeline.COLUMNS
    assert sorted(r["text"] for r in kept.collect()) == sorted(t for _, t in rows if t and any(c.isalpha() for c in t))


def test_one_of_each_group_stays(spark, sf_dir):
    rows = list({i: (i, t) for i, t in samples.documents() if i is not None}.values())
    roots = brute.components({i: brute.simhash(t) for i, t in rows})
    kept = STAGES["near_duplicates"](spark, documents(spark, [*rows, rows[0]]), sf_dir).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted({*roots.values()})
    alone = STAGES["near_duplicates"](spark, documents(spark, [(None, "all alone"), (1, "quite another thing")]), sf_dir)
    assert alone.count() == 2


def test_repeats_and_benchmark_go(spark, sf_dir):
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first()["text"]
    passage = " ".join(f"w{i}" for i in range(60))
    docs = documents(spark, [(1, passage), (2, f"before {passage} after"), (3, passage), (4, f"clean words, {item}"), (5, None)])
    cut = STAGES["substrings"](spark, docs, sf_dir)
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == {1: passage, 2: "before after", 4: f"clean words, {item}"}
    clean = STAGES["decontamination"](spark, cut, sf_dir)
    left = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert left[1] == passage and left[4].startswith("clean words, ") and item[:40] not in left[4]
    assert all(r["n_chars"] == len(r["text"]) for r in clean.collect())


def test_empty_documents(spark, sf_dir):
    docs = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).collect() == []


def test_run(spark, sf_dir):
    packed = corpus_pipeline.run(spark, sf_dir)
    ids = {r["doc_id"] for r in packed.collect()}
    assert ids <= {r["doc_id"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()} and len(ids) > 100
