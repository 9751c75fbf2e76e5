"""Corpus preparation in five stages, each applying one operator of ``vitrine.llm``.

Every stage takes (spark, docs, sf_dir) and works on all documents its predecessor
kept. All but the last return the columns of ``documents``:

1. language: documents whose language can't be told go (no text, no letter).
2. near_duplicates: of each group of linked SimHash fingerprints the document with
   the smallest id stays. Of rows with equal id and text one stays. A null id is the
   smallest of its group only if there is no other.
3. substrings: passages of 50 words that a document with a smaller id has too are
   cut out; documents of which nothing is left go.
4. decontamination: words that lie in 10-word windows of the benchmark are cut out;
   documents of which nothing is left go.
5. packing: the pieces of all documents with their places in sequences.

``n_chars`` follows the text. Columns beyond those of ``documents`` are dropped.
Null texts go in the first stage; an empty table passes through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm import decontaminate, langid, packing, simhash, substrings
from vitrine.session import fresh_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Several operators or learned models can't be put as SQL.
ORACLE_SQL = None


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def _shortened(docs: DataFrame) -> DataFrame:
    """Length of the new texts; documents without words go."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).where(F.col("text").rlike(r"\S"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = _documents(docs)
    learned = langid.fit(docs.where(langid.remainder(F.col("doc_id"), 4) != 2))
    found = langid.predict(docs, learned, keep_text=True)
    return found.where(F.col("lang_pred") != langid.UNKNOWN).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = _documents(docs)
    found = simhash.near_duplicates(docs)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("kept_id")).distinct()
    joined = docs.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi")
    return joined.withColumn("mark", F.xxhash64("text")).dropDuplicates(["doc_id", "mark"]).select(*COLUMNS)


def substring_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _shortened(substrings.remove_repeats(_documents(docs)))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _shortened(decontaminate.remove_overlaps(_documents(docs), benchmark))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("substrings", substring_repeats),
    ("decontamination", decontamination),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = fresh_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
