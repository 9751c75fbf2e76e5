"""Queries ``opN_<name>``: each operator with production parameters over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm import (
    alignment,
    chat,
    decontaminate,
    langid,
    packing,
    simhash,
    sketches,
    sql,
    substrings,
    suffixdedup,
    tokens,
    toxicity,
    vectorcodes,
    warc,
)
from vitrine.llm.registry import QUERIES, SQL, query, table
from vitrine.session import fresh_dir

__all__ = ["QUERIES", "SQL"]

TOKEN_LIMIT = 512


@query("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = tokens.count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query("op10_packing")
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op1_suffix_dedup", sql.OP1)
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixdedup.kept_bytes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op2_decontamination", sql.OP2)
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.overlaps(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        decontaminate.items_digest(F.col("items")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = langid.remainder(F.col("doc_id"), 5) == 0
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out))
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "evidence")


@query("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = langid.remainder(F.col("doc_id"), 4) == 2
    filters = langid.fit(docs.where(~held_out))
    return langid.predict(docs.select("doc_id", "text"), filters).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op5_simhash")
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")


@query("op6_fingerprints")
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.edited_pairs(table(spark, sf_dir, "documents"))


@query("op7_warc", sql.OP7)
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "warc")
    warc.write_pages(table(spark, sf_dir, "pages"), path)
    # Without payloads the records are small; stored, they are parsed once, and joins on hot ids can be split.
    records = substrings.stored(warc.read_records(spark, path, payloads=False), "records")
    found = warc.page_ids(substrings.stored(warc.captures(records), "captures"))
    return found.select(
        "page_id", F.col("answer.payload_bytes").alias("payload_bytes"),
        F.col("answer.payload_digest").alias("payload_digest"), F.col("answer.type").alias("record_type"),
        F.col("refers_to_page").alias("refers_to"))


@query("op8_substrings", sql.OP8)
def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.kept_words(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_chat_format", sql.OP11)
def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(
        spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)],
                              "conv_id bigint, turn bigint, role string, text string"))
    made = chat.format_conversations(chat.chat_log(rows))
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return (made.withColumns({"turns": chat.read_turns(F.col("formatted")),
                              "answers": chat.loss_text(F.col("formatted"), F.col("loss"))})
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                    F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
                    F.length("answers").cast("long").alias("loss_chars"), F.sha2("answers", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars")))


@query("op12_vector_codes", sql.OP12)
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vectorcodes.compress(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error",
                        F.lit(vectorcodes.books_digest(books)).alias("codebooks_sha256"))


@query("op13_alignment")
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                            public_tokenizers.path("piece_bpe_32k.model"), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")
