"""Token counts: pieces counted once per distinct pre-token.

A pre-token here is a stretch of text that begins at a space standing behind a
character that is no white space (or at the text's begin). No piece of a
byte-level BPE with the usual splitting rule crosses such a place, so the pieces
of a text are those of its pre-tokens.

1. Every task counts its pre-tokens; summed over all tasks they form the table
   of distinct pre-tokens, and each is encoded once for its number of pieces.
2. The most frequent pre-tokens, ``head`` at most, so that the broadcast is
   bounded, are looked up while a document is read. The rest join the table on
   the pre-token; being rare, none of them is a hot key.
3. Numbers are summed by document. No list of ids is ever made.

Null or empty text: 0 tokens. Repeated rows: one result each. Special strings
inside texts are one token each, as the library has it by default.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.arrays import blocks
from vitrine.session import fresh_dir

HEAD = 1 << 16
#: A task hands its counts on when it holds so many different pre-tokens.
HELD = 400_000
#: White space as the splitting rule has it; Python's own class has four more characters.
SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_UNSURE = re.compile(r"\s ")
_CUT = re.compile(f"(?<=[^{SPACES}])(?= )")


def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def added_tokens(path: str) -> dict[str, int]:
    """Special strings and their ids; only plain ones are known here."""
    with open(path, encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    for token in added:
        if any(token[k] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"unknown kind of added token {token}")
    return {t["content"]: t["id"] for t in added}


def added_pattern(added: Iterable[str]) -> re.Pattern | None:
    longest_first = sorted(added, key=len, reverse=True)
    return re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None


def pre_tokens(text: str) -> list[str]:
    if not _UNSURE.search(text) and "\0" not in text:
        return text.replace(" ", "\0 ").split("\0")
    return _CUT.split(text)


def count_pre_tokens(text: str, special: re.Pattern | None) -> tuple[Counter, int]:
    """Pre-tokens of a text, and how many special strings it holds."""
    if special is None or not special.search(text):
        return Counter(pre_tokens(text)), 0
    found, parts = Counter(), special.split(text)
    for part in parts[::2]:
        found.update(pre_tokens(part))
    return found, len(parts) // 2


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for batch, _ in blocks(batches):
        yield batch, [x or "" for x in batch.column("text").to_pylist()]


def distinct_pre_tokens(docs: DataFrame, path: str) -> DataFrame:
    """(pre_token, uses, n_tokens) over all documents."""
    def gather(batches):
        special = added_pattern(added_tokens(path))
        held: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held.keys()), pa.string()), pa.array(list(held.values()), pa.int64())],
                ["pre_token", "uses"])

        for _, texts in _strings(batches):
            for text in texts:
                held.update(count_pre_tokens(text, special)[0])
            if len(held) > HELD:
                yield out()
                held.clear()
        yield out()

    def encode(batches):
        encoder = tokenizer(path)
        for batch in batches:
            found = encoder.encode_batch_fast(batch.column("pre_token").to_pylist(), add_special_tokens=False)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([len(x) for x in found], pa.int64())], ["pre_token", "uses", "n_tokens"])

    counted = (docs.select("text").mapInArrow(gather, "pre_token string, uses bigint")
               .groupBy("pre_token").agg(F.sum("uses").alias("uses")))
    return counted.mapInArrow(encode, "pre_token string, uses bigint, n_tokens bigint")


def count_tokens(docs: DataFrame, path: str, head: int = HEAD) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` for every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    stored = fresh_dir(spark, "pre-tokens")
    distinct_pre_tokens(docs, path).write.parquet(stored)
    pieces = spark.read.parquet(stored)
    # Pre-tokens in classes of like use: the most used classes, up to ``head`` rows. Bounded whatever the data.
    level = F.floor(8 * F.log2("uses")).cast("int")
    sizes = {r[0]: r[1] for r in pieces.groupBy(level).count().collect()}
    taken, lowest = 0, max(sizes, default=0) + 1
    for at in sorted(sizes, reverse=True):
        taken += sizes[at]
        if taken > head:
            break
        lowest = at
    top = pieces.where(level >= lowest).select("pre_token", "n_tokens").collect()
    known = spark.sparkContext.broadcast({r[0]: r[1] for r in top})

    def look_up(batches):
        special, sizes = added_pattern(added_tokens(path)), known.value
        for batch, texts in _strings(batches):
            base, rows, rest, uses = [], [], [], []
            spread = [f"\0{row}" for row in batch.column("row").to_pylist()]
            for row, text in zip(batch.column("row").to_pylist(), texts, strict=True):
                found, total = count_pre_tokens(text, special)
                for pre_token, n in found.items():
                    size = sizes.get(pre_token)
                    if size is None:
                        rows.append(row)
                        rest.append(pre_token)
                        uses.append(n)
                    else:
                        total += size * n
                base.append(total)
            m = len(rest)
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([batch.column("row"), pa.array(rows, pa.int64())]),
                 pa.concat_arrays([batch.column("doc_id"), pa.nulls(m, pa.int64())]),
                 pa.array([len(x.encode()) for x in texts] + [None] * m, pa.int64()),
                 pa.array(spread + rest, pa.string()),
                 pa.array(np.concatenate([base, uses]).astype(np.int64))],
                ["row", "doc_id", "n_bytes", "pre_token", "number"])

    # One pass gives both kinds of rows: with n_bytes the known sum of a document, without it uses of a pre-token.
    # The former carry any key of their own, so that they don't meet in one task.
    looked = docs.withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "text").mapInArrow(
        look_up, "row bigint, doc_id bigint, n_bytes bigint, pre_token string, number bigint")
    joined = looked.join(pieces.select("pre_token", "n_tokens"), "pre_token", "left")
    return (joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"),
        F.sum(F.when(F.col("n_bytes").isNull(), F.col("number") * F.col("n_tokens"))
              .otherwise(F.col("number"))).alias("n_tokens"))
        .drop("row"))
