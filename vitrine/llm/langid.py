"""Language identification by bit-sliced Bloom filters of n-grams.

Learning counts the n-grams of about ``per_language`` documents of each language
in the tasks, and keeps the ``grams`` most frequent of each
language that are not far more usual in another. They go into one table of
slots: bit l of a slot stands for language l, so reading the slots of an n-gram
and joining them by AND gives all languages holding it at once. Beyond 64
languages a slot has several words.

For a text, the n-grams of every language are counted. Of n n-grams a language
with a false-positive rate f gets n * f by chance; the rest, over 1 - f, is its
evidence. Most evidence decides; its share of all evidence is the score.

N-grams are runs of ``SIZE`` UTF-8 bytes, A-Z lowered, with one blank for any
ASCII character that is no letter; those with two blanks are left out.

Null text, or no letter: ``und``, score 0. Letters but no evidence: the most
frequent learned language, score 0; ``und`` if nothing was learned. Ties: the
more frequent language, then the first by name. Rows with null language teach nothing. Repeated rows are each
predicted.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.arrays import Texts, blocks, mix

UNKNOWN = "und"
SIZE = 4
#: Learning documents per language, n-grams kept per language, slots of the filter table (a power of two).
PER_LANGUAGE, GRAMS, SLOTS = 2000, 8192, 1 << 18
#: A language keeps an n-gram if its share there is at least this part of its share anywhere.
USUAL = 0.2
HASHES = 2

_LETTERS = np.array([b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 32
                     for b in range(256)], np.uint8)


class Filters(NamedTuple):
    """Table of slots (by words, if a word has no room), languages in order, and each language's false-positive rate."""

    slots: np.ndarray
    languages: list[str]
    false_rate: np.ndarray


def n_grams(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the n-grams that stay inside a document, and their documents."""
    data = _LETTERS[texts.data]
    n = len(data) - SIZE + 1
    if n <= 0:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    code, blanks = np.zeros(n, np.uint32), np.zeros(n, np.int8)
    for i in range(SIZE):
        part = data[i:i + n]
        code = (code << np.uint32(8)) | part
        blanks += part == 32
    document = np.repeat(np.arange(len(texts)), np.diff(texts.bounds))
    inside = (document[:n] == document[SIZE - 1:]) & (blanks < 2)
    return code[inside], document[:n][inside]


def slot_numbers(codes: np.ndarray, slots: int) -> list[np.ndarray]:
    spread = mix(codes.astype(np.uint64))
    width = np.uint64(32)
    both = (spread & np.uint64(0xFFFFFFFF), spread >> width)
    return [(part & np.uint64(slots - 1)).astype(np.int64) for part in both][:HASHES]


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, gram, uses) of (lang, text)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches):
            languages = batch.column("lang").to_pylist()
            codes, document = n_grams(texts)
            names, of = np.unique(np.array(languages, object).astype(str), return_inverse=True)
            both, uses = np.unique((of[document].astype(np.uint64) << np.uint64(32)) | codes, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[(both >> np.uint64(32)).astype(np.int64)].tolist(), pa.string()),
                 pa.array((both & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(uses, pa.int64())],
                ["lang", "gram", "uses"])

    return (docs.select("lang", "text").mapInArrow(count, "lang string, gram bigint, uses bigint")
            .groupBy("lang", "gram").agg(F.sum("uses").alias("uses")))


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, grams: int = GRAMS, slots: int = SLOTS) -> Filters:
    """Filters from ``docs`` (doc_id, lang, text); which rows may teach is the caller's matter."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    # One row per language; a hash of the id picks about ``per_language`` documents of each.
    sizes = known.groupBy("lang").agg(F.count("*").alias("n"))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30)
    counts = count_grams(known.join(F.broadcast(sizes), "lang").where(part < per_language / F.col("n")))
    totals = counts.groupBy("lang").agg(F.sum("uses").alias("total"))
    shares = counts.join(F.broadcast(totals), "lang").withColumn("share", F.col("uses") / F.col("total"))
    usual = shares.withColumn("most", F.max("share").over(Window.partitionBy("gram"))).where(
        F.col("share") >= USUAL * F.col("most"))
    top = Window.partitionBy("lang").orderBy(F.desc("uses"), "gram")
    kept = (usual.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= grams)
            .select("lang", "gram").toPandas())
    # One row per language.
    frequent = sizes.orderBy(F.desc("n"), "lang").toPandas()
    learned = dict(tuple(kept.groupby("lang")["gram"]))
    languages = [x for x in frequent["lang"] if x in learned]
    kind = next((k for k in (np.uint8, np.uint16, np.uint32) if len(languages) <= np.iinfo(k).bits), np.uint64)
    bits = np.iinfo(kind).bits
    words, rates = max(1, -(-len(languages) // bits)), []
    table = np.zeros((slots, words), kind)
    for number, language in enumerate(languages):
        word, bit = divmod(number, bits)
        for at in slot_numbers(learned[language].to_numpy(), slots):
            table[at, word] |= kind(1 << bit)
        rates.append((((table[:, word] >> kind(bit)) & kind(1)).mean()) ** HASHES)
    return Filters(table[:, 0] if words == 1 else table, languages, np.array(rates))


def evidence(texts: Texts, filters: Filters) -> np.ndarray:
    """Documents by languages: n-grams found beyond chance, as a part of all n-grams."""
    codes, document = n_grams(texts)
    total = np.bincount(document, minlength=len(texts))
    out = np.zeros((len(texts), len(filters.languages)))
    table = filters.slots.reshape(len(filters.slots), -1)
    bits = table.dtype.itemsize * 8
    first, *more = slot_numbers(codes, len(table))
    for number, rate in enumerate(filters.false_rate):
        word, bit = divmod(number, bits)
        if bit == 0:
            masks = table[first, word]
            for at in more:
                masks &= table[at, word]
        hits = np.bincount(document, (masks >> masks.dtype.type(bit)) & masks.dtype.type(1), len(texts))
        out[:, number] = np.maximum(hits - total * rate, 0) / (1 - rate) / np.maximum(total, 1)
    return out


def predict(docs: DataFrame, filters: Filters, keep_text: bool = False) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, which replace columns of these names; ``text`` goes unless ``keep_text``."""
    docs = docs.drop("lang_pred", "score")
    kept = [c for c in docs.columns if keep_text or c != "text"]
    shared = docs.sparkSession.sparkContext.broadcast(tuple(filters))  # about 2 MB for every 64 languages
    lettered = "has_letter"
    while lettered in docs.columns:
        lettered += "_"

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = Filters(*shared.value)
        for batch, texts in blocks(batches):
            known = np.array(batch.column(lettered).to_pylist(), bool)
            if filters.languages:
                found = evidence(texts, filters)
                best = found.argmax(1)
                names = [filters.languages[i] if ok else UNKNOWN for i, ok in zip(best, known, strict=True)]
                total = found.sum(1)
                score = np.where(known & (total > 0), found.max(1) / np.where(total > 0, total, 1), 0.0)
            else:
                names, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(names, pa.string()), pa.array(score, pa.float64())],
                [*kept, "lang_pred", "score"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in kept]
    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.withColumn(lettered, has_letter).mapInArrow(
        label, ", ".join([*fields, "lang_pred string", "score double"]))


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; 0 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0)) % by
