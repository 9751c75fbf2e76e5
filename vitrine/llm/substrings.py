"""Substring deduplication by seed and extend.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A window is ``LENGTH`` consecutive words of
a document. A word goes if a window covering it also starts in a document with a
smaller id; windows are judged on the input.

Seeds are winnowed: of the ``SEED``-word runs in a window the one with the lowest
hash (the leftmost of equals) anchors it, so equal windows have equal anchors. The
windows of one anchor lie side by side; with their words they form its stretch.

1. Documents are joined on anchors. Anchors found under one id only are dropped.
2. Extension: an anchor whose whole stretch also occurs under a smaller id loses
   all its windows at once.
3. Where an anchor is shared but extends to different words, the windows of the
   first document of each such stretch are compared one by one, through their
   hashes, with the smallest id that has them.

Overlapping and touching windows merge to maximal repeats. No pairs of documents
are made: everything is compared with the smallest id of its key, which tasks
find by partial minima, so a passage that a third of the documents share costs one
row per occurrence. Equality is that of 64-bit hashes.

A null text has no words. A null id is smaller than any other. Rows with equal ids
don't remove from each other. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.arrays import (
    BLOCK_BYTES,
    WORDS_SPACED,
    Slices,
    Texts,
    Words,
    blocks,
    covered,
    find_words,
    runs_inside,
    sliding_lowest,
    text_bytes,
    true_runs,
    word_hashes,
)
from vitrine.session import fresh_dir

LENGTH, SEED = 50, 10
NO_ID = -(1 << 63)


def keyed(docs: DataFrame) -> DataFrame:
    """``id`` (never null), ``mark`` and ``text``; rows with equal id and text are one in what follows."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
                       F.xxhash64(text).alias("mark"), text.alias("text"))


def anchored(windows: np.ndarray, grams: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first window and number of windows of every stretch.

    ``windows`` are the starts of all windows, ``grams`` hashes by start place,
    ``width`` how many of them a window holds.
    """
    if not len(windows):
        return (np.empty(0, np.int64),) * 3
    anchor = sliding_lowest(grams, width)[windows]
    new = np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(windows) != 1)])
    first = np.flatnonzero(new)
    return anchor[first], windows[first], np.diff(np.append(first, len(windows)))


def _stretches(texts: Texts, length: int, seed: int) -> tuple[Words, Slices, list[np.ndarray]]:
    """Words; their hashes; hash of the anchor, hash of the stretch, first word and windows of every stretch."""
    words = find_words(texts, WORDS_SPACED)
    slices = Slices(word_hashes(texts, words))
    n = len(words.start)
    if n < length:
        return words, slices, [np.empty(0, np.uint64), np.empty(0, np.uint64), *(np.empty(0, np.int64),) * 2]
    at = np.arange(n - seed + 1)
    grams = slices.hashes(at, at + seed)
    anchor, first, count = anchored(runs_inside(words.first, length), grams, length - seed + 1)
    return words, slices, [grams[anchor], slices.hashes(first, first + count + length - 1), first, count]


def find_stretches(docs: DataFrame, length: int, seed: int) -> DataFrame:
    """(anchor, stretch, id, mark, first, windows) of all documents; first counts words of the document."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches):
            words, _, (anchor, stretch, first, count) = _stretches(texts, length, seed)
            document = np.searchsorted(words.first, first, "right") - 1
            rows = pa.array(document)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.view(np.int64)), pa.array(stretch.view(np.int64)), batch.column("id").take(rows),
                 batch.column("mark").take(rows), pa.array((first - words.first[document]).astype(np.int32)),
                 pa.array(count.astype(np.int32))], ["anchor", "stretch", "id", "mark", "first", "windows"])

    return docs.mapInArrow(find, "anchor bigint, stretch bigint, id bigint, mark bigint, first int, windows int")


def packed(docs: DataFrame) -> DataFrame:
    """Texts compressed for the way to the task that needs them."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch, texts in blocks(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("mark"),
                 pa.array([packer.compress(texts.bytes_of(i)) for i in range(len(texts))], pa.binary())],
                ["id", "mark", "packed"])

    return docs.mapInArrow(pack, "id bigint, mark bigint, packed binary")


def unpacked(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Blocks of a batch whose texts were packed."""
    unpack = zstandard.ZstdDecompressor().decompress
    sizes = [zstandard.frame_content_size(x) for x in (v.as_py() for v in batch.column("packed"))]
    begin, held = 0, 0
    for end in range(len(sizes) + 1):
        if end == len(sizes) or (end > begin and held + sizes[end] > BLOCK_BYTES):
            part = batch.slice(begin, end - begin)
            if end > begin:
                yield part, text_bytes(pa.array([unpack(v.as_py()) for v in part.column("packed")], pa.binary()))
            begin, held = end, 0
        if end < len(sizes):
            held += sizes[end]


def with_ranges(docs: DataFrame, ranges: DataFrame, inner: bool) -> DataFrame:
    """Packed documents with ``begins`` and ``ends``, their ranges; a document has no more ranges than words."""
    grouped = ranges.groupBy("id", "mark").agg(F.collect_list(F.struct("begin", "end")).alias("found")).select(
        "id", "mark", F.col("found.begin").alias("begins"), F.col("found.end").alias("ends"))
    return packed(docs).join(grouped, ["id", "mark"], "inner" if inner else "left")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read again.

    A join of two such tables shuffles both sides alike, so that adaptive execution can split a hot key.
    """
    path = fresh_dir(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def removed_ranges(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """(id, mark, begin, end): word ranges of ``keyed`` documents that occur under a smaller id."""
    stretches = stored(find_stretches(docs, length, seed), "stretches")
    shared = stretches.groupBy("anchor").agg(
        F.min("id").alias("low"), F.max("id").alias("high"), (F.min("stretch") != F.max("stretch")).alias("differs")
    ).where(F.col("low") < F.col("high")).select("anchor", "differs")
    seeds = stored(stretches.join(stored(shared, "anchors"), "anchor"), "seeds")
    firsts = stored(seeds.groupBy("anchor", "stretch").agg(F.min("id").alias("first_id")), "firsts")
    extended = seeds.join(firsts, ["anchor", "stretch"])
    whole = extended.where(F.col("first_id") < F.col("id")).select(
        "id", "mark", F.col("first").alias("begin"), (F.col("first") + F.col("windows") + (length - 1)).alias("end"))
    rest = extended.where((F.col("first_id") == F.col("id")) & F.col("differs")).select(
        "id", "mark", F.col("first").alias("begin"), (F.col("first") + F.col("windows")).alias("end"))

    def windows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in unpacked(batch):
                words = find_words(texts, WORDS_SPACED)
                slices = Slices(word_hashes(texts, words))
                starts, rows = [], []
                for i, (begins, ends) in enumerate(zip(part.column("begins").to_pylist(), part.column("ends").to_pylist(),
                                                       strict=True)):
                    mine = np.concatenate([np.arange(b, e) for b, e in zip(begins, ends, strict=True)])
                    starts.append(mine)
                    rows.append(np.full(len(mine), i))
                start, row = np.concatenate(starts), np.concatenate(rows)
                at = start + words.first[row]
                rows = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slices.hashes(at, at + length).view(np.int64)), part.column("id").take(rows),
                     part.column("mark").take(rows), pa.array(start.astype(np.int32))], ["window", "id", "mark", "begin"])

    windows = stored(with_ranges(docs, rest, True).mapInArrow(
        windows_of, "window bigint, id bigint, mark bigint, begin int"), "windows")
    lowest = windows.groupBy("window").agg(F.min("id").alias("low"), F.max("id").alias("high")).where(
        F.col("low") < F.col("high")).select("window", "low")
    single = windows.join(stored(lowest, "lowest"), "window").where(F.col("low") < F.col("id")).select(
        "id", "mark", "begin", (F.col("begin") + length).alias("end"))
    return whole.union(single)


def judge(texts: Texts, begins: list, ends: list) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Number of words and of removed ones, byte starts and stops of all words, and which stay, per document."""
    words = find_words(texts, WORDS_SPACED)
    for i, (b, e) in enumerate(zip(begins, ends, strict=True)):
        first, last = words.first[i], words.first[i + 1]
        gone = covered(np.array(b or [], np.int64), np.array(e or [], np.int64), last - first)
        yield last - first, int(gone.sum()), words.start[first:last], words.stop[first:last], ~gone


def kept_words(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` of ``docs`` (doc_id, text); ``kept`` joins what stays by one blank."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in unpacked(batch):
                counts, removed, kept = [], [], []
                for n, gone, start, stop, stay in judge(
                        texts, part.column("begins").to_pylist(), part.column("ends").to_pylist()):
                    counts.append(n)
                    removed.append(gone)
                    kept.append(b" ".join(texts.data[a:b].tobytes()
                                          for a, b in zip(start[stay].tolist(), stop[stay].tolist(), strict=True)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(kept, pa.binary())], ["id", "n_words", "n_removed", "kept"])

    known = keyed(docs)
    found = with_ranges(known, removed_ranges(known, length, seed), False).mapInArrow(
        cut, "id bigint, n_words bigint, n_removed bigint, kept binary")
    return found.select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "n_words", "n_removed",
                        F.col("kept").cast("string").alias("kept"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """``docs`` with repeats cut out of their texts; white space before a kept word stays.

    Texts without a repeat are left as they are. The columns stay as they are.
    """
    known = keyed(docs)
    grouped = removed_ranges(known, length, seed).groupBy("id", "mark").agg(
        F.collect_list(F.struct("begin", "end")).alias("found"))
    ranges, names, schema = "_ranges", docs.columns, docs.schema
    while ranges in names:
        ranges += "_"
    keys = [f"{ranges}id", f"{ranges}mark"]
    base = docs.withColumns(dict(zip(keys, (
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)),
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))), strict=True)))
    joined = base.join(grouped.toDF(*keys, ranges), keys, "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches):
            column, found = batch.column("text").to_pylist(), batch.column(ranges).to_pylist()
            some = [i for i, x in enumerate(found) if x]
            part = text_bytes(pa.array([texts.bytes_of(i) for i in some], pa.binary()))
            places = [[[r[k] for r in found[i]] for i in some] for k in ("begin", "end")]
            for at, (i, (_, _, start, stop, stay)) in enumerate(zip(some, judge(part, *places), strict=True)):
                raw, offset = part.bytes_of(at), part.bounds[at]
                begins, ends = true_runs(stay)
                pieces = [raw[(stop[b - 1] - offset if b else 0):stop[e - 1] - offset] for b, e in zip(begins, ends)]
                column[i] = b"".join(pieces).lstrip().decode() if len(begins) and begins[0] else b"".join(pieces).decode()
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, pa.string()) if c == "text" else batch.column(c) for c in names], names)

    return joined.select(*names, ranges).mapInArrow(cut, schema)
