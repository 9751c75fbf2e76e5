"""Document fingerprints: threshold-scaled sketches of shingles.

A sketch keeps every shingle hash below a fixed part of the hash range
(1 / ``SCALE``), and the lowest hash in any case, so no text is without one. As
the threshold is the same for all texts, sketches of parts merge into that of the
whole, and the part of a small document that lies in a large one can be
estimated whatever their sizes: the share of the smaller sketch found in the
other.

Shingles are five consecutive words, words being ``[^\\x20\\x09-\\x0D]+`` with A-Z
lowered; fewer words make one shingle of all, no words one of its own. A
fingerprint is the kept hashes, ascending, 16 hexadecimal digits each.

``edited_pairs`` needs each document's successor by id. Ids alone are cut into
ranges first; then a text travels once, packed, to its range, and the first of
each range also to the range before it, so that no global order of texts is
needed. Equal ids follow each other by text; null ids come first. A null text
counts as empty, a single row is its own successor, an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.arrays import BLOCK_BYTES, WORDS_SPACED, Slices, Texts, blocks, find_words, text_bytes, word_hashes

WORDS, SCALE = 5, 4
#: Documents to a range of ids.
RANGE_ROWS = 4096
_FIRST_ID = -(1 << 63)


def sketch_block(texts: Texts, scale: int = SCALE) -> list[np.ndarray]:
    """The kept hashes of every text of a block, ascending."""
    words = find_words(texts, WORDS_SPACED)
    slices = Slices(word_hashes(texts, words, fold=True))
    counts = words.counts()
    shingles = np.maximum(counts - WORDS + 1, 1)
    bounds = np.concatenate([[0], np.cumsum(shingles)])
    start = np.repeat(words.first[:-1] - bounds[:-1], shingles) + np.arange(bounds[-1])
    stop = np.minimum(start + WORDS, np.repeat(words.first[1:], shingles))
    hashes = slices.hashes(start, stop)
    lowest = np.repeat(np.minimum.reduceat(hashes, bounds[:-1]), shingles) if len(texts) else hashes
    kept = np.flatnonzero((hashes < np.uint64((1 << 64) // scale)) | (hashes == lowest))
    edges = np.searchsorted(kept, bounds)
    return [np.unique(hashes[kept[a:b]]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]


def to_text(sketch: np.ndarray) -> str:
    return sketch.astype(">u8").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the smaller sketch that the other holds."""
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return float((b[at] == a).mean())


def fingerprints(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """``doc_id`` and ``fingerprint`` of (doc_id, text)."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([to_text(s) for s in sketch_block(texts, scale)], pa.string())],
                ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        make, "doc_id bigint, fingerprint string")


def merge(sketches: list[np.ndarray], scale: int = SCALE) -> np.ndarray:
    """Sketch of all shingles of several sketches."""
    both = np.unique(np.concatenate(sketches))
    return both[(both < np.uint64((1 << 64) // scale)) | (both == both[0])]


def edited_pairs(docs: DataFrame, scale: int = SCALE, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    A text is edited by putting the first half of the next document in place of its last half.
    """
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST_ID)).alias("id"),
                       F.col("doc_id").isNull().alias("no_id"), F.col("text").cast("string").alias("text"))
    ranges = max(1, docs.count() // range_rows)
    cuts = docs.approxQuantile("id", [i / ranges for i in range(1, ranges)], max(0.1 / ranges, 1e-5)) if ranges > 1 else []
    edges = np.unique(np.array([int(c) for c in cuts], np.int64))

    def ranges_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.searchsorted(edges, ids, "right")), batch.column("id")], ["part", "id"])

    # As many rows as there are ranges: from each the first id.
    firsts = dict(docs.select("id").mapInArrow(ranges_of, "part bigint, id bigint")
                  .groupBy("part").agg(F.min("id")).collect())
    filled = sorted(firsts)
    before = {firsts[part]: filled[i - 1] for i, part in enumerate(filled)}  # the range before, cyclic
    first_ids = np.array(sorted(before), np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch, texts in blocks(batches):
            ids = batch.column("id").to_numpy()
            packed = [packer.compress(texts.bytes_of(i)) for i in range(len(texts))]
            ahead = np.flatnonzero(np.isin(ids, first_ids))
            rows = np.concatenate([np.arange(len(ids)), ahead])
            part = np.concatenate([np.searchsorted(edges, ids, "right"), [before[i] for i in ids[ahead].tolist()]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int64)), pa.array(ids[rows]), batch.column("no_id").take(pa.array(rows)),
                 pa.array(np.arange(len(rows)) >= len(ids)), pa.array([packed[i] for i in rows], pa.binary())],
                ["part", "id", "no_id", "ahead", "packed"])

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def compare(table: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor().decompress
        rows = sorted(zip(table["ahead"].to_pylist(), table["id"].to_pylist(),
                          map(unpack, table["packed"].to_pylist()), table["no_id"].to_pylist(), strict=True))
        mine = sum(not r[0] for r in rows)
        after = rows[mine:mine + 1]  # the smallest text of the next range's first id
        rows = [*rows[:mine], *after]
        out: dict[str, list] = {n: [] for n in names}
        begin = 0
        while begin < mine:
            end, held = begin, 0
            while end < mine and (end == begin or held + len(rows[end][2]) <= BLOCK_BYTES // 2):
                held += len(rows[end][2])
                end += 1
            plain = [r[2].decode() for r in rows[begin:end + 1]]
            edited = [a[:len(a) - len(a) // 2] + b[:len(a) // 2] for a, b in zip(plain, plain[1:], strict=False)]
            own = sketch_block(text_bytes(pa.array(plain, pa.string())), scale)
            new = sketch_block(text_bytes(pa.array(edited, pa.string())), scale)
            for i, text in enumerate(edited):
                _, id_, _, no_id = rows[begin + i]
                for name, value in zip(names, (
                        None if no_id else id_, len(plain[i]), hashlib.sha256(text.encode()).hexdigest(), to_text(own[i]),
                        to_text(new[i]), likeness(own[i], new[i]), likeness(own[i], own[i + 1])), strict=True):
                    out[name].append(value)
            begin = end
        kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
        return pa.table([pa.array(out[n], k) for n, k in zip(names, kinds, strict=True)], names)

    return (docs.mapInArrow(deal, "part bigint, id bigint, no_id boolean, ahead boolean, packed binary")
            .groupBy("part").applyInArrow(
                compare, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
                         "edited_fingerprint string, near_edited double, near_next double"))
