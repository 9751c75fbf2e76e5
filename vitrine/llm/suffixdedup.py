"""Exact substring deduplication over bytes by suffix arrays.

A byte goes if it is covered by a ``LENGTH``-byte string that also starts in a
document with a smaller id; strings are judged on the input.

1. Documents are stored in chunks, bucketed so that later passes read them in place.
   Every ``LENGTH``-byte string is anchored at the ``SEED``-byte run in it with the
   lowest hash (the leftmost of equals), so equal strings have equal anchors; the
   strings of one anchor lie side by side in a stretch of text. Each chunk sends its
   anchors and the hashes of their stretches, by ranges of the anchor's value. A
   range tells every chunk which anchors no other id has (usually most: that text
   takes no further part), which stretches stand whole under a smaller id (they go),
   and which differ from others of their anchor.
2. The differing stretches are dealt to shards by anchor, so that equal strings meet.
   A shard builds suffix arrays (Larsson-Sadakane) over blocks of its stretches with
   common prefixes by Kasai's rule; a run of suffixes with ``LENGTH`` bytes in common
   is one string with its smallest id. The blocks' sorted strings are merged by
   binary search, and every string learns the smallest id of all blocks.
3. Anchors with more than ``CROWD`` differing stretches would make a shard too large.
   Their strings are compared one by one instead, as rows keyed by hash whose
   smallest id is found by partial minima: exact, and not in one task.
4. Removed ranges go back to their chunk.

A null text counts as empty. A null id is smaller than any other. Documents with
equal ids don't remove from each other; a repeat inside one document stays. An
empty table gives no rows. Strings of a block are told apart by their bytes, those
of different blocks by 64-bit hashes, whole stretches by 40 bits of their anchor
beside its range and 48 bits of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.arrays import (
    Slices,
    Texts,
    blocks,
    byte_values,
    covered,
    mix,
    runs_inside,
    sliding_lowest,
    true_runs,
)
from vitrine.llm.substrings import stored
from vitrine.llm.suffixes import common_prefixes, suffix_array
from vitrine.session import fresh_dir

LENGTH, SEED = 50, 20
#: Anchors to a range, bytes of stretches to a shard and to a block in it, stretches of one anchor in a shard.
RANGE_ANCHORS, SHARD_BYTES, BLOCK_BYTES, CROWD = 1 << 20, 1 << 20, 1_000_000, 10_000
#: Documents (their numbers take 16 bits) and text to a chunk, text to a bucket, buckets at most.
CHUNK_ROWS, CHUNK_BYTES, BUCKET_BYTES, MOST_BUCKETS = 1 << 15, 1 << 20, 16 << 20, 50_000
NO_ID = -(1 << 63)
WHOLE, DIFFERS, CROWDED = 1, 2, 3
#: Stands between stretches; no byte of UTF-8.
_BETWEEN = 0xFF
_CHUNK = "chunk bigint, ids array<bigint>, sizes array<int>, packed binary"


def store_chunks(docs: DataFrame, total: int) -> DataFrame:
    """Documents in rows of about ``CHUNK_BYTES``, written once: (chunk, ids, sizes, packed), bucketed by chunk."""
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, number = zstandard.ZstdCompressor(level=3), TaskContext.get().partitionId() << 32
        slices = (batch.slice(at, CHUNK_ROWS) for batch in batches for at in range(0, batch.num_rows, CHUNK_ROWS))
        for batch, texts in blocks(slices, most=CHUNK_BYTES):
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([batch.column("id").to_pylist()], pa.list_(pa.int64())),
                 pa.array([np.diff(texts.bounds).tolist()], pa.list_(pa.int32())),
                 pa.array([packer.compress(texts.data.tobytes())], pa.binary())], ["chunk", "ids", "sizes", "packed"])
            number += 1

    spark = docs.sparkSession
    path = fresh_dir(spark, "chunks")
    buckets = min(max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // BUCKET_BYTES), MOST_BUCKETS)
    # A table in the shared folder; the name only carries the bucketing.
    name = "chunks_" + path.rsplit("-", 1)[-1]
    (docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
                 F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
     .mapInArrow(gather, _CHUNK).write.bucketBy(buckets, "chunk").option("compression", "uncompressed")
     .option("path", path).saveAsTable(name))
    return spark.table(name)


def open_chunk(sizes: pa.Scalar, packed: pa.Scalar) -> Texts:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed.as_py()), np.uint8)
    return Texts(data, np.concatenate([[0], np.cumsum(sizes.values.to_numpy(), dtype=np.int64)]))


def stretches_of(texts: Texts, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of the anchor, first string and number of strings of every stretch."""
    windows = runs_inside(texts.bounds, length)
    if not len(windows):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.arange(len(texts.data) - seed + 1)
    grams = Slices(byte_values(texts.data)).hashes(at, at + seed)
    anchor = sliding_lowest(grams, length - seed + 1)[windows]
    first = np.flatnonzero(np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(windows) != 1)]))
    return grams[anchor[first]], windows[first], np.diff(np.append(first, len(windows)))


def _narrow(anchors: np.ndarray, bits: int) -> np.ndarray:
    """The 40 bits behind the first ``bits``."""
    return (anchors << np.uint64(bits)) >> np.uint64(24)


def _to_bytes(values: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _from_bytes(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return out.view(np.uint64).ravel()


class Stretches:
    """Stretches of a chunk in the order of their ranges: anchor, first byte, stop, document."""

    def __init__(self, texts: Texts, bits: int, length: int, seed: int):
        anchors, first, count = stretches_of(texts, length, seed)
        ranges = (anchors >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(anchors), np.int64)
        order = np.argsort(ranges, kind="stable")
        self.anchors, self.first, self.ranges = anchors[order], first[order], ranges[order]
        self.stop = self.first + count[order] + length - 1
        self.document = np.searchsorted(texts.bounds, self.first, "right") - 1
        self.place = self.first - texts.bounds[self.document]


def judge_stretches(anchors: np.ndarray, contents: np.ndarray, owner: np.ndarray, crowd: int) -> np.ndarray:
    """Status of every stretch among all that may share its anchor."""
    status = np.zeros(len(anchors), np.uint8)
    ordered = np.sort(anchors)
    common = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(common):
        return status
    at = np.minimum(np.searchsorted(common, anchors), len(common) - 1)
    mine = np.flatnonzero(common[at] == anchors)
    group, owner = at[mine], owner[mine]
    low, high = np.full(len(common), np.iinfo(np.int64).max), np.full(len(common), np.iinfo(np.int64).min)
    np.minimum.at(low, group, owner)
    np.maximum.at(high, group, owner)
    kept = np.flatnonzero(low[group] < high[group])
    if not len(kept):
        return status
    mine, group, owner = mine[kept], group[kept], owner[kept]
    order = np.lexsort((owner, contents[mine], group))
    mine, group, owner = mine[order], group[order], owner[order]
    contents = contents[mine]
    new = np.concatenate([[True], (np.diff(group) != 0) | (contents[1:] != contents[:-1])])
    head = np.flatnonzero(new)
    variants = np.bincount(group[head], minlength=len(common))
    first = owner == owner[head][np.cumsum(new) - 1]
    differs = first & (variants[group] > 1)
    crowded = np.bincount(group[differs], minlength=len(common)) > crowd
    status[mine] = np.where(~first, WHOLE, np.where(differs, np.where(crowded[group], CROWDED, DIFFERS), 0))
    return status


def statuses(chunks: DataFrame, bits: int, length: int, seed: int, crowd: int) -> DataFrame:
    """(chunk, range, status, differing): a byte for every stretch of a chunk in that range."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, ids, sizes, packed in zip(*(batch.column(c) for c in ("chunk", "ids", "sizes", "packed")),
                                                 strict=True):
                texts = open_chunk(sizes, packed)
                found = Stretches(texts, bits, length, seed)
                content = Slices(byte_values(texts.data)).hashes(found.first, found.stop)
                short = _narrow(found.anchors, bits)
                edges = np.flatnonzero(np.concatenate([[True], np.diff(found.ranges) != 0])[:len(short)])
                cuts = list(zip(edges.tolist(), np.append(edges[1:], len(short)).tolist(), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk.as_py()] * len(cuts), pa.int64()), pa.array(found.ranges[edges]),
                     pa.array([ids.as_py()] * len(cuts), pa.list_(pa.int64())),
                     pa.array([_to_bytes(short[a:b], 5) for a, b in cuts], pa.binary()),
                     pa.array([_to_bytes(content[a:b], 6) for a, b in cuts], pa.binary()),
                     pa.array([found.document[a:b].astype("<u2").tobytes() for a, b in cuts], pa.binary())],
                    ["chunk", "range", "ids", "anchors", "contents", "docs"])

    def merge(table: pa.Table) -> pa.Table:
        raw = {c: table[c].to_pylist() for c in ("anchors", "contents", "docs")}
        sizes = [len(x) // 5 for x in raw["anchors"]]
        anchors = np.concatenate([_from_bytes(x, 5) for x in raw["anchors"]])
        contents = np.concatenate([_from_bytes(x, 6) for x in raw["contents"]])
        owner = np.concatenate([ids.values.to_numpy()[np.frombuffer(d, "<u2")]
                                for ids, d in zip(table["ids"], raw["docs"], strict=True)])
        status = np.zeros(len(anchors), np.uint8)
        part = (anchors >> np.uint64(37)).astype(np.uint8)
        for number in range(8):  # by the next three bits of the anchor, for less memory at once
            mine = np.flatnonzero(part == number)
            status[mine] = judge_stretches(anchors[mine], contents[mine], owner[mine], crowd)
        parts = np.split(status, np.cumsum(sizes)[:-1])
        some = [i for i, x in enumerate(parts) if x.any()]
        rows = pa.array(some, pa.int64())
        return pa.table([table["chunk"].take(rows), table["range"].take(rows),
                         pa.array([parts[i].tobytes() for i in some], pa.binary()),
                         pa.array([int((parts[i] == DIFFERS).sum()) for i in some], pa.int64())],
                        ["chunk", "range", "status", "differing"])

    path = fresh_dir(chunks.sparkSession, "statuses")
    (chunks.mapInArrow(send, "chunk bigint, range bigint, ids array<bigint>, anchors binary, contents binary, docs binary")
     .groupBy("range").applyInArrow(merge, "chunk bigint, range bigint, status binary, differing bigint")
     .write.parquet(path))
    return chunks.sparkSession.read.parquet(path)


_GROUP = ("shard bigint, chunk bigint, ids array<bigint>, docs array<int>, places array<int>, sizes array<int>, "
          "packed binary")
_NO_SHARD, _CROWD_SHARD = -1, -2


def dealt_stretches(chunks: DataFrame, status: DataFrame, shards: int, bits: int, length: int, seed: int) -> DataFrame:
    """Stretches to be looked at, packed by chunk and shard; those that go whole have no text."""
    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            chunk, packer = left["chunk"][0].as_py(), zstandard.ZstdCompressor(level=1)
            texts, ids = open_chunk(left["sizes"][0], left["packed"][0]), left["ids"][0].values.to_numpy()
            found = Stretches(texts, bits, length, seed)
            mark = np.zeros(len(found.anchors), np.uint8)
            for range_, raw in zip(right["range"].to_pylist(), right["status"].to_pylist(), strict=True):
                begin = np.searchsorted(found.ranges, range_)
                mark[begin:begin + len(raw)] = np.frombuffer(raw, np.uint8)
            shard = np.where(mark == DIFFERS, (mix(found.anchors) % np.uint64(shards)).astype(np.int64),
                             np.where(mark == WHOLE, _NO_SHARD, _CROWD_SHARD))
            some = np.flatnonzero(mark)
            some = some[np.lexsort((found.first[some], shard[some]))]
            edges = np.flatnonzero(np.concatenate([[True], np.diff(shard[some]) != 0])[:len(some)])
            raw = texts.data.tobytes()
            for a, b in zip(edges.tolist(), np.append(edges[1:], len(some)).tolist(), strict=True):
                rows = some[a:b]
                starts, stops = found.first[rows], found.stop[rows]
                number = int(shard[rows[0]])
                text = b"" if number == _NO_SHARD else b"".join(
                    raw[x:y] for x, y in zip(starts.tolist(), stops.tolist(), strict=True))
                out.append((number, chunk, ids[found.document[rows]], found.document[rows], found.place[rows],
                            stops - starts, packer.compress(text)))
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), *[pa.list_(pa.int32())] * 3, pa.binary()]
        names = ["shard", "chunk", "ids", "docs", "places", "sizes", "packed"]
        return pa.table([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)

    return stored(chunks.groupBy("chunk").cogroup(status.groupBy("chunk")).applyInArrow(cut, _GROUP), "stretches")


def _opened(table: pa.Table | pa.RecordBatch) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, id, chunk, document and place of every stretch of some rows."""
    unpack = zstandard.ZstdDecompressor().decompress
    texts: list[bytes] = []
    for sizes, packed in zip(table["sizes"].to_pylist(), table["packed"].to_pylist(), strict=True):
        raw, at = unpack(packed), 0
        for size in sizes:
            texts.append(raw[at:at + size])
            at += size
    lists = {c: table[c].to_pylist() for c in ("ids", "docs", "places")}
    counts = [len(x) for x in lists["ids"]]
    flat = {c: np.array([v for x in lists[c] for v in x], np.int64) for c in lists}
    return texts, flat["ids"], np.repeat(table["chunk"].to_numpy(), counts), flat["docs"], flat["places"]


class Block:
    """Suffix array over some stretches: their distinct strings, sorted, with the smallest id of each."""

    def __init__(self, texts: list[bytes], ids: np.ndarray, length: int):
        sizes = np.array([len(t) for t in texts])
        self.starts = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
        data = np.frombuffer(bytes([_BETWEEN]).join([*texts, b""]), np.uint8)
        order, rank = suffix_array(data)
        prefixes = common_prefixes(data, order, rank, length)
        run = np.cumsum(prefixes[order] < length) - 1
        counts = sizes - length + 1
        self.places = np.repeat(self.starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        self.of = np.repeat(np.arange(len(texts)), counts)
        runs = run[rank[self.places]]
        # Runs that hold strings, in the order of the suffix array.
        used, self.string = np.unique(runs, return_inverse=True)
        self.lowest = np.full(len(used), np.iinfo(np.int64).max)
        np.minimum.at(self.lowest, self.string, ids[self.of])
        example = np.zeros(len(used), np.int64)
        example[self.string] = self.places
        self.hashes = Slices(byte_values(data)).hashes(example, example + length)


def merge_blocks(parts: list[Block]) -> list[np.ndarray]:
    """Smallest id of every string of every block over all blocks, by binary search in their sorted hashes."""
    if len(parts) == 1:
        return [parts[0].lowest]
    values = np.concatenate([p.hashes for p in parts])
    keys = np.unique(values)
    lowest = np.full(len(keys), np.iinfo(np.int64).max)
    for part in parts:
        np.minimum.at(lowest, np.searchsorted(keys, part.hashes), part.lowest)
    return [lowest[np.searchsorted(keys, part.hashes)] for part in parts]


_RANGE = "chunk bigint, doc int, begin bigint, end bigint"


def _ranges(chunk: np.ndarray, doc: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(chunk, pa.int64()), pa.array(doc, pa.int32()), pa.array(begin, pa.int64()), pa.array(end, pa.int64())],
        ["chunk", "doc", "begin", "end"])


def shard_ranges(dealt: DataFrame, length: int) -> DataFrame:
    def find(table: pa.Table) -> pa.Table:
        texts, ids, chunk, doc, place = _opened(table)
        parts, begin, held = [], 0, 0
        for end in range(len(texts) + 1):
            if end == len(texts) or held + len(texts[end]) + 1 > BLOCK_BYTES:
                if end > begin:
                    parts.append((begin, Block(texts[begin:end], ids[begin:end], length)))
                begin, held = end, 0
            if end < len(texts):
                held += len(texts[end]) + 1
        out = []
        for (offset, block), lowest in zip(parts, merge_blocks([b for _, b in parts]), strict=True):
            gone = lowest[block.string] < ids[offset + block.of]
            marks = np.zeros(block.places[-1] + 2, bool)  # places of two stretches never touch
            marks[block.places[gone]] = True
            b, e = true_runs(marks)
            owner = np.searchsorted(block.starts, b, "right") - 1
            row = offset + owner
            shift = place[row] - block.starts[owner]
            out.append(_ranges(chunk[row], doc[row], b + shift, e + shift + length - 1))
        return pa.Table.from_batches(out)

    return dealt.where(F.col("shard") >= 0).groupBy("shard").applyInArrow(find, _RANGE)


def crowded_ranges(dealt: DataFrame, length: int) -> DataFrame:
    """The same for stretches of crowded anchors, string by string."""
    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                texts, ids, chunk, doc, place = _opened(batch.slice(at, 1))
                bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
                data = np.frombuffer(b"".join(texts), np.uint8)
                start = runs_inside(bounds, length)
                row = np.searchsorted(bounds, start, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(Slices(byte_values(data)).hashes(start, start + length).view(np.int64)), pa.array(ids[row]),
                     pa.array(chunk[row]), pa.array(doc[row], pa.int32()), pa.array(place[row] + start - bounds[row])],
                    ["string", "id", "chunk", "doc", "begin"])

    rows = stored(dealt.where(F.col("shard") == _CROWD_SHARD).mapInArrow(
        strings, "string bigint, id bigint, chunk bigint, doc int, begin bigint"), "strings")
    lowest = rows.groupBy("string").agg(F.min("id").alias("low"), F.max("id").alias("high")).where(
        F.col("low") < F.col("high")).select("string", "low")
    gone = rows.join(stored(lowest, "lowest"), "string").where(F.col("low") < F.col("id"))
    return gone.select("chunk", "doc", "begin", (F.col("begin") + length).alias("end"))


def whole_ranges(dealt: DataFrame) -> DataFrame:
    at = F.explode(F.arrays_zip("docs", "places", "sizes")).alias("at")
    begin = F.col("at.places").cast("long")
    return dealt.where(F.col("shard") == _NO_SHARD).select("chunk", at).select(
        "chunk", F.col("at.docs").alias("doc"), begin.alias("begin"), (begin + F.col("at.sizes")).alias("end"))


def removed_ranges(chunks: DataFrame, total: int, length: int = LENGTH, seed: int = SEED,
                   crowd: int = CROWD) -> DataFrame:
    """(chunk, doc, begin, end) of all removed bytes; ``doc`` counts documents of the chunk."""
    bits = max(0, (total // 16 // RANGE_ANCHORS).bit_length())
    status = statuses(chunks, bits, length, seed, crowd)
    differing = status.agg(F.sum("differing")).first()[0] or 0
    shards = max(1, differing * (2 * length) // SHARD_BYTES)
    dealt = dealt_stretches(chunks, status, shards, bits, length, seed)
    return shard_ranges(dealt, length).union(crowded_ranges(dealt, length)).union(whole_ranges(dealt))


def kept_bytes(docs: DataFrame, length: int = LENGTH, seed: int = SEED, crowd: int = CROWD) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` of ``docs`` (doc_id, text); ``kept`` is what stays, joined."""
    total = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    chunks = store_chunks(docs, total)
    path = fresh_dir(docs.sparkSession, "ranges")
    removed_ranges(chunks, total, length, seed, crowd).write.parquet(path)
    ranges = docs.sparkSession.read.parquet(path)

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows:
            texts, ids = open_chunk(left["sizes"][0], left["packed"][0]), left["ids"][0].as_py()
            offset = texts.bounds[right["doc"].to_numpy()]
            gone = covered(right["begin"].to_numpy() + offset, right["end"].to_numpy() + offset, len(texts.data))
            for i, id_ in enumerate(ids):
                a, b = texts.bounds[i], texts.bounds[i + 1]
                mine = gone[a:b]
                out.append((None if id_ == NO_ID else id_, b - a, int(mine.sum()), len(true_runs(mine)[0]),
                            texts.data[a:b][~mine].tobytes()))
        kinds = [pa.int64()] * 4 + [pa.binary()]
        return pa.table([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)],
                        ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return chunks.groupBy("chunk").cogroup(ranges.groupBy("chunk")).applyInArrow(
        cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
