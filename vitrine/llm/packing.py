"""Best-fit packing of token sequences ("best-two-fit").

Documents become token ids plus an end id. Those longer than a sequence are cut
into full pieces and a rest. Pieces are dealt at random into groups of bounded
size, and every group is packed by itself: a sequence is filled with the longest
pieces that fit, then its smallest piece is replaced as long as two unpacked
pieces fill the widened gap more tightly. Only lengths are needed, so a group
costs little memory, and the loss against packing all at once is about one
sequence for each group.

Null or empty text: one piece that holds the end id alone. Repeated rows are
packed each. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.arrays import blocks
from vitrine.llm.tokens import SPACES, added_pattern, added_tokens, tokenizer

#: Documents to a group.
GROUP_ROWS = 16_384
#: Parts of words whose ids a task remembers, and text it looks at together.
PARTS_KEPT, BLOCK_BYTES = 300_000, 1 << 20
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_WORD = re.compile(f"[^{SPACES}]+")
#: ASCII and Latin letters that normalisation leaves alone and that have one lower form.
_PLAIN = re.compile("[\\0-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
_LETTERS = "a-z\u00df-\u00f6\u00f8-\u00ff"
_PARTS = re.compile(f"[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\\t-\\r 0-9{_LETTERS}]+")


class WordIds:
    """Ids of texts as little-endian bytes, each distinct part of a word encoded once in a task.

    Holds for a tokenizer that lowers its text, drops white space, splits words by
    the rule of ``_PARTS`` and marks each split's last piece with ``</w>``. Texts
    of plain Latin letters are split here, and the new parts of a block are encoded
    together, separated by blanks. Any other text is split at white space, and its
    words go to the library one by one.
    """

    def __init__(self, path: str):
        self._library = tokenizer(path)
        size = self._library.get_vocab_size()
        self._last = np.array([(self._library.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self._parts: dict[str, bytes] = {}
        self._words: dict[str, bytes] = {}

    def split(self, text: str) -> tuple[bool, list[str]]:
        """Is the text plain, and its parts or else its words."""
        if text.isascii() or _PLAIN.fullmatch(text):
            return True, _PARTS.findall(text.lower())
        return False, _WORD.findall(text) if _ODD_SPACE.search(text) else text.split()

    def learn(self, texts: list[tuple[bool, list[str]]]) -> None:
        """Make the ids of all these parts and words known."""
        for held in (self._parts, self._words):
            if len(held) > PARTS_KEPT:
                held.clear()
        parts = list(set().union(*(x for plain, x in texts if plain)).difference(self._parts))
        groups = [parts[i:i + 200] for i in range(0, len(parts), 200)]
        found = self._library.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)
        for group, encoded in zip(groups, found, strict=True):
            ids = np.array(encoded.ids, "<u4")
            stops = (4 * (np.flatnonzero(self._last[ids]) + 1)).tolist()
            raw, at = ids.tobytes(), 0
            for part, stop in zip(group, stops, strict=True):
                self._parts[part] = raw[at:stop]
                at = stop
        for word in set().union(*(x for plain, x in texts if not plain)).difference(self._words):
            ids = self._library.encode(word, add_special_tokens=False).ids
            self._words[word] = np.array(ids, "<u4").tobytes()

    def ids_of(self, split: tuple[bool, list[str]]) -> bytes:
        known = self._parts if split[0] else self._words
        return b"".join(map(known.__getitem__, split[1]))


def token_pieces(docs: DataFrame, path: str, end_id: int, capacity: int) -> DataFrame:
    """One row per piece: row, doc_id, piece, start, length, ids_crc32."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, added = WordIds(path), {k: np.array([v], "<u4").tobytes() for k, v in added_tokens(path).items()}
        special = added_pattern(added)
        for batch, _ in blocks(batches, most=BLOCK_BYTES):
            out: dict[str, list] = {k: [] for k in ("row", "doc_id", "piece", "start", "length", "ids_crc32")}
            # A text is split at special strings first; every second part is one.
            parts = [special.split(x) if special and special.search(x) else [x]
                     for x in (t or "" for t in batch.column("text").to_pylist())]
            split = [[known.split(p) if i % 2 == 0 else p for i, p in enumerate(x)] for x in parts]
            known.learn([p for x in split for p in x[::2]])
            for row, doc_id, mine in zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), split,
                                         strict=True):
                ids = b"".join([*(known.ids_of(p) if i % 2 == 0 else added[p] for i, p in enumerate(mine)), end])
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    for name, value in (("row", row), ("doc_id", doc_id), ("piece", piece), ("start", at // 4),
                                        ("length", len(part) // 4), ("ids_crc32", zlib.crc32(part))):
                        out[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, pa.int32() if k == "piece" else pa.int64()) for k, v in out.items()], list(out))

    return docs.mapInArrow(
        cut, "row bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_two_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Indices of ``lengths`` by sequence.

    The lengths that are left form the bits of one number, so the longest that
    fits, and the best sum of two, are found by shifts.
    """
    waiting: dict[int, list[int]] = defaultdict(list)
    for i, n in enumerate(lengths):
        waiting[n].append(i)
    left = sum(1 << n for n in waiting)
    mirrored = sum(1 << (capacity - n) for n in waiting)
    out = []

    def take(n: int) -> int:
        nonlocal left, mirrored
        item = waiting[n].pop()
        if not waiting[n]:
            left ^= 1 << n
            mirrored ^= 1 << (capacity - n)
        return item

    def give_back(n: int, item: int) -> None:
        nonlocal left, mirrored
        if not waiting[n]:
            left |= 1 << n
            mirrored |= 1 << (capacity - n)
        waiting[n].append(item)

    def tightest_two(most: int, least: int) -> tuple[int, int] | None:
        """Two waiting lengths with the largest sum from ``least`` to ``most``."""
        for total in range(most, least - 1, -1):
            hits = left & (mirrored >> (capacity - total))
            if total % 2 == 0 and len(waiting.get(total // 2, ())) == 1:
                hits &= ~(1 << (total // 2))
            if hits:
                high = hits.bit_length() - 1
                return high, total - high
        return None

    while left:
        gap, bin_ = capacity, []
        while fits := left & ((1 << (gap + 1)) - 1):
            n = fits.bit_length() - 1
            bin_.append((n, take(n)))
            gap -= n
        while gap and bin_ and left:
            smallest, item = bin_[-1]
            two = tightest_two(gap + smallest, smallest + 1)
            if two is None:
                break
            bin_.pop()
            bin_ += [(n, take(n)) for n in two]
            bin_.sort(key=lambda x: -x[0])
            give_back(smallest, item)
            gap += smallest - sum(two)
        out.append([item for _, item in bin_])
    return out


def pack(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1,
         group_rows: int = GROUP_ROWS) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece of ``docs`` (doc_id, text)."""
    groups = max(1, -(-docs.count() // group_rows))
    plain = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
    pieces = token_pieces(plain, path, end_id, capacity).withColumn(
        "group", F.pmod(F.xxhash64("row", "piece"), F.lit(groups)))

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["row", "piece"], ignore_index=True)
        number, offset = np.empty(len(group), np.int64), np.empty(len(group), np.int64)
        lengths = group["length"].tolist()
        for i, members in enumerate(best_two_fit(lengths, capacity)):
            at = 0
            for member in members:
                number[member], offset[member] = i, at
                at += lengths[member]
        group["sequence_id"] = (np.int64(group["group"].iloc[0]) << 32) + number
        group["offset"] = offset
        return group.drop(columns=["group", "row"])

    return pieces.groupBy("group").applyInPandas(
        fill, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
              "sequence_id bigint, offset bigint")
