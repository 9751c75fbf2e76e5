"""Product codes of vectors: every part of a vector becomes the number of its nearest codebook entry.

Components are whole numbers, ``floor(4096 x)``, so all sums and distances are exact and any engine can repeat them.

The nearest entry is found by slices and masks. Along every dimension of a part the coordinates of the entries are
sorted, and each rank carries the mask of all entries before it. A radius selects a range of ranks in every dimension;
the masks of the ranges (end less begin) ANDed over the dimensions leave the entries in the box around the vector.
The radius begins at half the usual distance between neighbouring entries and doubles where the box is empty. The
nearest entry in the box gives a distance, and a box of that distance holds every entry that is as near: among these
the nearest, of equal ones the first, is the answer.

Codebooks hold a few thousand numbers whatever the data and travel with the tasks. A round is one pass over the stored
vectors; each task adds up its vectors by entry, and only these sums are shuffled.

Rows whose vector is null, empty, or has components that are null or not finite are dropped, and so are vectors of
another width than the commonest (the smaller on ties). A null ``vec_id`` is coded and stands behind all ids when the
first entries are chosen; rows with equal ids count in the order of their vectors. Repeated rows are coded each. With
fewer rows than entries there are as many entries as rows. An empty table gives no rows. Other columns are ignored.
Components of 2^15 and more in size are an error: their squares can't be summed in 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.substrings import stored

SCALE = 4096
LARGEST = 1 << 27
WORD = 64
#: Components a task works on at once.
RUN = 1 << 19
_CODED = "vec_id bigint, label int, code string, error bigint"


class PartBook:
    """Entries of one part position, with the masks of every dimension."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        n, width = entries.shape
        self.words = -(-n // WORD)
        order = np.argsort(entries, axis=0, kind="stable")
        self.coordinates = np.take_along_axis(entries, order, axis=0)
        bits = np.zeros((n, width, self.words), np.uint64)
        bits[np.arange(n)[:, None], np.arange(width), order // WORD] = np.uint64(1) << (order % WORD).astype(np.uint64)
        self.before = np.zeros((n + 1, width, self.words), np.uint64)
        np.bitwise_or.accumulate(bits, axis=0, out=self.before[1:])
        self.radius = self._usual_gap() // 2 + 1

    def _usual_gap(self) -> int:
        """Median distance of an entry to the next one, along the dimension in which they differ most."""
        gaps = np.abs(self.entries[:, None] - self.entries).max(axis=2)
        np.fill_diagonal(gaps, np.iinfo(np.int64).max)
        return int(np.median(gaps.min(axis=1))) if len(gaps) > 1 else 0

    def box(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks of the entries within ``radius`` of each point in every dimension."""
        masks = np.full((len(points), self.words), np.uint64(0xFFFFFFFFFFFFFFFF))
        for d in range(points.shape[1]):
            low = np.searchsorted(self.coordinates[:, d], points[:, d] - radius, "left")
            high = np.searchsorted(self.coordinates[:, d], points[:, d] + radius, "right")
            masks &= self.before[high, d] ^ self.before[low, d]
        return masks

    def best(self, points: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First of the nearest entries in each (not empty) mask, and its squared distance."""
        places = np.arange(len(self.entries), dtype=np.uint64)
        inside = masks[:, places // np.uint64(WORD)] >> (places % np.uint64(WORD)) & np.uint64(1)
        row, entry = np.nonzero(inside)
        far = ((points[row] - self.entries[entry]) ** 2).sum(axis=1)
        first = np.searchsorted(row, np.arange(len(points)))
        least = np.minimum.reduceat(far, first)
        hits = np.flatnonzero(far == least[row])
        chosen = hits[np.searchsorted(row[hits], np.arange(len(points)))]
        return entry[chosen], least

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of every point, the lowest of equal ones, and the squared distance."""
        index, far = np.zeros(len(points), np.int64), np.zeros(len(points), np.int64)
        radius = np.full(len(points), self.radius, np.int64)
        open_ = np.arange(len(points))
        while len(open_):
            masks = self.box(points[open_], radius[open_])
            filled = masks.any(axis=1)
            here = open_[filled]
            if len(here):
                index[here], far[here] = self.best(points[here], masks[filled])
            needed = isqrt(far[here])
            unsure = needed > radius[here]
            radius[here] = needed
            empty = open_[~filled]
            radius[empty] *= 2
            open_ = np.concatenate([empty, here[unsure]])
        return index, far


def isqrt(values: np.ndarray) -> np.ndarray:
    """Whole part of square roots; a root of doubles is off by one at most."""
    root = np.sqrt(values.astype(np.float64)).astype(np.int64)
    root -= root * root > values
    return root + ((root + 1) * (root + 1) <= values)


def whole_numbers(column: pa.Array, width: int) -> np.ndarray:
    """Rows of floor(4096 x); scaling by a power of two is exact."""
    values = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    if len(values) and np.abs(values).max() >= LARGEST:
        raise ValueError(f"components of {LARGEST // SCALE} and more can't be coded exactly")
    return values.astype(np.int64).reshape(-1, width)


def runs(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``RUN`` components, so that wide vectors take no more memory than narrow ones."""
    rows = max(1, RUN // width)
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def usable_vectors(embeddings: DataFrame) -> DataFrame:
    """``vec_id, label, embedding`` of the rows whose vector is there and finite."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"),
                             "embedding").where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & finite)


def entry_sums(vectors: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """``part, entry, place, total, n``: sums of the parts nearest to every entry."""
    parts, (_, wide) = len(books), books[0].shape

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = [PartBook(b) for b in books]
        totals, counts = [np.zeros_like(b) for b in books], [np.zeros(len(b), np.int64) for b in books]
        for batch in runs(batches, parts * wide):
            values = whole_numbers(batch.column("embedding"), parts * wide).reshape(-1, parts, wide)
            for part in range(parts):
                entry, _ = index[part].nearest(values[:, part])
                np.add.at(totals[part], entry, values[:, part])
                counts[part] += np.bincount(entry, minlength=len(counts[part]))
        for part in range(parts):
            used = np.flatnonzero(counts[part])
            n = len(used) * wide
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part, np.int32)), pa.array(np.repeat(used, wide).astype(np.int32)),
                 pa.array(np.tile(np.arange(wide, dtype=np.int32), len(used))),
                 pa.array(totals[part][used].ravel()), pa.array(np.repeat(counts[part][used], wide))],
                ["part", "entry", "place", "total", "n"])

    sums = vectors.select("embedding").mapInArrow(add_up, "part int, entry int, place int, total bigint, n bigint")
    return sums.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def train(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6) -> list[np.ndarray]:
    """Codebooks by part position, from usable vectors of one width; no list of books without vectors."""
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").collect()
    if not first:
        return []
    width = len(first[0][0])
    if width % parts:
        raise ValueError(f"{width} components can't be cut into {parts} equal parts")
    start = whole_numbers(pa.array([r[0] for r in first], pa.list_(pa.float64())), width)
    books = [np.ascontiguousarray(x) for x in start.reshape(-1, parts, width // parts).swapaxes(0, 1)]
    for _ in range(rounds):
        # As many rows as the books have numbers.
        for r in entry_sums(vectors, books).collect():
            books[r["part"]][r["entry"], r["place"]] = r["total"] // r["n"]
    return books


def encode(vectors: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """``vec_id, label, code, error``: two hex digits a part, and the squared distances summed over the parts."""
    parts, (_, wide) = len(books), books[0].shape
    digits = np.array([f"{i:02x}" for i in range(len(books[0]))])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = [PartBook(b) for b in books]
        for batch in runs(batches, parts * wide):
            values = whole_numbers(batch.column("embedding"), parts * wide).reshape(-1, parts, wide)
            found = [index[part].nearest(values[:, part]) for part in range(parts)]
            codes = digits[np.stack([entry for entry, _ in found], axis=1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(["".join(x) for x in codes.tolist()], pa.string()),
                 pa.array(np.sum([far for _, far in found], axis=0, dtype=np.int64))],
                ["vec_id", "label", "code", "error"])

    return vectors.select("vec_id", "label", "embedding").mapInArrow(code, _CODED)


def books_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def compress(embeddings: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6) -> tuple[DataFrame, list[np.ndarray]]:
    """(``vec_id, label, code, error, label_error`` of every usable row, the codebooks).

    ``label_error`` is the error of all rows with the same label, nulls being one label.
    """
    vectors = stored(usable_vectors(embeddings), "vectors")
    widths = vectors.groupBy(F.size("embedding").alias("width")).count().orderBy(F.desc("count"), "width").first()
    if widths is None:
        return embeddings.sparkSession.createDataFrame([], f"{_CODED}, label_error bigint"), []
    vectors = vectors.where(F.size("embedding") == widths["width"])
    books = train(vectors, parts, entries, rounds)
    coded = stored(encode(vectors, books), "codes")
    # Both sides are stored, so few labels are known to be few, and with many a hot one is split.
    totals = stored(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label-errors")
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of"))).drop("of"), books
