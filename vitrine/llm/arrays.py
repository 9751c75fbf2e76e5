"""Array code shared by the text operators: byte blocks, words, hashes and sliding minima.

All functions work on one block of documents (a few MB) inside a task.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text of a block. Arrays of 64-bit numbers per byte take eight times as much, a handful at once.
BLOCK_BYTES = 1 << 19
_STEP = 0x9E3779B97F4A7C15
_BASE = 0xD6E8FEB86659FD93
_MOD = 1 << 64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers over all 64 bits."""
    x = x + np.uint64(_STEP)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_STEP)) | np.uint64(1)

def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


class Slices:
    """Hashes of any slice of a sequence of 64-bit values, equal for equal slices wherever they stand."""

    def __init__(self, values: np.ndarray):
        self._down = _powers(pow(_BASE, -1, _MOD), len(values) + 1)
        self._sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * _powers(_BASE, len(values) + 1)[:-1], out=self._sums[1:])

    def hashes(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        raw = (self._sums[stop] - self._sums[start]) * self._down[start]
        return mix(raw + (stop - start).astype(np.uint64) * np.uint64(_BASE))


def byte_values(data: np.ndarray, fold: bool = False) -> np.ndarray:
    """A 64-bit value for every byte; with ``fold`` A-Z have those of a-z."""
    table = _BYTE_VALUES
    if fold:
        table = table.copy()
        table[65:91] = table[97:123]
    return table[data]


class Texts(NamedTuple):
    """Bytes of consecutive documents; document i is ``data[bounds[i]:bounds[i + 1]]``."""

    data: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.bounds[i]:self.bounds[i + 1]].tobytes()


def text_bytes(column: pa.Array) -> Texts:
    """UTF-8 bytes of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    if len(column) == 0:
        return Texts(np.empty(0, np.uint8), np.zeros(1, np.int64))
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    whole = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return Texts(whole[bounds[0]:bounds[-1]], bounds - bounds[0])


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text",
           most: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Cut batches into runs of rows with about ``most`` bytes of text; a longer text is a run of its own."""
    give_back()  # what the last task of this worker has left
    for batch in batches:
        texts = text_bytes(batch.column(column))
        begin = 0
        while begin < len(texts):
            end = int(np.searchsorted(texts.bounds, texts.bounds[begin] + most, "right")) - 1
            end = min(max(end, begin + 1), len(texts))
            bounds = texts.bounds[begin:end + 1]
            yield batch.slice(begin, end - begin), Texts(texts.data[bounds[0]:bounds[-1]], bounds - bounds[0])
            begin = end
        # Workers live on; what Arrow held for a large batch goes back to the system.
        pa.default_memory_pool().release_unused()
    give_back()


def give_back() -> None:
    """Memory that Python has freed goes back to the system where the C library can do that, as workers live on."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def byte_class(inside) -> np.ndarray:
    """Table over the 256 bytes: does a byte belong to a word?"""
    return np.array([bool(inside(b)) for b in range(256)])


#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` over A-Z lowered: digits, letters and every byte of a longer code point.
WORDS_FOLDED = byte_class(lambda b: 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)
#: ``[^\x20\x09-\x0D]+``: whatever stands between white space.
WORDS_SPACED = byte_class(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)


class Words(NamedTuple):
    """Words of a block: byte range of each, and the index of the first word of every document (and the end)."""

    start: np.ndarray
    stop: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def document(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def find_words(texts: Texts, table: np.ndarray) -> Words:
    inside = table[texts.data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    filled = texts.bounds[:-1] < texts.bounds[1:]
    for marks, edges in ((begins, texts.bounds[:-1][filled]), (ends, texts.bounds[1:][filled] - 1)):
        marks[edges] = inside[edges]
    start = np.flatnonzero(begins)
    return Words(start, np.flatnonzero(ends) + 1, np.searchsorted(start, texts.bounds))


def word_hashes(texts: Texts, words: Words, fold: bool = False) -> np.ndarray:
    return Slices(byte_values(texts.data, fold)).hashes(words.start, words.stop)


def runs_inside(first: np.ndarray, length: int) -> np.ndarray:
    """Starts of all runs of ``length`` items that stay inside their document."""
    n = int(first[-1])
    ok = np.zeros(n + 1, np.int64)
    sizes = np.diff(first)
    long = sizes >= length
    np.add.at(ok, first[:-1][long], 1)
    np.add.at(ok, first[1:][long] - length + 1, -1)
    return np.flatnonzero(np.cumsum(ok[:n]) > 0) if n else np.empty(0, np.int64)


def sliding_lowest(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the lowest of every ``width`` neighbours, the leftmost of equal ones.

    The low bits of the values give way to positions, so that one minimum finds both.
    """
    n = len(values)
    bits = np.uint64(max(1, int(n).bit_length()))
    low = (values >> bits << bits) | np.arange(n, dtype=np.uint64)
    reach = 1
    while reach * 2 <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    rest = width - reach
    low = np.minimum(low[:len(low) - rest], low[rest:]) if rest else low
    return (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def list_column(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Arrow lists out of flat values and their bounds."""
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def covered(starts: np.ndarray, stops: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` places lie in any of the half-open ranges."""
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, stops, -1)
    return np.cumsum(marks[:n]) > 0


def true_runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2]
