"""Benchmark decontamination by an FM-index over each shard of documents.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lowered. A
window is ``window`` consecutive words of a benchmark item; a shorter item that
has words is one window.

Windows come to the tasks in blocks of at most ``block_bytes`` of benchmark text,
one pass over the documents for each block, so what is broadcast is bounded
whatever the benchmark's size. In a task, words that no window of the block holds
break a document into stretches; stretches too short for any window are left
out, and over the rest an FM-index is built: suffix array, Burrows-Wheeler
transform, wavelet tree. What is too long for one index is cut into shards; pieces
of one stretch overlap by a window less one word. Windows are searched backwards through its ranks, all at
once; occurrences are located by walking to the next sampled suffix position;
overlapping occurrences merge into spans. Nothing is shuffled.

Null or empty text: no words, no hits. Repeated rows: one result each. Items with
equal windows are all reported. Null item ids count as one item, listed
last. An empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.arrays import (
    WORDS_FOLDED,
    Texts,
    blocks,
    covered,
    find_words,
    text_bytes,
    word_hashes,
)
from vitrine.llm.suffixes import MOST, suffix_array

WINDOW = 10
#: Benchmark text to a pass.
BLOCK_BYTES = 8 << 20
#: Every so many text places keep their suffix position.
SAMPLED = 8
#: Symbols of an index, the breaks behind stretches among them; its end symbol comes on top.
SHARD = MOST - 1
_END, _BREAK = 0, 1  # symbols below those of words


class Windows(NamedTuple):
    """Distinct windows of a block: sorted word hashes; symbols right-aligned; lengths; items of each window."""

    vocabulary: np.ndarray
    symbols: np.ndarray
    lengths: np.ndarray
    item_bounds: np.ndarray
    items: list[str]


def windows_of(items: list[tuple[str, str]], window: int) -> Windows | None:
    texts = text_bytes(pa.array([t for _, t in items], pa.string()))
    words = find_words(texts, WORDS_FOLDED)
    hashes = word_hashes(texts, words, fold=True)
    vocabulary, symbol = np.unique(hashes, return_inverse=True)
    holders: dict[tuple, dict[str, None]] = {}
    for i, (item, _) in enumerate(items):
        mine = symbol[words.first[i]:words.first[i + 1]].tolist()
        for at in range(max(len(mine) - window, 0) + 1 if mine else 0):
            holders.setdefault(tuple(mine[at:at + window]), {})[item] = None
    if not holders:
        return None
    aligned = np.full((len(holders), window), -1, np.int64)
    for row, symbols in zip(aligned, holders, strict=True):
        row[window - len(symbols):] = symbols
    return Windows(vocabulary, aligned, np.array([len(w) for w in holders]),
                   np.cumsum([0, *(len(x) for x in holders.values())]), [i for x in holders.values() for i in x])


class WaveletTree:
    """Ranks of any symbol, level by level from its highest bit."""

    def __init__(self, sequence: np.ndarray, most: int):
        self._levels = []
        for bit in range(max(1, most.bit_length()) - 1, -1, -1):
            ones = (sequence >> bit) & 1
            before = np.concatenate([[0], np.cumsum(ones)])
            self._levels.append((bit, before, len(sequence) - before[-1]))
            sequence = np.concatenate([sequence[ones == 0], sequence[ones == 1]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        start = np.zeros(len(place), np.int64)
        for bit, before, zeros in self._levels:
            one = (symbol >> bit) & 1 == 1
            start = np.where(one, zeros + before[start], start - before[start])
            place = np.where(one, zeros + before[place], place - before[place])
        return place - start


class FmIndex:
    """Backward search over a sequence of symbols up to ``most`` that ends with a single ``_END``."""

    def __init__(self, sequence: np.ndarray, most: int):
        order, _ = suffix_array(sequence)
        self._transformed = sequence[order - 1]
        self._tree = WaveletTree(self._transformed, most)
        self._smaller = np.concatenate([[0], np.cumsum(np.bincount(sequence, minlength=most + 1))])
        self._sampled = order % SAMPLED == 0
        self._nth_sample = np.cumsum(self._sampled) - 1
        self._samples = order[self._sampled]
        self._size = len(sequence)

    def _step(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        return self._smaller[symbol] + self._tree.rank(symbol, place)

    def search(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows that occur, with begin and end of their range; symbols are right-aligned, -1 before."""
        which = np.arange(len(windows))
        low, high = np.zeros(len(windows), np.int64), np.full(len(windows), self._size)
        for column in range(windows.shape[1] - 1, -1, -1):
            symbol = windows[which, column]
            more = symbol >= 0
            low[more], high[more] = self._step(symbol[more], low[more]), self._step(symbol[more], high[more])
            some = low < high
            which, low, high = which[some], low[some], high[some]
        return which, low, high

    def locate(self, place: np.ndarray) -> np.ndarray:
        """Text places of suffixes, walked back to a sampled one."""
        place, out, waiting = place.copy(), np.zeros(len(place), np.int64), np.arange(len(place))
        steps = 0
        while len(waiting):
            here = self._sampled[place]
            out[waiting[here]] = self._samples[self._nth_sample[place[here]]] + steps
            waiting, place = waiting[~here], place[~here]
            place = self._step(self._transformed[place], place)
            steps += 1
        return out


class Hits(NamedTuple):
    """Per document of a block: words, and spans as word and byte ranges; (document, window) pairs."""

    n_words: np.ndarray
    spans: list[list[tuple[int, int, int, int]]]
    pairs: np.ndarray


def shards_of(start: np.ndarray, stop: np.ndarray, window: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Stretches in runs that fit an index; longer ones are cut into pieces that overlap by ``window`` - 1 words."""
    step = max(SHARD - 1 - window, 1)  # at most so many places of a stretch begin a window in one piece
    pieces = np.maximum(-(-(stop - start - window + 1) // step), 1)
    nth = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = np.repeat(start, pieces) + nth * step
    end = np.minimum(begin + step + window - 1, np.repeat(stop, pieces))
    filled = np.cumsum(end - begin + 1)  # with the break behind each
    low = 0
    while low < len(begin):
        before = filled[low - 1] if low else 0
        high = max(int(np.searchsorted(filled, before + SHARD, "right")), low + 1)
        yield begin[low:high], end[low:high]
        low = high


def search_stretches(at: np.ndarray, stretches: tuple[np.ndarray, np.ndarray],
                     known: Windows) -> tuple[np.ndarray, np.ndarray]:
    """First word and number of every window in stretches of known words; ``at`` numbers the words."""
    start, stop = stretches
    sizes = stop - start + 1  # with the break behind each
    total = int(sizes.sum())
    offset = np.cumsum(sizes) - sizes
    word_at = np.repeat(start - offset, sizes) + np.arange(total)
    sequence = np.append(at[np.minimum(word_at, len(at) - 1)] + 2, _END)
    sequence[np.append(offset[1:], total) - 1] = _BREAK
    index = FmIndex(sequence, len(known.vocabulary) + 1)
    which, low, high = index.search(np.where(known.symbols >= 0, known.symbols + 2, -1))
    times = high - low
    places = np.repeat(low - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
    return word_at[index.locate(places)], np.repeat(which, times)


def find_hits(texts: Texts, known: Windows) -> Hits:
    words = find_words(texts, WORDS_FOLDED)
    hashes = word_hashes(texts, words, fold=True)
    at = np.searchsorted(known.vocabulary, hashes)
    at[at == len(known.vocabulary)] = 0
    inside = known.vocabulary[at] == hashes
    n = len(hashes)
    # Stretches of known words inside one document, long enough for the shortest window.
    edges = np.zeros(n + 1, bool)
    edges[words.first[words.first <= n]] = True
    begins = inside & np.concatenate([[True], ~inside[:-1] | edges[1:n]])[:n]
    ends = inside & np.concatenate([~inside[1:] | edges[1:n], [True]])[:n]
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    long = stop - start >= known.lengths.min()
    start, stop = start[long], stop[long]
    spans: list[list] = [[] for _ in range(len(texts))]
    empty = Hits(words.counts(), spans, np.empty((0, 2), np.int64))
    if not len(start):
        return empty
    shards = [search_stretches(at, part, known) for part in shards_of(start, stop, known.symbols.shape[1])]
    first, window = (np.concatenate(x) for x in zip(*shards, strict=True))
    if not len(first):
        return empty
    document = words.document()
    hit = covered(first, first + known.lengths[window], n)
    # Spans end with their document: a hit run that goes on in the next one is cut at the edge.
    marked = np.flatnonzero(hit)
    new = np.concatenate([[True], (np.diff(marked) > 1) | (np.diff(document[marked]) > 0)])
    begin = marked[new]
    end = np.append(marked[np.flatnonzero(new)[1:] - 1], marked[-1]) + 1
    for d, b, e, x, y in zip(document[begin].tolist(), (begin - words.first[document[begin]]).tolist(),
                             (end - words.first[document[begin]]).tolist(),
                             (words.start[begin] - texts.bounds[document[begin]]).tolist(),
                             (words.stop[end - 1] - texts.bounds[document[begin]]).tolist(), strict=True):
        spans[d].append((b, e, x, y))
    return Hits(words.counts(), spans, np.unique(np.stack([document[first], window], 1), axis=0))


def merged(spans: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Union of word ranges (with their byte ranges), touching ones joined."""
    out: list[tuple[int, int, int, int]] = []
    for b, e, x, y in sorted(spans):
        if out and b <= out[-1][1]:
            last = out[-1]
            out[-1] = (last[0], max(last[1], e), last[2], max(last[3], y))
        else:
            out.append((b, e, x, y))
    return out


SPANS = pa.list_(pa.list_(pa.int64()))


def benchmark_blocks(benchmark: DataFrame, window: int, block_bytes: int) -> list[Windows]:
    """Windows of the whole benchmark, so many bytes of text at a time."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")
                            ).where(F.col("text").isNotNull())
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // block_bytes))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    found = (windows_of([(r[0], r[1]) for r in rows.where(part == i).orderBy("item_id").collect()], window)
             for i in range(parts))
    return [w for w in found if w is not None]


def overlaps(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
             keep_text: bool = False) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``items`` and ``spans`` (word begin, end, byte begin, end).

    Columns of these names are replaced. ``text`` goes unless ``keep_text``.
    """
    frame = docs = docs.drop("n_words", "n_hit", "items", "spans")
    columns = docs.columns
    passes: list[Windows | None] = [*benchmark_blocks(benchmark, window, block_bytes)] or [None]
    kept = [c for c in columns if keep_text or c != "text"]
    for number, known in enumerate(passes):
        shared = docs.sparkSession.sparkContext.broadcast(known and tuple(known))
        last = number == len(passes) - 1

        def scan(batches: Iterator[pa.RecordBatch], shared=shared, first=number == 0, last=last):
            known = shared.value and Windows(*shared.value)
            for batch, texts in blocks(batches):
                hits = (find_hits(texts, known) if known else
                        Hits(find_words(texts, WORDS_FOLDED).counts(), [[] for _ in texts.bounds[1:]],
                             np.empty((0, 2), np.int64)))
                items: list[list[str]] = [[] for _ in range(len(texts))]
                for d, w in hits.pairs.tolist():
                    items[d] += known.items[known.item_bounds[w]:known.item_bounds[w + 1]]
                spans = hits.spans
                if not first:
                    items = [a + b for a, b in zip(batch.column("items").to_pylist(), items, strict=True)]
                    spans = [merged([*map(tuple, a), *b])
                             for a, b in zip(batch.column("spans").to_pylist(), spans, strict=True)]
                names = kept if last else columns
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in names), pa.array(hits.n_words, pa.int64()),
                     pa.array([sum(s[1] - s[0] for s in x) for x in spans], pa.int64()),
                     pa.array([sorted(set(x), key=lambda i: (i is None, i or "")) for x in items], pa.list_(pa.string())),
                     pa.array([[list(s) for s in x] for x in spans], SPANS)],
                    [*names, "n_words", "n_hit", "items", "spans"])

        out = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if not last or f.name in kept]
        frame = frame.mapInArrow(scan, ", ".join(
            [*out, "n_words bigint", "n_hit bigint", "items array<string>", "spans array<array<bigint>>"]))
    return frame


def items_digest(items) -> F.Column:
    return F.sha2(F.concat_ws(",", F.array_sort(items)), 256)


def remove_overlaps(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with every span cut out of its text; the columns stay as they are."""
    # The other columns travel as one, so that their names don't matter.
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    carried = docs.select(F.struct(F.lit(0).alias("_"), *rest).alias("rest"), "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches):
            column = batch.column("text").to_pylist()
            for i, spans in enumerate(batch.column("spans").to_pylist()):
                if spans:
                    raw, at, parts = texts.bytes_of(i), 0, []
                    for _, _, begin, end in spans:
                        parts.append(raw[at:begin])
                        at = end
                    column[i] = b"".join([*parts, raw[at:]]).decode()
            yield pa.RecordBatch.from_arrays([batch.column("rest"), pa.array(column, pa.string())], ["rest", "text"])

    found = overlaps(carried, benchmark, window, keep_text=True).mapInArrow(cut, carried.schema)
    return found.select(*(F.col("text") if c == "text" else F.col(f"rest.`{c}`").alias(c) for c in docs.columns))
