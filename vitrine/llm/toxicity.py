"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Learning takes at most ``examples`` labelled rows, chosen by a hash of the id.
Terms are all words and their beginnings of ``PREFIXES`` bytes, so that inflected
and joined forms meet. A term weighs (1 + log tf) * idf, with document frequencies
counted over all documents, times the root of 1 + chi-squared of its presence and
the label among the examples, so that telling terms count more and none is left out.

Only terms of examples can add to a product, so those of the examples are kept.
An example's length is over its whole vector. The length of the text that is
judged divides all its cosines alike: it changes neither their order nor the
weighted vote, and is left out.

The inverted index has two kinds of terms. Postings of rare ones are always read;
they give each example the exact part of its product that rare terms make. Terms in
more than ``COMMON`` of the examples, the ``DENSE`` most frequent ones at most, are
a dense matrix of single precision, which is multiplied with ``BLOCK`` texts and more
at once. A worker makes the matrix and the lists once and keeps them for its next tasks.
Examples that fall short of the k-th best sum by more than rounding can explain are
skipped, the others' common terms are read again and their cosines are exact. The k
nearest vote with their cosine as weight; votes become probabilities by isotonic
regression over the examples, each judged by the others.

Null or empty text, or no term of an example: the smoothed share of toxic ones
among the examples without a term of chi-squared over ``CHI_SQUARED``. Equal
cosines: the earlier example. No usable labels: score 0. Several labels of
one id: the largest counts; several texts: the lowest. Repeated documents are each
scored. A text longer than a block of ``arrays.blocks`` is a block of its own and
counted whole. An empty table gives no rows; columns named as the results are replaced.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.arrays import (
    WORDS_FOLDED,
    Slices,
    Texts,
    blocks,
    byte_values,
    find_words,
    give_back,
    mix,
)
from vitrine.session import fresh_dir

EXAMPLES, NEIGHBOURS, BLOCK = 16_000, 15, 384
PREFIXES = (4, 5, 6, 7, 8)
#: A term goes with the label beyond chance; only texts without a term of an example are judged by it.
CHI_SQUARED = 26.0
#: Terms in more than this part of the examples are common, as many at most. A column takes 4 bytes by example.
COMMON, DENSE = 1 / 16, 2048
#: Equal cosines: examples are in order of so many parts by a hash of the id, then of their heaviest term.
PARTS = 4
#: Integers of the uses from which lengths are made: the narrowest that hold all uses of an example's hash part.
KINDS = (np.uint8, np.uint16, np.uint32)
#: Terms of examples that a task puts into one part of the index at most.
PART_TERMS = 1 << 21
#: Examples of which the search takes the best one first.
GROUP = 16
#: Texts whose result a task remembers, as copies come often.
REMEMBERED = 4096
#: Blocks of ``arrays.blocks`` that wait at most until ``BLOCK`` texts are together.
HELD = 8
#: Sums of ``DENSE`` products in single precision, none negative, are off by less for vectors of length 1.
_SLACK = 2e-4


class Index(NamedTuple):
    """Postings by rare term and, for common terms, by example; uses instead of weights, which follow from them.

    An example's weight of a term is (1 + log uses) * factor / norm.
    """

    bounds: np.ndarray  # of the postings, by term; a common term has none
    example: np.ndarray  # by posting, as the one below
    uses: np.ndarray
    common: np.ndarray  # by term: its number among the common ones, or -1
    row_bounds: np.ndarray  # of the common terms, by example
    row_common: np.ndarray  # their numbers, as the one below
    row_uses: np.ndarray
    factors: np.ndarray  # by term
    norms: np.ndarray  # by example


class Lists:
    """The runs of ``values`` between bounds; Arrow puts any of them together at once."""

    def __init__(self, bounds: np.ndarray, values: np.ndarray):
        self.bounds, self._kind = bounds, values.dtype
        self._bytes = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(bounds) - 1,
            [None, pa.py_buffer(bounds.astype(np.int64) * values.itemsize), pa.py_buffer(np.ascontiguousarray(values))])

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sizes of some runs, and their values, run after run."""
        sizes = self.bounds[numbers + 1] - self.bounds[numbers]
        n = int(sizes.sum())
        return sizes, np.frombuffer(self._bytes.take(pa.array(numbers)).buffers()[2], self._kind, n) if n else np.empty(0, self._kind)


def equal_lists(bounds: np.ndarray, example: np.ndarray, uses: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of every kind of postings, and by term its kind; equal are those with equal sums of hashes.

    Words and their beginnings often stand in the same examples, equally often.
    """
    sums = np.zeros(len(bounds), np.uint64)
    for at in range(0, len(example), PART_TERMS):
        some = slice(at, at + PART_TERMS)
        hashes = mix(example[some].astype(np.uint64) << np.uint64(32) | uses[some])
        first = int(np.searchsorted(bounds, at, "right")) - 1
        last = int(np.searchsorted(bounds, at + len(hashes), "left"))
        starts = np.maximum(bounds[first:last], at)
        filled = np.flatnonzero(np.minimum(bounds[first + 1:last + 1], at + len(hashes)) > starts)
        sums[first + filled] += np.add.reduceat(hashes, starts[filled] - at)
    return np.unique(sums[:-1], return_index=True, return_inverse=True)[1:]


class Search:
    """An index made ready: the common terms as a dense matrix, the others' postings by kinds of equal ones."""

    def __init__(self, index: Index):
        most = max((int(x.max()) for x in (index.uses, index.row_uses) if len(x)), default=1)
        self._logs = 1 + np.log(np.arange(most + 1).clip(1))
        self._examples = len(index.norms)
        self._scale = 1 / np.where(index.norms > 0, index.norms, 1)
        first, kinds = equal_lists(index.bounds, index.example, index.uses)
        sizes = index.bounds[first + 1] - index.bounds[first]
        order = np.argsort(-sizes, kind="stable")  # what is often read lies together
        first, sizes, rank = first[order], sizes[order], np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self._kinds = rank[kinds]
        at = spread(index.bounds[first], sizes)
        self._postings = Lists(np.append(0, np.cumsum(sizes)),
                               np.rec.fromarrays([index.example[at], index.uses[at]], names="example,uses"))
        del at
        self._rows = Lists(index.row_bounds, np.rec.fromarrays([index.row_common, index.row_uses], names="common,uses"))
        owner = np.repeat(np.arange(self._examples), np.diff(index.row_bounds))
        self._dense = np.zeros((self._examples, int((index.common >= 0).sum())), np.float32)  # without the term's factor
        self._dense[owner, index.row_common] = self._logs[index.row_uses] * self._scale[owner]
        self._common, self._factors = index.common, index.factors
        self._numbers, self._found = np.empty(0, np.intp), np.empty(0)
        self.skipped = 0  # examples whose common terms were not read

    def query_values(self, terms: np.ndarray, uses: np.ndarray) -> np.ndarray:
        """What a text's uses of terms weigh, its length aside."""
        return (1 + np.log(uses)) * self._factors[terms]

    def common_products(self, bounds: np.ndarray, terms: np.ndarray, values: np.ndarray) -> np.ndarray:
        """By text and example, what the common terms add to the product, less than ``_SLACK`` off."""
        owner, number = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)), self._common[terms]
        often = np.flatnonzero(number >= 0)
        query = np.zeros((len(bounds) - 1, self._dense.shape[1]), np.float32)
        query[owner[often], number[often]] = values[often] * self._factors[terms[often]]
        return query @ self._dense.T

    def nearest(self, terms: np.ndarray, values: np.ndarray, k: int, leave: int = -1,
                common: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The k examples with the largest product with ``values`` of ``terms``, and these; only positive ones, without ``leave``.

        ``common``: the row of ``common_products`` for the text.
        """
        if not len(terms) or not self._examples:
            return np.empty(0, np.int64), np.empty(0)
        if common is None:
            common = self.common_products(np.array([0, len(terms)]), terms, values)[0]
        number, factored = self._common[terms], values * self._factors[terms]
        rare = number < 0
        part = self._rare_products(terms[rare], factored[rare])
        query = np.zeros(self._dense.shape[1])
        query[number[~rare]] = factored[~rare]
        near = part + common
        if leave >= 0:
            near[leave] = 0
        # Both the k-th best and an example may be off by the slack.
        slack = 2 * _SLACK * np.linalg.norm(values)
        # The k-th best of the best of every group is no better than the k-th best of all.
        groups = near[:len(near) // GROUP * GROUP].reshape(GROUP, -1).max(0)
        best = np.flatnonzero(near > (max(np.partition(groups, -k)[-k] - slack, 0.0) if len(groups) >= k else 0.0))
        if len(best) >= k:
            best = best[near[best] > np.partition(near[best], -k)[-k] - slack]
        self.skipped += self._examples - len(best)
        scores = self._whole(best, part, query)
        top = np.lexsort((best, -np.round(scores, 12)))[:k]
        return best[top], scores[top]

    def _rare_products(self, terms: np.ndarray, factored: np.ndarray) -> np.ndarray:
        """By example, the exact part of the product that rare terms make."""
        kinds = self._kinds[terms]
        order = kinds.argsort()
        kinds = kinds[order]
        new = np.flatnonzero(np.append(True, kinds[1:] != kinds[:-1])[:len(kinds)])
        sizes, postings = self._postings.take(kinds[new])
        n = len(postings)
        if not n:
            return np.zeros(self._examples)
        if n > len(self._numbers):  # kept from text to text: new memory costs more than the sums
            self._numbers, self._found = np.empty(2 * n, np.intp), np.empty(2 * n)
        numbers, found = self._numbers[:n], self._found[:n]
        np.copyto(numbers, postings["uses"])
        self._logs.take(numbers, out=found, mode="clip")
        found *= np.repeat(np.add.reduceat(factored[order], new), sizes)
        np.copyto(numbers, postings["example"])
        return np.bincount(numbers, found, self._examples) * self._scale

    def _whole(self, some: np.ndarray, part: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Whole products of some examples."""
        sizes, rows = self._rows.take(some)
        products = query[rows["common"].astype(np.intp)] * self._logs[rows["uses"].astype(np.intp)]
        return part[some] + np.bincount(np.repeat(np.arange(len(some)), sizes), products, len(some)) * self._scale[some]


#: What a task returns for a part of the index.
PART = pa.schema([*((name, pa.list_(kind)) for name, kind in (
    ("ids", pa.int64()), ("marks", pa.int32()), ("places", pa.int32()), ("heaviest", pa.int32()), ("peaks", pa.int64()),
    ("norms8", pa.float64()), ("norms16", pa.float64()), ("norms32", pa.float64()))),
    ("plain", pa.int64()), ("plain_toxic", pa.int64()), ("size", pa.int64()), ("part", pa.binary())])


class Model(NamedTuple):
    """Broadcast: sorted term hashes; ``Weights``, packed; parts of the index, packed, with the examples' labels and ids in
    order. Calibration; share of texts without terms."""

    terms: Broadcast
    weights: Broadcast
    examples: Broadcast
    steps: np.ndarray
    shares: np.ndarray
    without: float


def pack(value: tuple) -> tuple[int, bytes]:
    """Compressed, as the driver and every executor keep a file of what is broadcast."""
    raw = pickle.dumps(value, protocol=5)
    return len(raw), pa.compress(raw, codec="zstd", asbytes=True)


def unpack(packed: tuple[int, bytes]) -> tuple:
    return pickle.loads(pa.decompress(packed[1], packed[0], codec="zstd"))


def narrow(values: np.ndarray, most: int) -> np.ndarray:
    """In the smallest unsigned integers that hold ``most``."""
    return values.astype(np.min_scalar_type(most))


def term_uses(texts: Texts, number: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, ...]:
    """Document, number and uses of the terms of a block, by document and number.

    ``number`` gives, of an array of hashes, the places of known ones and their
    numbers. Terms are made of distinct words, so a word's uses are counted first.
    """
    words = find_words(texts, WORDS_FOLDED)
    slices = Slices(byte_values(texts.data, fold=True))
    distinct, first, of = np.unique(slices.hashes(words.start, words.stop), return_index=True, return_inverse=True)
    n = max(len(texts), 1)
    word, document = np.divmod(np.sort(of * n + words.document()), n)
    new = np.flatnonzero(np.append(True, (word[1:] != word[:-1]) | (document[1:] != document[:-1]))[:len(word)])
    uses = np.diff(np.append(new, len(word)))
    word, document = word[new], document[new]
    start, length = words.start[first], (words.stop - words.start)[first]
    hashes, owners = [distinct], [np.arange(len(distinct))]
    for size in PREFIXES:
        long = np.flatnonzero(length > size)
        hashes.append(slices.hashes(start[long], start[long] + size))
        owners.append(long)
    known, numbers = number(np.concatenate(hashes))
    owner = np.concatenate(owners)[known]
    order = np.argsort(owner, kind="stable")
    numbers, bounds = numbers[order], np.searchsorted(owner[order], np.arange(len(distinct) + 1))
    sizes = np.diff(bounds)[word]
    term, document, uses = numbers[spread(bounds[word], sizes)], np.repeat(document, sizes), np.repeat(uses, sizes)
    span = int(numbers.max()) + 1 if len(numbers) else 1
    key = document * span + term
    order = np.argsort(key)
    key = key[order]
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
    return *np.divmod(key[new], span), np.add.reduceat(uses[order], new) if len(new) else uses


class Terms:
    """Looks up hashes among sorted ones; their high bits tell where to begin."""

    def __init__(self, terms: np.ndarray):
        bits = max(1, len(terms).bit_length())
        self._shift = np.uint64(64 - bits)
        self._first = np.searchsorted(terms, np.arange(1 << bits, dtype=np.uint64) << self._shift)
        self._terms = np.append(terms, np.uint64(0xFFFFFFFFFFFFFFFF))
        self._n = len(terms)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are known, and their numbers."""
        at = self._first[hashes >> self._shift]
        below = np.flatnonzero(self._terms[at] < hashes)
        while len(below):
            at[below] += 1
            below = below[self._terms[at[below]] < hashes[below]]
        known = np.flatnonzero((self._terms[at] == hashes) & (at < self._n))
        return known, at[known]

    def counts(self, texts: Texts) -> tuple[np.ndarray, ...]:
        """``term_uses`` of the known terms."""
        return term_uses(texts, self.find)


def spread(start: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size."""
    return np.repeat(start - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def examples_of(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """(doc_id, toxic, text) of at most ``most`` labelled documents, by a hash of the id; of several texts of one id the lowest."""
    marked = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    # Bounded by ``most`` ids.
    found = docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id")
    return (found.repartition(4 * docs.sparkSession.sparkContext.defaultParallelism, "doc_id", "toxic")
            .groupBy("doc_id", "toxic").agg(F.min("text").alias("text")))


def label_counts(examples: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted hashes of all terms, in how many examples each occurs, and in how many toxic ones."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches):
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(float)
            terms = np.empty(0, np.uint64)

            def number(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                nonlocal terms
                terms, of = np.unique(hashes, return_inverse=True)
                return np.arange(len(hashes)), of

            document, of, _ = term_uses(texts, number)
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms.view(np.int64)), pa.array(np.bincount(of, minlength=len(terms)), pa.int64()),
                 pa.array(np.bincount(of, toxic[document], len(terms)), pa.float64())], ["term", "n", "toxic"])

    counts = (examples.mapInArrow(count, "term bigint, n bigint, toxic double").groupBy("term")
              .agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")).toArrow())
    terms = counts["term"].to_numpy().view(np.uint64)
    order = np.argsort(terms)
    return terms[order], counts["n"].to_numpy()[order].astype(float), counts["toxic"].to_numpy()[order]


def indexed(examples: DataFrame, shared: Broadcast, weights: Broadcast) -> pa.Table:
    """A row for every part of the index, which a task has made and packed, with what orders and labels its examples.

    ``plain``, ``plain_toxic``: how many of them have no telling term, and of these are toxic.
    """
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weighed = Terms(shared.value), Weights(*unpack(weights.value))
        found: list[tuple[np.ndarray, ...]] = []

        def row() -> pa.RecordBatch:
            ids, marks, places, sizes, term, uses = (np.concatenate(x) for x in zip(*found, strict=True))
            found.clear()
            bounds, owner = np.append(0, np.cumsum(sizes)), np.repeat(np.arange(len(ids)), sizes)
            peaks = np.zeros(len(ids), np.int64)
            np.maximum.at(peaks, owner, uses)
            norms = [lengths(bounds, term, np.minimum(uses, np.iinfo(kind).max).astype(kind), weighed.factors) for kind in KINDS]
            plain = np.bincount(owner, weighed.telling[term], len(ids)) == 0
            values = [ids, marks, places, heaviest(bounds, term, (1 + np.log(uses)) * weighed.factors[term]), peaks, *norms]
            numbers = [int(plain.sum()), int(marks[plain].sum())]
            part = pack(tuple(part_of(bounds, term, uses, weighed)))
            return pa.RecordBatch.from_pylist(
                [dict(zip(PART.names, [*values, *numbers, *part], strict=True))], PART)

        for batch, texts in blocks(batches):
            document, term, uses = known.counts(texts)
            found.append((*(batch.column(c).to_numpy() for c in ("doc_id", "toxic", "place")),
                          np.bincount(document, minlength=len(texts)), term, uses))
            if sum(len(x[-1]) for x in found) >= PART_TERMS:
                yield row()
        if found:
            yield row()

    placed = examples.withColumn("place", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("int"))
    fields = ("ids array<bigint>, marks array<int>, places array<int>, heaviest array<int>, peaks array<bigint>, "
              "norms8 array<double>, norms16 array<double>, norms32 array<double>, plain bigint, plain_toxic bigint, size bigint, part binary")
    return placed.mapInArrow(build, fields).toArrow()


def document_frequencies(docs: DataFrame, shared: Broadcast, n_terms: int) -> tuple[int, np.ndarray]:
    """Number of documents, and in how many each of the ``shared`` terms occurs."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Terms(shared.value)
        total, found = 0, np.zeros(len(shared.value), np.int64)
        for _, texts in blocks(batches):
            total += len(texts)
            found += np.bincount(known.counts(texts)[1], minlength=len(found))
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(-1, some)), pa.array(np.append(total, found[some]))], ["term", "n"])

    sums = (docs.select("text").mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
            .toArrow())
    at, n = sums["term"].to_numpy(), sums["n"].to_numpy()
    found = np.zeros(n_terms + 1)  # the documents themselves come last
    found[at] = n
    return int(found[-1]), found[:-1]


def chi_squared(uses: np.ndarray, toxic_uses: np.ndarray, n: int, toxic: float) -> np.ndarray:
    """Of presence and label, corrected for continuity; 0 where nothing can be told."""
    below = uses * (n - uses) * toxic * (n - toxic)
    apart = np.maximum(np.abs(toxic_uses * n - uses * toxic) - n / 2, 0)
    return np.where(below > 0, n * apart * apart / np.where(below > 0, below, 1), 0)


def heaviest(bounds: np.ndarray, term: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Every example's heaviest term, the earlier of equal ones; -1 without terms."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((-weight, owner))
    found = np.full(len(bounds) - 1, -1)
    some = np.flatnonzero(np.diff(bounds))
    found[some] = term[order[bounds[some]]]
    return found


class Weights(NamedTuple):
    """By term: factor; number among the common ones, or -1; whether it tells a label beyond chance."""

    factors: np.ndarray
    common: np.ndarray
    telling: np.ndarray


class Part(NamedTuple):
    """Index of some examples, which are numbered from 0: rare terms and their postings; common terms by example."""

    terms: np.ndarray
    sizes: np.ndarray  # postings by rare term
    example: np.ndarray
    uses: np.ndarray
    row_sizes: np.ndarray
    row_common: np.ndarray
    row_uses: np.ndarray


def lengths(bounds: np.ndarray, term: np.ndarray, uses: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Of every example's vector. Logarithms have the precision that the integers of ``uses`` give them."""
    n = len(bounds) - 1
    owner = np.repeat(np.arange(n), np.diff(bounds))
    return np.sqrt(np.bincount(owner, np.square((1 + np.log(uses)) * factors[term]), n))


def common_numbers(n_uses: np.ndarray, examples: int) -> np.ndarray:
    """By term: its number among the common ones, or -1."""
    is_common = n_uses > max(COMMON * examples, 1)
    if is_common.sum() > DENSE:
        is_common[np.argsort(-n_uses, kind="stable")[DENSE:]] = False
    common = np.full(len(n_uses), -1, np.int32)
    common[is_common] = np.arange(int(is_common.sum()))
    return common


def part_of(bounds: np.ndarray, term: np.ndarray, uses: np.ndarray, weights: Weights) -> Part:
    """Part of the index, from bounds by example, terms (rising in each) and uses."""
    n, most = len(bounds) - 1, int(uses.max(initial=1))
    owner = np.repeat(np.arange(n), np.diff(bounds))
    often = weights.common[term] >= 0
    rare = np.flatnonzero(~often)
    rare = rare[np.argsort(term[rare], kind="stable")]
    terms, sizes = np.unique(term[rare], return_counts=True)
    return Part(terms.astype(np.int32), narrow(sizes, n), narrow(owner[rare], n), narrow(uses[rare], most),
                narrow(np.bincount(owner[often], minlength=n), DENSE), narrow(weights.common[term[often]], DENSE),
                narrow(uses[often], most))


def merged(parts: list[Part], order: np.ndarray, norms: np.ndarray, weights: Weights) -> Index:
    """Index of all parts; ``order``: the examples, numbered part after part, in their final order, in which ``norms`` are.

    A part's postings are put behind those of the parts before it, term by term.
    """
    number = np.empty(len(order), np.min_scalar_type(max(len(order), 1)))
    number[order] = np.arange(len(order))
    n_postings = np.zeros(len(weights.factors), np.int64)
    for part in parts:
        n_postings[part.terms] += part.sizes
    bounds = np.append(0, np.cumsum(n_postings))
    example = np.empty(bounds[-1], number.dtype)
    uses = np.empty(bounds[-1], np.result_type(np.uint8, *(x.uses for x in parts)))
    filled, before = bounds[:-1].copy(), 0
    for part in parts:
        sizes = part.sizes.astype(np.int64)
        at = spread(filled[part.terms], sizes)
        example[at], uses[at] = number[before:before + len(part.row_sizes)][part.example], part.uses
        filled[part.terms] += sizes
        before += len(part.row_sizes)
    rows, row_common, row_uses = (
        np.concatenate([np.empty(0, kind), *(getattr(x, name) for x in parts)]) for name, kind in
        (("row_sizes", np.int64), ("row_common", np.uint8), ("row_uses", np.uint8)))
    at = spread((np.cumsum(rows) - rows)[order], rows[order])
    return Index(bounds, example, uses, weights.common, np.append(0, np.cumsum(rows[order])), row_common[at], row_uses[at],
                 weights.factors, norms)


def index_of(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], factors: np.ndarray, n_uses: np.ndarray) -> Index:
    """Index of parts of the examples: bounds by example, terms (rising in each), uses; ``n_uses``: examples by term."""
    examples = sum(len(bounds) - 1 for bounds, _, _ in parts)
    weights = Weights(factors, common_numbers(n_uses, examples), np.zeros(len(factors), bool))
    norms = np.concatenate([np.empty(0), *(lengths(*x, factors) for x in parts)])
    return merged([part_of(*x, weights) for x in parts], np.arange(examples), norms, weights)


def even_runs(items: list, size: int) -> Iterator[list]:
    """Runs of like lengths, from ``size`` to less than twice that; fewer items are one."""
    n = max(len(items) // size, 1)
    yield from (x for x in (items[len(items) * i // n:len(items) * (i + 1) // n] for i in range(n)) if x)


def vote(labels: np.ndarray, scores: np.ndarray) -> float:
    return float(scores @ labels / scores.sum())


def isotonic(values: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising steps fitted to labels: values from which a step begins, and its share."""
    order = np.argsort(values, kind="stable")
    steps: list[list[float]] = []
    for v, y in zip(values[order].tolist(), labels[order].tolist(), strict=True):
        if steps and steps[-1][0] == v:
            steps[-1][1] += y
            steps[-1][2] += 1
        else:
            steps.append([v, y, 1])
    merged: list[list[float]] = []
    for step in steps:
        merged.append(step)
        while len(merged) > 1 and merged[-2][1] / merged[-2][2] >= merged[-1][1] / merged[-1][2]:
            last = merged.pop()
            merged[-1][1] += last[1]
            merged[-1][2] += last[2]
    return np.array([s[0] for s in merged]), np.array([s[1] / s[2] for s in merged])


#: The search that a worker has made last, by what it was made from.
_KEPT: dict[Broadcast, Search] = {}


def kept_search(examples: Broadcast, weights: Broadcast) -> Search:
    """The search over the ``examples`` of a model; a worker makes it once for all its tasks, and holds no second one."""
    if examples not in _KEPT:
        _KEPT.clear()
        parts, order, norms = examples.value[:3]
        _KEPT[examples] = Search(merged([Part(*unpack(x)) for x in parts], order, norms, Weights(*unpack(weights.value))))
        give_back()
    return _KEPT[examples]


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> Model:
    """A model from ``labels`` (doc_id, toxic), which hold only rows that may teach, and the texts of ``docs``."""
    spark = docs.sparkSession
    # Stored once: they are read again to be judged by each other.
    stored = fresh_dir(spark, "examples")
    examples_of(docs, labels, examples).write.parquet(stored)
    chosen = spark.read.parquet(stored)
    terms, uses, toxic_uses = label_counts(chosen)
    whole = chosen.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    chi = chi_squared(uses, toxic_uses, whole[0], float(whole[1]))
    # Bounded by the examples' texts, as what follows; one copy serves counting and judging.
    shared = spark.sparkContext.broadcast(terms)
    total, frequency = document_frequencies(docs, shared, len(terms))
    factors = (np.log((1 + total) / (1 + frequency)) + 1) * np.sqrt(1 + chi)
    weights = spark.sparkContext.broadcast(pack((factors, common_numbers(uses, whole[0]), chi > CHI_SQUARED)))
    del uses, toxic_uses, chi, frequency, factors
    # The driver passes packed parts on, but makes none: unpacked, the index is several times as large.
    made = indexed(chosen, shared, weights)
    ids, marks, places, heavy, peaks, *kinds = (pc.list_flatten(made[c]).to_numpy() for c in PART.names[:8])
    parts = list(zip(made["size"].to_pylist(), made["part"].to_pylist(), strict=True))
    plain, plain_toxic = (pc.sum(made[c]).as_py() or 0 for c in ("plain", "plain_toxic"))
    del made
    norms = np.empty(len(ids))
    for place in range(PARTS):
        mine = places == place
        norms[mine] = kinds[KINDS.index(np.min_scalar_type(int(peaks[mine].max(initial=1))))][mine]
    order = np.lexsort((ids, heavy, places))
    ids, marks, norms = ids[order], marks[order], norms[order]
    prior = float(marks.sum()) / max(len(marks), 1)
    without = (plain_toxic + prior) / (plain + 1)
    packed = spark.sparkContext.broadcast((parts, order, norms, marks.astype(float), ids))
    del parts
    give_back()
    model = Model(shared, weights, packed, np.zeros(1), np.full(1, prior), without)
    judged = judge(chosen.drop("toxic"), model, calibrated=False).select("doc_id", "score").where("score is not null").toArrow()
    raw = judged["score"].to_numpy()
    if len(raw):
        by_id = dict(zip(ids.tolist(), marks.tolist(), strict=True))
        steps, shares = isotonic(raw, np.array([by_id[i] for i in judged["doc_id"].to_pylist()], float))
        model = model._replace(steps=steps, shares=shares)
    return model


def judge(docs: DataFrame, model: Model, calibrated: bool = True) -> DataFrame:
    """``docs`` with ``score`` and ``evidence`` in place of ``text``.

    Not ``calibrated``: the plain vote of the others for documents that are
    examples themselves, null if there is none.
    """
    kept = [c for c in docs.columns if c != "text"]
    shared, weights, packed, steps, shares, without = model

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, search = Terms(shared.value), kept_search(packed, weights)
        labels, all_ids = packed.value[3:]
        place = {} if calibrated else {x: i for i, x in enumerate(all_ids.tolist())}
        seen: dict[tuple[bytes, int], tuple[np.ndarray, np.ndarray]] = {}
        new: dict[tuple[bytes, int], tuple[np.ndarray, np.ndarray]] = {}  # terms and values
        held: list[tuple[pa.RecordBatch, list[tuple[bytes, int]]]] = []

        def judged(batch: pa.RecordBatch, keys: list[tuple[bytes, int]]) -> pa.RecordBatch:
            scores, proof = [], []
            for key in keys:
                best, cosines = seen[key]
                share = vote(labels[best], cosines) if len(best) else None
                if calibrated:
                    step = len(best) and max(int(np.searchsorted(steps, share, "right")) - 1, 0)
                    share = float(shares[step]) if len(best) else without
                scores.append(share)
                proof.append(all_ids[best].tolist())
            return pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(scores, pa.float64()),
                 pa.array(proof, pa.list_(pa.int64()))], [*kept, "score", "evidence"])

        def answers() -> Iterator[pa.RecordBatch]:
            waiting = list(new.items())
            for some in even_runs(waiting, BLOCK):
                ends = np.append(0, np.cumsum([len(term) for _, (term, _) in some]))
                products = search.common_products(ends, *(np.concatenate(x) for x in zip(*(x for _, x in some), strict=True)))
                for (key, (term, values)), common in zip(some, products, strict=True):
                    seen[key] = search.nearest(term, values, NEIGHBOURS, key[1], common)
            yield from (judged(*x) for x in held)
            new.clear()
            held.clear()
            if len(seen) >= REMEMBERED:
                seen.clear()

        for batch, texts in blocks(batches):
            document, term, uses = known.counts(texts)
            values = search.query_values(term, uses)
            values /= np.sqrt(np.bincount(document, values * values, len(texts)))[document]
            bounds = np.searchsorted(document, np.arange(len(texts) + 1)).tolist()
            ids = [None] * len(texts) if calibrated else batch.column("doc_id").to_pylist()
            keys = [(hashlib.blake2b(texts.bytes_of(i), digest_size=16).digest(), place.get(ids[i], -1)) for i in range(len(texts))]
            for i, key in enumerate(keys):
                if key not in seen and key not in new:
                    new[key] = term[bounds[i]:bounds[i + 1]], values[bounds[i]:bounds[i + 1]]
            held.append((batch, keys))
            if len(new) >= BLOCK or len(held) >= HELD:
                yield from answers()
        yield from answers()

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in kept]
    return docs.mapInArrow(scan, ", ".join([*fields, "score double", "evidence array<bigint>"]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without text, with ``score`` and ``evidence``, the ids of the voting examples; these replace their names."""
    return judge(docs.drop("score", "evidence"), model)
