"""Token ids of two tokenizers aligned by the bytes they cover.

A is a byte-level BPE (``tokenizers`` file), B a BPE with byte fallback (``sentencepiece`` model) that puts a space
before its text; A is given that space too, so both cover the same bytes.

1. Texts are tokenised whole by both. A text is put together from its pre-tokens, which begin at a space behind a
   visible character: no piece of either vocabulary crosses such a place (checked when the task starts), so a task
   encodes each pre-token it meets once. Texts of which either gives other bytes than ``" " + text`` have no tokens.
2. Anchors are byte offsets where a token of both ends and where the next token of both begins with a space. They cut a
   text into windows. Equal windows of a block are found by hashes of their ids and compared id by id; each
   is aligned once and remembered under its ids.
3. In a window, offsets where both end cut groups, and tokens that share bytes are linked. Counts of id pairs are summed
   over the corpus, tasks adding up what they see. The most frequent pairs, ``head`` at most, are then looked up while
   the documents' links are read again; the rest join on the pair, and being rare, none of them is a hot key.

A null or empty text has no tokens: zeros and no groups. Repeated rows have a result each, and each counts. Very long
texts are one block: memory follows the longest text, as the ids of a text are needed together. Other columns are
ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.arrays import Slices, blocks, list_column, mix
from vitrine.llm.substrings import stored
from vitrine.llm.tokens import pre_tokens

#: Pairs looked up without a join.
HEAD = 1 << 18
#: Pre-tokens, windows and pairs a task remembers before it begins anew or hands them on.
KEPT = 300_000
BLOCK_BYTES = 1 << 19
_SPACE = "▁"
_BYTE = re.compile("<0x([0-9A-F]{2})>")
#: Pairs in a stored row.
ROW_PAIRS = 1024
_FIELDS = [("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
           ("n_links", pa.int64()), ("groups", pa.string())]
_SCHEMA = "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string"
_ALIGNED = f"{_SCHEMA}, pairs array<bigint>, uses array<int>"
_LOOKED = f"{_SCHEMA}, pair bigint, uses bigint, known_best bigint, known_sum bigint"


class Ragged(NamedTuple):
    """Sequences of numbers, one behind the other."""

    flat: np.ndarray
    bounds: np.ndarray

    @classmethod
    def of(cls, items: list) -> Ragged:
        sizes = np.fromiter(map(len, items), np.int64, len(items))
        return cls(np.concatenate(items) if items else np.empty(0, np.int32), np.concatenate([[0], np.cumsum(sizes)]))

    def followed_by(self, other: Ragged) -> Ragged:
        return Ragged(np.concatenate([self.flat, other.flat]), np.concatenate([self.bounds, self.bounds[-1] + other.bounds[1:]]))

    def sizes(self) -> np.ndarray:
        return np.diff(self.bounds)

    def pieces(self) -> Iterator[bytes]:
        raw, cuts = self.flat.tobytes(), (self.bounds * self.flat.itemsize).tolist()
        return (raw[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True))

    def take(self, index: np.ndarray) -> Ragged:
        """The sequences at ``index`` in that order."""
        sizes = self.sizes()[index]
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        return Ragged(self.flat[np.arange(bounds[-1]) + np.repeat(self.bounds[index] - bounds[:-1], sizes)], bounds)


class Tokenizers:
    """Both tokenizers and what is known of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(path_a)
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        self.bytes_a = [bytes(letters.get(c, 0) for c in self._a.id_to_token(i) or "")
                        for i in range(self._a.get_vocab_size())]
        self.bytes_b = [self._bytes_of(self._b.id_to_piece(i)) for i in range(self._b.get_piece_size())]
        if any(_SPACE in self._b.id_to_piece(i).lstrip(_SPACE) for i in range(len(self.bytes_b))):
            raise ValueError("a piece holds a space behind other characters")
        self.sizes = [np.array([len(x) for x in xs]) for xs in (self.bytes_a, self.bytes_b)]
        self.spaced = [np.array([x[:1] == b" " for x in xs]) for xs in (self.bytes_a, self.bytes_b)]

    @staticmethod
    def _bytes_of(piece: str) -> bytes:
        one = _BYTE.fullmatch(piece)
        return bytes([int(one[1], 16)]) if one else piece.replace(_SPACE, " ").encode()

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self._a.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_b(self, texts: list[str]) -> list[list[int]]:
        """``texts`` begin with the space that the tokenizer adds; of a space alone it would make nothing."""
        found = self._b.encode([x[1:] for x in texts], num_threads=1)
        return [ids or [self._b.piece_to_id(_SPACE)] for ids in found]


def byte_letters() -> dict[str, int]:
    """Byte-level alphabet: printable Latin-1 stands for itself, other bytes for the code points from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class KnownTexts:
    """Ids of pre-tokens, each encoded once in a task."""

    def __init__(self, tokenizers: Tokenizers):
        self._t = tokenizers
        self._forget()

    def _forget(self) -> None:
        self._place: dict[str, int] = {}
        self.sides = [Ragged.of([]), Ragged.of([])]
        #: Which pre-tokens a tokenizer gives back as other bytes.
        self.broken = np.empty(0, bool)

    def learn(self, chunks: set[str]) -> None:
        if len(self._place) > KEPT:
            self._forget()
        # Encoded together they cost less. A chunk that ends in white space stands alone: it could join the next one.
        together, alone = [], []
        for chunk in chunks.difference(self._place):
            (alone if chunk[-1:].isspace() or _SPACE in chunk else together).append(chunk)
        groups = [together[i:i + 256] for i in range(0, len(together), 256)] + [[x] for x in alone]
        new = [x for g in groups for x in g]
        if not new:
            return
        joined = ["".join(g) for g in groups]
        stops = np.cumsum([len(x.encode()) for x in new])
        broken = np.zeros(len(new), bool)
        found = [Ragged.of([np.array(x, np.int32) for x in ids]) for ids in (self._t.encode_a(joined), self._t.encode_b(joined))]
        raw = "".join(joined).encode()
        if any(b"".join(map(table.__getitem__, x.flat.tolist())) != raw
               for table, x in zip((self._t.bytes_a, self._t.bytes_b), found, strict=True)):
            found, broken = self._one_by_one(new)
            sides = found
        else:
            sides = [Ragged(x.flat, np.concatenate([[0], np.searchsorted(np.cumsum(sizes[x.flat]), stops) + 1]))
                     for sizes, x in zip(self._t.sizes, found, strict=True)]
        self._place.update(zip(new, range(len(self.broken), len(self.broken) + len(new)), strict=True))
        self.broken = np.concatenate([self.broken, broken])
        self.sides = [old.followed_by(x) for old, x in zip(self.sides, sides, strict=True)]

    def _one_by_one(self, chunks: list[str]) -> tuple[list[Ragged], np.ndarray]:
        """As the joined bytes differ: which of the chunks does it come from? These have no ids."""
        found = [self._t.encode_a(chunks), self._t.encode_b(chunks)]
        broken = [any(b"".join(map(table.__getitem__, ids)) != chunk.encode()
                      for table, ids in ((self._t.bytes_a, a), (self._t.bytes_b, b)))
                  for chunk, a, b in zip(chunks, *found, strict=True)]
        return [Ragged.of([np.array([] if bad else ids, np.int32) for ids, bad in zip(side, broken, strict=True)])
                for side in found], np.array(broken)

    def ids(self, texts: list[list[str]]) -> tuple[Ragged, Ragged]:
        """Ids of texts by their chunks, none for texts of which a tokenizer gives other bytes."""
        places = np.array(list(map(self._place.__getitem__, chain.from_iterable(texts))), np.int64)
        owner = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)))
        bad = np.zeros(len(texts), bool)
        bad[owner[self.broken[places]]] = True
        places, owner = places[~bad[owner]], owner[~bad[owner]]
        first = np.searchsorted(owner, np.arange(len(texts) + 1))
        taken = [side.take(places) for side in self.sides]
        return tuple(Ragged(x.flat, x.bounds[first]) for x in taken)


def split_text(text: str) -> list[str]:
    """Pre-tokens of ``" " + text``; spaces at the end stay with what is before them."""
    chunks = [x for x in pre_tokens(" " + text) if x]
    if len(chunks) > 1 and not chunks[-1].strip(" "):
        last = chunks.pop()
        chunks[-1] += last
    return chunks


class Aligner:
    """Alignments of windows, remembered by their ids: the text of the groups, their number, and the linked pairs."""

    def __init__(self, tokenizers: Tokenizers):
        self._t = tokenizers
        self._forget()

    def _forget(self) -> None:
        self._place: dict[tuple[bytes, bytes], int] = {}
        self.names: list[str] = []
        self.groups = np.empty(0, np.int64)
        self.pairs = Ragged.of([])

    def align(self, a: Ragged, b: Ragged) -> np.ndarray:
        """Places of the windows' alignments; window i has the ids ``a`` i and ``b`` i. Unknown ones are aligned together."""
        if len(self.names) > KEPT:
            self._forget()
        keys = list(zip(a.pieces(), b.pieces(), strict=True))
        new = np.array([i for i, key in enumerate(keys) if key not in self._place], np.int64)
        names, groups, pairs = self._links(a.take(new), b.take(new))
        self._place.update(zip(map(keys.__getitem__, new.tolist()), range(len(self.names), len(self.names) + len(new)), strict=True))
        self.names += names
        self.groups, self.pairs = np.concatenate([self.groups, groups]), self.pairs.followed_by(pairs)
        return np.fromiter(map(self._place.__getitem__, keys), np.int64, len(keys))

    def _links(self, a: Ragged, b: Ragged) -> tuple[list[str], np.ndarray, Ragged]:
        """Tokens that share bytes, and the groups between common ends."""
        stop_a, stop_b = np.cumsum(self._t.sizes[0][a.flat]), np.cumsum(self._t.sizes[1][b.flat])
        # Tokens of B that overlap one of A: from the first that ends behind its begin to the first that reaches its end.
        first = np.searchsorted(stop_b, stop_a - self._t.sizes[0][a.flat], "right")
        many = np.searchsorted(stop_b, stop_a) + 1 - first
        bounds = np.concatenate([[0], np.cumsum(many)])
        other = np.arange(bounds[-1]) + np.repeat(first - bounds[:-1], many)
        pairs = np.repeat(a.flat, many).astype(np.int64) * len(self._t.bytes_b) + b.flat[other]
        _, at_a, at_b = np.intersect1d(stop_a, stop_b, assume_unique=True, return_indices=True)
        cut_a, cut_b = [0, *(at_a + 1).tolist()], [0, *(at_b + 1).tolist()]
        ids_a, ids_b = list(map(str, a.flat.tolist())), list(map(str, b.flat.tolist()))
        names = [f"{','.join(ids_a[i:j])}|{','.join(ids_b[k:m])}" for i, j, k, m in
                 zip(cut_a[:-1], cut_a[1:], cut_b[:-1], cut_b[1:], strict=True)]
        # A window's ends are common ends, so its groups and links lie side by side.
        groups = np.searchsorted(cut_a, a.bounds)
        whole = [";".join(names[i:j]) for i, j in zip(groups[:-1].tolist(), groups[1:].tolist(), strict=True)]
        return whole, np.diff(groups), Ragged(pairs, bounds[a.bounds])


def find_windows(a: Ragged, b: Ragged, tokenizers: Tokenizers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cuts of the windows of a block as places among the ids of A and of B, and the first window of every text.

    ``a`` and ``b`` hold the ids of the texts; both sides of a text cover the same bytes.
    """
    ends = [np.cumsum(sizes[x.flat]) for sizes, x in zip(tokenizers.sizes, (a, b), strict=True)]
    common, at_a, at_b = np.intersect1d(*ends, assume_unique=True, return_indices=True)
    at_a, at_b = at_a + 1, at_b + 1

    def marked(ids: Ragged, spaced: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Does the token at a place begin with a space, or another text?"""
        begins = np.concatenate([spaced[ids.flat], [True]])
        begins[ids.bounds] = True
        return begins[at]

    anchors = marked(a, tokenizers.spaced[0], at_a) & marked(b, tokenizers.spaced[1], at_b)
    cut_a, cut_b = np.concatenate([[0], at_a[anchors]]), np.concatenate([[0], at_b[anchors]])
    return cut_a, cut_b, np.searchsorted(cut_a, a.bounds)


def distinct_windows(a: Ragged, b: Ragged, cut_a: np.ndarray, cut_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of the first of equal windows, number of each window among them), equality being checked id by id."""
    hashed = [Slices(mix(ids.flat.astype(np.uint64))).hashes(cut[:-1], cut[1:]) for ids, cut in ((a, cut_a), (b, cut_b))]
    _, first, number = np.unique(mix(hashed[0]) + hashed[1], return_index=True, return_inverse=True)
    for ids, cut in ((a, cut_a), (b, cut_b)):
        mine = Ragged(ids.flat, cut)
        theirs = mine.take(first[number])
        if not (np.array_equal(theirs.bounds, cut) and np.array_equal(theirs.flat, ids.flat)):
            return np.arange(len(cut) - 1), np.arange(len(cut) - 1)  # two windows share a hash
    return first, number


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers and the sums of what stands with them."""
    values, number = np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True)
    sums = np.zeros(len(values), np.int64)
    np.add.at(sums, number, np.concatenate([n for _, n in parts]))
    return values, sums


def align_block(texts: list[str], known: KnownTexts, aligner: Aligner, tokenizers: Tokenizers,
                digest: bool) -> tuple[dict[str, list], Ragged, np.ndarray]:
    """Fields of the texts of a block, their distinct pairs in order, and how often each text links them."""
    chunks = [split_text(x) if x else [] for x in texts]
    known.learn(set().union(*chunks))
    a, b = known.ids(chunks)
    cut_a, cut_b, begin = find_windows(a, b, tokenizers)
    first, kind = distinct_windows(a, b, cut_a, cut_b)
    at = aligner.align(Ragged(a.flat, cut_a).take(first), Ragged(b.flat, cut_b).take(first))

    names = [aligner.names[i] for i in at.tolist()]
    groups = []
    for i, j in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
        whole = ";".join(map(names.__getitem__, kind[i:j].tolist()))
        groups.append(hashlib.sha256(whole.encode()).hexdigest() if digest and whole else whole)

    # What a text links: its distinct windows with their uses, then the pairs of these.
    text = np.repeat(np.arange(len(texts)), np.diff(begin))
    n_groups = np.bincount(text, aligner.groups[at].astype(np.float64)[kind], len(texts))
    both, uses = np.unique(text * max(1, len(at)) + kind, return_counts=True)
    text, kind = np.divmod(both, max(1, len(at)))
    links = aligner.pairs.take(at)
    pairs, place = np.unique(links.flat, return_inverse=True)
    used = Ragged(place, links.bounds).take(kind)
    both, uses = merged([(np.repeat(text, used.sizes()) * max(1, len(pairs)) + used.flat, np.repeat(uses, used.sizes()))])
    text, place = np.divmod(both, max(1, len(pairs)))
    n_links = np.bincount(text, uses, len(texts))
    fields = {"n_a": a.sizes(), "n_b": b.sizes(), "n_groups": n_groups.astype(np.int64),
              "n_links": n_links.astype(np.int64), "groups": groups}
    return fields, Ragged(pairs[place], np.searchsorted(text, np.arange(len(texts) + 1))), uses


def align_documents(docs: DataFrame, path_a: str, path_b: str, digest: bool = False) -> DataFrame:
    """Groups of every document of ``docs`` (row, doc_id, text) and the id pairs it links.

    The pairs of a document come in rows of ``ROW_PAIRS``, the first with the other fields. Rows without ``row`` hold
    the sums of a task. A pair is one number: A id times B's vocabulary size plus B id. ``digest`` puts the SHA-256
    of the groups in place of their text, which is several times as long as the document.
    """
    def sums(pairs: np.ndarray, uses: np.ndarray) -> pa.RecordBatch:
        bounds = np.append(np.arange(0, len(pairs), ROW_PAIRS), len(pairs))
        empty = {k: pa.nulls(len(bounds) - 1, t) for k, t in _FIELDS}
        return _batch(empty, pairs, uses, bounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = Tokenizers(path_a, path_b)
        known, aligner = KnownTexts(tokenizers), Aligner(tokenizers)
        held = (np.empty(0, np.int64), np.empty(0, np.int64))
        for batch, _ in blocks(batches, most=BLOCK_BYTES):
            texts = [x or "" for x in batch.column("text").to_pylist()]
            fields, pairs, uses = align_block(texts, known, aligner, tokenizers, digest)
            held = merged([held, (pairs.flat, uses)])
            # Cuts between documents, and within those of very many pairs.
            cuts = [np.arange(i, max(j, i + 1), ROW_PAIRS) for i, j in zip(pairs.bounds[:-1], pairs.bounds[1:], strict=True)]
            row = np.repeat(np.arange(len(texts)), [len(c) for c in cuts])
            later = np.concatenate([np.arange(len(c)) > 0 for c in cuts])
            columns = {"row": batch.column("row").take(pa.array(row)),
                       **{k: pa.array(pa.array(v).take(pa.array(row)).to_pylist(), t, mask=later)
                          for (k, t), v in zip(_FIELDS[1:], [batch.column("doc_id").to_pylist(), *fields.values()], strict=True)}}
            yield _batch(columns, pairs.flat, uses, np.append(np.concatenate(cuts), len(pairs.flat)))
            if len(held[0]) > KEPT:
                yield sums(*held)
                held = (np.empty(0, np.int64), np.empty(0, np.int64))
        if len(held[0]):
            yield sums(*held)

    return docs.mapInArrow(run, _ALIGNED)


def _batch(columns: dict[str, pa.Array], pairs: np.ndarray, uses: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
    lists = [list_column(pairs, bounds, pa.int64()), list_column(uses.astype(np.int32), bounds, pa.int32())]
    return pa.RecordBatch.from_arrays([*columns.values(), *lists], [*columns, "pairs", "uses"])


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """``pair, n, best``: links that hold each pair linked, and whether no pair with the same B id has more."""
    sums = aligned.where(F.col("row").isNull()).select(F.explode(F.arrays_zip("pairs", "uses")).alias("x"))
    counted = stored(sums.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.uses").alias("n")), "pairs")
    id_b = F.pmod("pair", F.lit(size_b))
    # One row for every piece of B's vocabulary at most.
    highest = counted.groupBy(id_b.alias("id_b")).agg(F.max("n").alias("highest"))
    return (counted.withColumn("id_b", id_b).join(F.broadcast(highest), "id_b")
            .select("pair", "n", (F.col("n") == F.col("highest")).alias("best")))


def frequent(pairs: DataFrame, head: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pair, count and best of the most used classes of pairs, ``head`` rows at most, sorted by pair."""
    level = F.floor(8 * F.log2("n")).cast("int")
    taken, lowest = 0, None
    for at, n in sorted((tuple(r) for r in pairs.groupBy(level).count().collect()), reverse=True):
        taken += n
        if taken > head:
            break
        lowest = at
    if lowest is None:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    top = pairs.where(level >= lowest).toArrow()
    order = np.argsort(top["pair"].to_numpy())
    return tuple(top[name].to_numpy()[order] for name in ("pair", "n", "best"))


def align(docs: DataFrame, path_a: str, path_b: str, digest: bool = False, head: int = HEAD) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum`` for every row of ``docs`` (doc_id, text)."""
    plain = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
    # The texts are tokenised once; all that follows reads what is stored.
    aligned = stored(align_documents(plain, path_a, path_b, digest), "aligned")
    pairs = stored(pair_counts(aligned, len(Tokenizers(path_a, path_b).bytes_b)), "pair-counts")
    known = docs.sparkSession.sparkContext.broadcast(frequent(pairs, head))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, counts, is_best = known.value
        for batch in batches:
            lists = batch.column("pairs")
            owner = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            mine, uses = lists.flatten().to_numpy(), batch.column("uses").flatten().to_numpy().astype(np.int64)
            at = np.minimum(np.searchsorted(top, mine), max(0, len(top) - 1))
            hit = top[at] == mine if len(top) else np.zeros(len(mine), bool)
            total, best = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(total, owner[hit], uses[hit] * counts[at[hit]])
            np.add.at(best, owner[hit], uses[hit] * is_best[at[hit]])
            rest, n = ~hit, int((~hit).sum())
            row = batch.column("row").to_numpy()
            columns = [pa.array(np.concatenate([row, row[owner[rest]]])),
                       *(pa.concat_arrays([batch.column(k), pa.nulls(n, t)]) for k, t in _FIELDS[1:]),
                       # A row of known sums has a key of its own, so that such rows don't meet in one task.
                       pa.array(np.concatenate([-1 - row, mine[rest]])),
                       pa.concat_arrays([pa.nulls(len(row), pa.int64()), pa.array(uses[rest])]),
                       pa.concat_arrays([pa.array(best), pa.nulls(n, pa.int64())]),
                       pa.concat_arrays([pa.array(total), pa.nulls(n, pa.int64())])]
            yield pa.RecordBatch.from_arrays(columns, [k for k, _ in _FIELDS] + ["pair", "uses", "known_best", "known_sum"])

    looked = aligned.where(F.col("row").isNotNull()).mapInArrow(look_up, _LOOKED)
    joined = looked.join(pairs, "pair", "left")
    best = F.coalesce("known_best", F.when(F.col("best"), F.col("uses")).otherwise(0))
    total = F.coalesce("known_sum", F.col("uses") * F.col("n"))
    return (joined.groupBy("row").agg(*(F.max(k).alias(k) for k, _ in _FIELDS[1:]),
                                      F.sum(best).alias("n_best"), F.sum(total).alias("count_sum")).drop("row"))
