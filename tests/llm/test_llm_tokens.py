"""Token counts and packing against the library."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import samples
from tokenizers import Tokenizer

from vitrine.llm import packing, tokens

BYTE, WORD = (public_tokenizers.path(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k"))
ODD = [*"aAbzZ09 \t\n'sStT.,-!éÉßÿÑ÷×µªº²½İıſΣσςæŒœ́​  \x1c\x1f\x85中文ক🙂\0", "'ll", "'S", "'re", "  ", " . "]


def odd_texts(n):
    rng = random.Random(2)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 14))) for _ in range(n)]
    return [t if i % 40 else f"{t}<|endoftext|>{t}<|startoftext|>" for i, t in enumerate(texts)]


def all_rows():
    return samples.documents() + [(1000 + i, t) for i, t in enumerate(odd_texts(600))]


def test_counts(spark):
    library, rows = Tokenizer.from_file(BYTE), all_rows()
    expected = Counter((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    for head in (0, 50, tokens.HEAD):
        found = tokens.count_tokens(samples.frame(spark, rows), BYTE, head).collect()
        assert Counter(map(tuple, found)) == expected


def test_packing(spark):
    library, rows = Tokenizer.from_file(WORD), all_rows()
    expected = Counter()
    for i, t in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for piece, at in enumerate(range(0, len(ids), 512)):
            part = ids[at:at + 512]
            expected[i, piece, at, len(part), zlib.crc32(part.tobytes())] += 1
    found = packing.pack(samples.frame(spark, rows), WORD, capacity=512, group_rows=200).collect()
    assert Counter(tuple(r)[:5] for r in found) == expected
    bins = defaultdict(list)
    for r in found:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 512
    assert len(bins) <= sum(r["length"] for r in found) / 512 * 1.05 + 5


def test_two_smaller_pieces_replace_the_smallest():
    # 6 + 3 leaves 1; 2 + 2 in place of 3 leaves none.
    assert sorted(map(sorted, packing.best_two_fit([6, 3, 2, 2], 10))) == [[0, 2, 3], [1]]
    assert packing.best_two_fit([], 10) == []


def test_packing_is_near_the_bound():
    rng = random.Random(1)
    lengths = [min(4096, int(rng.lognormvariate(6.5, 1)) + 1) for _ in range(20_000)]
    bins = packing.best_two_fit(lengths, 4096)
    assert sorted(i for b in bins for i in b) == list(range(20_000))
    assert max(sum(lengths[i] for i in b) for b in bins) <= 4096
    assert len(bins) <= -(-sum(lengths) // 4096) * 1.01 + 1


def test_empty_tables(spark):
    docs = samples.frame(spark, [])
    assert tokens.count_tokens(docs, BYTE).collect() == []
    assert packing.pack(docs, WORD).collect() == []
