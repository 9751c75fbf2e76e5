"""Suffix-array and substring deduplication against plain versions."""

from __future__ import annotations

import random
from collections import Counter

import brute
import numpy as np
import pytest
import samples
from pyspark.sql import functions as F

from vitrine.llm import substrings, suffixdedup
from vitrine.llm.suffixes import common_prefixes, suffix_array


def random_rows(seed):
    rng = random.Random(seed)
    return [(rng.choice([None, *range(12)]), "".join(rng.choice("ab é") for _ in range(rng.randint(0, 60)))) for _ in range(40)]


def test_suffix_arrays():
    rng = random.Random(1)
    for _ in range(200):
        data = np.array([rng.randrange(rng.choice([1, 2, 40])) for _ in range(rng.randint(1, 80))], np.uint8)
        order, rank = suffix_array(data)
        assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:].tolist())
        found = common_prefixes(data, order, rank, 9)
        for i, r in enumerate(rank.tolist()):
            n = 0
            if r:
                j = int(order[r - 1])
                while n < 9 and max(i, j) + n < len(data) and data[i + n] == data[j + n]:
                    n += 1
            assert found[i] == n


@pytest.mark.parametrize("crowd", [10_000, 1])
@pytest.mark.parametrize(("rows", "length", "seed"), [(None, 50, 20), (random_rows(3), 7, 3)])
def test_bytes(spark, rows, length, seed, crowd):
    rows = samples.documents() if rows is None else rows
    found = suffixdedup.kept_bytes(samples.frame(spark, rows), length, seed, crowd).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    assert Counter(map(tuple, found)) == Counter(brute.repeats(rows, length, lambda t: list(t.encode()), bytes))


def test_blocks_of_a_shard_are_merged(spark, monkeypatch):
    monkeypatch.setattr(suffixdedup, "BLOCK_BYTES", 200)
    rows = random_rows(4) + samples.documents()[:20]
    found = suffixdedup.kept_bytes(samples.frame(spark, rows), 9, 4).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    assert Counter(map(tuple, found)) == Counter(brute.repeats(rows, 9, lambda t: list(t.encode()), bytes))


@pytest.mark.parametrize(("rows", "length", "seed"), [(None, 50, 10), (random_rows(6), 3, 2)])
def test_words(spark, rows, length, seed):
    rows = samples.documents() if rows is None else rows
    docs = samples.frame(spark, rows)
    found = substrings.kept_words(docs, length, seed).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()
    expected = brute.repeats(rows, length, brute.SPACED.findall, lambda w: " ".join(w).encode())
    assert Counter(map(tuple, found)) == Counter((i, n, r, s) for i, n, r, _, s in expected)
    cut = substrings.remove_repeats(docs, length, seed)
    assert cut.columns == docs.columns
    words = Counter((r["doc_id"], tuple(brute.SPACED.findall(r["text"] or ""))) for r in cut.collect())
    kept = Counter((r["doc_id"], tuple(r["kept"].split(" ")) if r["kept"] else ())
                   for r in substrings.kept_words(docs, length, seed).collect())
    assert words == kept


def test_empty_tables(spark):
    docs = samples.frame(spark, [])
    assert suffixdedup.kept_bytes(docs).collect() == []
    assert substrings.kept_words(docs).collect() == []
    assert substrings.remove_repeats(docs).collect() == []
