"""Decontamination, SimHash and fingerprints against plain versions."""

from __future__ import annotations

import hashlib
from collections import Counter

import brute
import numpy as np
import pytest
import samples

from vitrine.llm import decontaminate, simhash, sketches

ITEMS = [(1, "One two THREE four five six seven eight nine ten eleven"), (2, "one two three four five six seven eight nine ten"),
         (3, "short one"), (4, None), (5, ""), (6, "..."), (7, "short ONE"), (None, "Zuvor")]
TEXTS = [(1, "x One two three four five six seven eight, nine ten eleven y"), (2, "one two three"), (3, None),
         (4, "a short one here, short one"), (5, "ten eleven"), (6, "Short"), (6, "one"), (6, "one")]


@pytest.mark.parametrize("block_bytes", [1 << 20, 20])
def test_overlaps(spark, block_bytes):
    rows = TEXTS + samples.documents()
    items = [*ITEMS, (8, samples.documents()[4][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string").where("item_id is not null")
    found = decontaminate.overlaps(samples.frame(spark, rows), benchmark, block_bytes=block_bytes)
    ours = Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in found.collect())
    expected = brute.overlaps(rows, [x for x in items if x[0] is not None], 10)
    assert ours == Counter((i, n, h, tuple(f)) for i, n, h, f in expected)


def test_overlaps_are_cut(spark):
    docs = samples.frame(spark, TEXTS)
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    cut = decontaminate.remove_overlaps(docs, benchmark)
    assert cut.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in cut.collect()) == Counter(
        {(1, "x  y"): 1, (2, "one two three"): 1, (3, None): 1, (4, "a  here, "): 1, (5, "ten eleven"): 1, (6, "Short"): 1,
         (6, "one"): 2})


def test_no_benchmark_and_no_documents(spark):
    nothing = spark.createDataFrame([], "item_id long, text string")
    found = decontaminate.overlaps(samples.frame(spark, TEXTS), nothing).collect()
    assert {r["n_hit"] for r in found} == {0} and len(found) == len(TEXTS)
    assert decontaminate.overlaps(samples.frame(spark, []), nothing).collect() == []


@pytest.mark.parametrize("crowd", [64, 1])
def test_simhash(spark, sf_dir, crowd):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows += [(1000 + (i or 0), t) for i, t in samples.documents()]
    rows = list({i: (i, t) for i, t in rows}.values())
    roots = brute.components({i: brute.simhash(t) for i, t in rows})
    found = simhash.near_duplicates(samples.frame(spark, rows), crowd=crowd).collect()
    assert len(found) == len(rows)
    by_id = dict(rows)
    for r in found:
        assert r["bits"] % (1 << 64) == brute.simhash(by_id[r["doc_id"]])
        assert r["component_id"] == roots[r["doc_id"]]


def test_close_links_find_every_pair(spark):
    rng = np.random.default_rng(0)
    seeds = rng.integers(-(1 << 63), 1 << 63, 6)
    prints = {int(s) for s in seeds}
    for s in seeds:
        for _ in range(40):
            flips = rng.choice(64, rng.integers(1, 4), replace=False)
            prints.add(int((np.uint64(s.view(np.uint64)) ^ np.bitwise_or.reduce(np.uint64(1) << flips.astype(np.uint64))
                            ).view(np.int64)))
    nodes = spark.createDataFrame([(p,) for p in prints], "bits long")
    expected = brute.components({p: p % (1 << 64) for p in prints})
    for crowd in (2, 1000):
        found = dict(simhash.components(simhash.close_links(nodes, crowd=crowd)).collect())
        assert {p: found.get(p, p) for p in prints} == expected


def test_empty_simhash(spark):
    assert simhash.near_duplicates(samples.frame(spark, [])).collect() == []


@pytest.mark.parametrize("range_rows", [5, 1000])
def test_edited_pairs(spark, range_rows):
    rows = sorted(samples.documents(), key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    found = sketches.edited_pairs(samples.frame(spark, rows), range_rows=range_rows).collect()
    expected, prints = Counter(), {}
    for (id_, text), (_, after) in zip(rows, [*rows[1:], rows[0]], strict=True):
        text, after = text or "", after or ""
        edited = text[:len(text) - len(text) // 2] + after[:len(text) // 2]
        expected[id_, len(text), hashlib.sha256(edited.encode()).hexdigest()] += 1
        prints[id_, edited] = text == edited
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found) == expected
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in found)
    assert all(r["near_edited"] == 1 for r in found if r["fingerprint"] == r["edited_fingerprint"])


def test_sketches_merge_and_estimate():
    import pyarrow as pa

    from vitrine.llm.arrays import text_bytes

    words = [f"w{i}" for i in range(4000)]
    whole, part, other = " ".join(words), " ".join(words[500:1500]), " ".join(f"v{i}" for i in range(900))
    a, b, c, none, blank = sketches.sketch_block(text_bytes(pa.array([whole, part, other, "", " "])))
    assert sketches.likeness(a, b) == 1 and sketches.likeness(a, c) == 0
    assert len(none) == 1 and none[0] == blank[0]
    assert abs(len(a) * sketches.SCALE - 4000) < 400
    first, second = sketches.sketch_block(text_bytes(pa.array([" ".join(words[:2004]), " ".join(words[2000:])])))
    assert np.array_equal(sketches.merge([first, second]), a)


def test_one_and_no_document(spark):
    assert sketches.edited_pairs(samples.frame(spark, [])).collect() == []
    row = sketches.edited_pairs(samples.frame(spark, [(5, "abcd")])).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and row["near_next"] == 1
