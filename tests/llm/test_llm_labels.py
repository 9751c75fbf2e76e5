"""Language identification and toxicity: held-out accuracy, awkward rows, exact search."""

from __future__ import annotations

import os
import tracemalloc
import zlib

import numpy as np
import pytest
import samples

from vitrine.llm import langid, toxicity
from vitrine.llm.queries import QUERIES

LARGE = os.environ.get("TEST_SF_DIR_LARGE", "/root/testdata/sf0.1")


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{LARGE}/documents.parquet").select("doc_id", "lang").toPandas()
    found = QUERIES["op4_language_id"](spark, LARGE).toPandas().merge(docs, on="doc_id")
    assert len(found) == len(docs)
    assert all((zlib.crc32(str(i).encode()) % 4 == 2) == h for i, h in zip(found["doc_id"], found["held_out"]))
    held_out = found[found["held_out"]]
    assert (held_out["lang"] == held_out["lang_pred"]).mean() > 0.995
    assert found["score"].between(0, 1).all()


def test_toxicity_of_held_out_documents(spark):
    labels = spark.read.parquet(f"{LARGE}/labels.parquet").toPandas()
    found = QUERIES["op3_toxicity"](spark, LARGE).toPandas()
    assert found["score"].between(0, 1).all() and found["doc_id"].is_unique
    assert all((zlib.crc32(str(i).encode()) % 5 == 0) == h for i, h in zip(found["doc_id"], found["held_out"]))
    held_out = found[found["held_out"]].merge(labels, on="doc_id")
    predicted, toxic = held_out["predicted"] == 1, held_out["toxic"] == 1
    assert toxic[predicted].mean() > 0.85 and predicted[toxic].mean() > 0.8


def test_language_of_awkward_rows(spark):
    english, german = "the weather and the night are there with them", "der Winter und die Nacht sind schon bei uns"
    learned = spark.createDataFrame(
        [(i, t, lang) for i in range(6) for t, lang in ((english, "en"), (german, "de"), (None, "de"), (english, None))],
        "doc_id long, text string, lang string")
    filters = langid.fit(learned)
    assert sorted(filters.languages) == ["de", "en"]
    rows = [(1, "The night and the weather"), (2, None), (3, ""), (4, "12 !?"), (None, "die Nacht und der Winter"), (5, "Ж"),
            (5, "Ж")]
    found = langid.predict(samples.frame(spark, rows), filters)
    assert "text" not in found.columns
    got = {(r["doc_id"], r["lang_pred"]) for r in found.collect()}
    frequent = filters.languages[0]
    assert got == {(1, "en"), (2, "und"), (3, "und"), (4, "und"), (None, "de"), (5, frequent)}
    none = langid.fit(learned.limit(0))
    assert {r["lang_pred"] for r in langid.predict(samples.frame(spark, rows), none).collect()} == {"und"}
    assert langid.predict(samples.frame(spark, []), filters).collect() == []


def test_bloom_table_returns_all_languages():
    texts = langid.Texts(np.frombuffer(b"abcdefgh", np.uint8), np.array([0, 8]))
    codes, _ = langid.n_grams(texts)
    table = np.zeros(1 << 10, np.uint8)
    for bit in (0, 3):
        for at in langid.slot_numbers(codes, 1 << 10):
            table[at] |= np.uint8(1 << bit)
    filters = langid.Filters(table, ["a", "b", "c", "d"], np.zeros(4))
    assert langid.evidence(texts, filters)[0].tolist() == [1, 0, 0, 1]


@pytest.mark.parametrize("leave", [-1, 17])
def test_nearest_equals_full_search(leave):
    rng = np.random.default_rng(3)
    counts = rng.poisson(rng.choice([0.02, 0.1, 0.5], 60), (500, 60))
    weights = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0)
    weights = weights / np.maximum(np.linalg.norm(weights, axis=1, keepdims=True), 1e-9)
    parts = []
    for some in (counts[:200], counts[200:200], counts[200:]):
        example, term = np.nonzero(some)
        parts.append((np.searchsorted(example, np.arange(len(some) + 1)), term, some[example, term]))
    search = toxicity.Search(toxicity.index_of(parts, np.ones(60), (counts > 0).sum(0)))
    for row in weights[:50]:
        used = np.flatnonzero(row)
        best, scores = search.nearest(used, row[used], 15, leave)
        cosines = weights @ row
        if leave >= 0:
            cosines[leave] = 0
        expected = np.lexsort((np.arange(500), -np.round(cosines, 12)))[:15]
        expected = expected[cosines[expected] > 0]
        assert best.tolist() == expected.tolist()
        assert np.allclose(scores, cosines[expected])
    assert search.skipped > 0


def test_dense_terms_are_few_and_change_nothing(monkeypatch):
    rng = np.random.default_rng(5)
    counts = rng.poisson(0.4, (300, 50))
    counts[250:] = counts[0]  # equal examples are all candidates
    example, term = np.nonzero(counts)
    parts = [(np.searchsorted(example, np.arange(301)), term, counts[example, term])]
    factors, values = rng.uniform(1, 9, 50), np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0)
    weights = values * factors
    weights = weights / np.maximum(np.linalg.norm(weights, axis=1, keepdims=True), 1e-9)
    for dense in (0, 7, 1024):
        monkeypatch.setattr(toxicity, "DENSE", dense)
        search = toxicity.Search(toxicity.index_of(parts, factors, (counts > 0).sum(0)))
        used = [np.flatnonzero(row) for row in weights[:20]]
        ends = np.append(0, np.cumsum([len(u) for u in used]))
        common = search.common_products(ends, np.concatenate(used), np.concatenate([w[u] for w, u in zip(weights, used, strict=False)]))
        assert common.dtype == np.float32 and (dense or not common.any())
        for row, u, c in zip(weights, used, common, strict=False):
            cosines = weights @ row
            expected = np.lexsort((np.arange(300), -np.round(cosines, 12)))[:15]
            expected = expected[cosines[expected] > 0]
            best, scores = search.nearest(u, row[u], 15, -1, c)
            assert best.tolist() == expected.tolist() and np.allclose(scores, cosines[expected], rtol=1e-12)


def test_parts_of_the_index_are_made_by_tasks(spark, monkeypatch):
    """Whatever the examples' terms, the driver holds a few arrays by term and packed parts; before, it had the whole index."""
    rng = np.random.default_rng(9)
    words = np.array(["".join(w) for w in rng.choice(list("abcdefghijklmnop"), (300, 12))])
    rows = [(i, " ".join(words[rng.integers(0, 300, 250)])) for i in range(2000)]
    docs = samples.frame(spark, rows).repartition(4).localCheckpoint()
    labels = spark.createDataFrame([(i, i % 3 // 2) for i in range(2000)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "PART_TERMS", 50_000)
    tracemalloc.start()
    model = toxicity.fit(docs, labels)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    packed, order, norms, marks, ids = model.examples.value
    weights = toxicity.Weights(*toxicity.unpack(model.weights.value))
    parts = [toxicity.Part(*toxicity.unpack(x)) for x in packed]
    index = toxicity.merged(parts, order, norms, weights)
    assert len(parts) > 4 and sorted(ids.tolist()) == list(range(2000)) and marks.tolist() == [i % 3 // 2 for i in ids]
    postings = len(index.example) + len(index.row_common)
    assert postings > 1_000_000 and peak < 8 * postings
    # Every example is nearest to itself, with a cosine of 1.
    texts, known, search = dict(rows), toxicity.Terms(model.terms.value), toxicity.Search(index)
    for number in range(0, 2000, 97):
        text = texts[int(ids[number])].encode()
        _, term, uses = known.counts(toxicity.Texts(np.frombuffer(text, np.uint8), np.array([0, len(text)])))
        values = (1 + np.log(uses)) * index.factors[term]
        best, cosines = search.nearest(term, values / np.linalg.norm(values), 3)
        assert best[0] == number and abs(cosines[0] - 1) < 1e-3


def test_equal_postings_are_one_list_and_change_nothing(monkeypatch):
    """Words and their beginnings share their postings; before, each was held and read for itself."""
    rng = np.random.default_rng(11)
    counts = rng.poisson(0.03, (400, 40)) * rng.choice([1, 1, 1, 9], (400, 40))
    counts = np.concatenate([counts, counts[:, :30], counts[:, :30], np.maximum(counts[:, :1], 1) * 300], 1)
    example, term = np.nonzero(counts)
    parts = [(np.searchsorted(example, np.arange(401)), term, counts[example, term])]
    factors = rng.uniform(1, 9, 101)
    index = toxicity.index_of(parts, factors, (counts > 0).sum(0))
    for most in (1 << 21, 7):
        monkeypatch.setattr(toxicity, "PART_TERMS", most)
        first, kinds = toxicity.equal_lists(index.bounds, index.example, index.uses)
        assert (kinds[:30] == kinds[40:70]).all() and (kinds[:30] == kinds[70:100]).all()
        lists = {k: {tuple(np.stack([index.example, index.uses])[:, index.bounds[t]:index.bounds[t + 1]].ravel().tolist())
                     for t in np.flatnonzero(kinds == k)} for k in range(len(first))}
        assert all(len(x) == 1 for x in lists.values()) and len(set().union(*lists.values())) == len(first)
    search = toxicity.Search(index)
    assert search._postings.bounds[-1] < 0.5 * index.bounds[-1]
    weights = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0) * factors
    weights = weights / np.linalg.norm(weights, axis=1, keepdims=True)
    for row in weights[:60]:
        used = np.flatnonzero(row)
        best, scores = search.nearest(used, row[used], 15)
        cosines = weights @ row
        expected = np.lexsort((np.arange(400), -np.round(cosines, 12)))[:15]
        assert best.tolist() == expected.tolist() and np.allclose(scores, cosines[expected], rtol=1e-12)


def test_a_worker_makes_a_search_once(spark):
    """Before, every task unpacked and merged the whole index for itself."""
    made = []
    rows = [(i, f"word{i % 7} of peace {'vile ' * (i % 2)}") for i in range(60)]
    model = toxicity.fit(samples.frame(spark, rows), spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int"))
    for _ in range(2):
        made.append(toxicity.kept_search(model.examples, model.weights))
    assert made[0] is made[1] and list(toxicity._KEPT) == [model.examples]
    toxicity._KEPT.clear()


def test_texts_wait_for_each_other_but_keep_their_rows(spark, monkeypatch):
    """Texts of several blocks are searched together; every row comes out once, with the score of its text."""
    assert [len(x) for x in toxicity.even_runs(list(range(1000)), 384)] == [500, 500]
    assert list(toxicity.even_runs([], 384)) == [] and list(toxicity.even_runs([1], 384)) == [[1]]
    rows = [(i, f"word{i % 7} of peace {'vile ' * (i % 2)}") for i in range(60)]
    model = toxicity.fit(samples.frame(spark, rows), spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int"))
    long = "calm " * 120_000  # more than a block
    asked = [(i, (long if i % 50 == 3 else "") + ("vile" if i % 3 == 0 else "peace") + f" word{i % 5}") for i in range(500)]
    found = toxicity.score(samples.frame(spark, asked).coalesce(1), model).select("doc_id", "score").collect()
    assert sorted(r["doc_id"] for r in found) == list(range(500))
    by_text = {}
    texts = dict(asked)
    for r in found:
        by_text.setdefault(texts[r["doc_id"]], set()).add(r["score"])
    assert all(len(x) == 1 for x in by_text.values())
    assert all((r["score"] >= 0.5) == texts[r["doc_id"]].split()[-2].endswith("vile") for r in found)


def test_toxicity_of_awkward_rows(spark):
    rows = [(i, "vile " * (i % 2) + f"word{i} of peace") for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(None, 1), (900, 1), (1, None), (1, 0)],
                                   "doc_id long, toxic int")
    model = toxicity.fit(samples.frame(spark, rows), labels)
    more = samples.frame(spark, [(1, "Vile!"), (2, None), (3, ""), (None, "peace"), (5, "vile"), (5, "vile")])
    found = sorted(((r["doc_id"] or 0, r["score"] >= 0.5) for r in toxicity.score(more, model).collect()))
    assert found == [(0, False), (1, True), (2, False), (3, False), (5, True), (5, True)]
    nothing = toxicity.fit(samples.frame(spark, rows), labels.limit(0))
    assert {r["score"] for r in toxicity.score(more, nothing).collect()} == {0.0}
    assert toxicity.score(samples.frame(spark, []), model).collect() == []
