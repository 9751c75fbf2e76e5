"""Cases beyond former bounds: rare terms, long texts, many languages."""

from __future__ import annotations

import math
import random

import brute
import numpy as np
import samples

from vitrine.llm import decontaminate, langid, toxicity


def toxic_terms(text):
    words = [w.encode() for w in brute.FOLDED.findall(brute.folded(text))]
    out = {}
    for t in words + [w[:n] for w in words for n in toxicity.PREFIXES if len(w) > n]:
        out[t] = out.get(t, 0) + 1
    return out


def test_evidence_is_that_of_full_cosines(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", 8)
    rng = random.Random(1)
    # The telling word of three examples is rarer than any former bound allowed.
    rows = [(i, samples.sentence(rng, 20) + (" zlotrup" if i in (3, 40, 77) else "")) for i in range(90)]
    marks = {i: int(i in (3, 40, 77)) for i in range(80)}
    docs = samples.frame(spark, rows + [(90, "Zlotrup " + samples.sentence(rng, 20))])
    labels = spark.createDataFrame(list(marks.items()), "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    ids = toxicity.unpack(model.examples.value)[2]
    found = {r["doc_id"]: r["evidence"] for r in toxicity.score(docs, model).collect()}

    terms = {r["doc_id"]: toxic_terms(r["text"]) for r in docs.collect()}
    n, toxic = len(marks), sum(marks.values())
    idf, chi = {}, {}
    for t in {t for x in terms.values() for t in x}:
        idf[t] = math.log((1 + len(terms)) / (1 + sum(t in x for x in terms.values()))) + 1
        uses, hits = sum(t in terms[i] for i in marks), sum(t in terms[i] for i in marks if marks[i])
        below = uses * (n - uses) * toxic * (n - toxic)
        chi[t] = n * max(abs(hits * n - uses * toxic) - n / 2, 0) ** 2 / below if below else 0.0

    def weights(of):
        return {t: (1 + math.log(c)) * idf[t] * math.sqrt(1 + chi[t]) for t, c in of.items()}

    def cosine(a, b):
        return sum(a[t] * b[t] for t in a.keys() & b.keys()) / math.hypot(*a.values()) / math.hypot(*b.values())

    vectors = {i: weights(x) for i, x in terms.items()}
    for i in [*range(80, 91), 5]:
        cosines = np.array([cosine(vectors[i], vectors[int(e)]) for e in ids])
        expected = np.lexsort((np.arange(n), -np.round(cosines, 12)))[:toxicity.NEIGHBOURS]
        assert found[i] == [int(ids[e]) for e in expected if cosines[e] > 0]
    assert set(found[90][:3]) == {3, 40, 77}


def test_long_texts_are_searched_in_shards(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SHARD", 40)
    rng = random.Random(2)
    words = ["one", "two", "three", "four"]
    items = [(1, " ".join(words * 3)), (None, "two two one"), (2, "four two"), (3, " ".join(rng.choices(words, k=14)))]
    rows = [(i, " ".join(rng.choices(words, k=n))) for i, n in enumerate((500, 39, 40, 41, 3))] + [(9, items[3][1] * 9)]
    assert len(decontaminate.windows_of([(str(i), t) for i, t in items], 10).lengths) > 3
    found = decontaminate.overlaps(samples.frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    ours = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in found.collect()}
    named = [("~" if i is None else i, t) for i, t in items]  # sorts behind digits
    for i, n, hit, ids in brute.overlaps(rows, named, 10):
        assert ours[i] == (n, hit, [None if x == "~" else x for x in ids])


def test_text_longer_than_one_index():
    n = decontaminate.MOST + 100
    known = decontaminate.windows_of([("a", " ".join("abcdefghij"))], 10)
    data = np.full(2 * n, ord(" "), np.uint8)
    data[::2] = np.frombuffer(b"a", np.uint8)
    data[2 * (n - 60):2 * (n - 50):2] = np.frombuffer(b"abcdefghij", np.uint8)
    hits = decontaminate.find_hits(decontaminate.Texts(data, np.array([0, 2 * n])), known)
    assert [s[:2] for s in hits.spans[0]] == [(n - 60, n - 50)] and hits.pairs.tolist() == [[0, 0]]


def test_more_languages_than_bits(spark):
    def text(i):
        rng = random.Random(i)
        return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(12))

    # The last label has only digits, so no n-grams, and is the most frequent.
    learned = [(i, text(i % 130), f"l{i % 130:03}") for i in range(390)] + [(1000 + i, "1 2 3", "digits") for i in range(9)]
    filters = langid.fit(spark.createDataFrame(learned, "doc_id long, text string, lang string"))
    assert filters.languages == [f"l{i:03}" for i in range(130)] and filters.slots.shape == (langid.SLOTS, 3)
    found = langid.predict(samples.frame(spark, [(i, text(i)) for i in range(130)]), filters).collect()
    assert {(r["doc_id"], r["lang_pred"]) for r in found} == {(i, f"l{i:03}") for i in range(130)}
