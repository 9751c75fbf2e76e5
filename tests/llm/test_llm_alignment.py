"""Token alignment against the definition, pair by pair."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import samples

from vitrine.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    return a, b, alignment.Tokenizers(A, B)


def whole(library, text):
    """Ids and byte ends of a text by both, or nothing."""
    a, b, known = library
    if not text:
        return None
    ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    parts = [known.bytes_a[i] for i in ids[0]], [known.bytes_b[i] for i in ids[1]]
    if any(b"".join(x) != (" " + text).encode() for x in parts):
        return None
    return ids, [np.cumsum([len(y) for y in x]).tolist() for x in parts]


def by_definition(library, texts):
    found, counts = [], Counter()
    for text in texts:
        known = whole(library, text)
        if known is None:
            found.append(None)
            continue
        (a, b), (end_a, end_b) = known
        links = [(x, y) for i, x in enumerate(a) for j, y in enumerate(b)
                 if max(end_a[i - 1] if i else 0, end_b[j - 1] if j else 0) < min(end_a[i], end_b[j])]
        common = sorted(set(end_a) & set(end_b))
        groups, before = [], 0
        for end in common:
            groups.append(",".join(str(x) for x, e in zip(a, end_a, strict=True) if before < e <= end) + "|"
                          + ",".join(str(x) for x, e in zip(b, end_b, strict=True) if before < e <= end))
            before = end
        counts.update(links)
        found.append((len(a), len(b), len(groups), links, ";".join(groups)))
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    return [(0, 0, 0, 0, "", 0, 0) if x is None else
            (*x[:3], len(x[3]), x[4], sum(counts[p] == best[p[1]] for p in x[3]), sum(counts[p] for p in x[3])) for x in found]


HARD = ["a", "the", " ", "  ", "\n", "\n\n", "\t", "é", "ö", "中文", "🙂", "<|endoftext|>", "<s>", "</s>", "<0x41>", "'s", "don't", "12,345", "ab ",
        " .", "...", "　", "\xa0", "\x1c", "\x00", "word", "tokenization", "▁", "ﬁ", "​", "Ġ"]


def hard_texts():
    rng = random.Random(11)
    texts = [" ".join(rng.choices(HARD, k=rng.randint(0, 12))) for _ in range(150)]
    texts += ["".join(rng.choices(HARD, k=rng.randint(0, 12))) for _ in range(250)]
    return texts + ["", " ", "  ", "a ", " a", "a  ", "\n", "x" * 3000, "ab cd " * 500, "▁", "x▁y", "naïve café", "a\n b"]


@pytest.mark.parametrize("head", [0, 20, alignment.HEAD])
def test_by_definition(spark, library, head, monkeypatch):
    monkeypatch.setattr(alignment, "ROW_PAIRS", 7)
    texts = hard_texts() + [None]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, "ab cd")]
    expected = by_definition(library, [t for _, t in rows])
    found = alignment.align(samples.frame(spark, rows), A, B, head=head).collect()
    ours = sorted((r["doc_id"] is None, r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups"], r["n_best"],
                   r["count_sum"]) for r in found)
    assert ours == sorted((i is None, i, *e) for (i, _), e in zip(rows, expected, strict=True))


def test_pre_tokens_give_the_tokens_of_whole_texts(library):
    known = alignment.KnownTexts(library[2])
    texts = [t for t in hard_texts() + [t for _, t in samples.documents()] if t]
    chunks = [alignment.split_text(t) for t in texts]
    known.learn(set().union(*chunks))
    found = known.ids(chunks)
    for i, (text, parts) in enumerate(zip(texts, chunks, strict=True)):
        expected = whole(library, text)
        assert "".join(parts) == " " + text
        assert [x.flat[x.bounds[i]:x.bounds[i + 1]].tolist() for x in found] == ([list(x) for x in expected[0]] if expected else [[], []])


def test_windows_are_remembered_by_ids(library):
    tokenizers = library[2]
    known, aligner = alignment.KnownTexts(tokenizers), alignment.Aligner(tokenizers)
    texts = ["one two one two one"] * 3
    fields, pairs, uses = alignment.align_block(texts, known, aligner, tokenizers, digest=False)
    assert len(aligner.names) == 2 and fields["n_groups"].tolist() == [5, 5, 5] and uses.tolist() == [2, 3] * 3 or uses.tolist() == [3, 2] * 3
    again = alignment.align_block(texts[:1], known, aligner, tokenizers, digest=True)[0]
    assert len(aligner.names) == 2 and len(again["groups"][0]) == 64


def test_long_text_of_more_than_a_block(spark, library):
    text = "lorem ipsum <s> dolor\n" * 60_000
    assert len(text) > 2 * alignment.BLOCK_BYTES
    row = alignment.align(samples.frame(spark, [(1, text)]), A, B, digest=True).first()
    ids, ends = whole(library, text)
    assert (row["n_a"], row["n_b"]) == (len(ids[0]), len(ids[1])) and row["n_groups"] == len(set(ends[0]) & set(ends[1]))


def test_empty_table(spark):
    assert alignment.align(samples.frame(spark, []), A, B).count() == 0
