"""Awkward documents: nulls, empty and very long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random

ROW = "doc_id long, text string, lang string, row long, items string, score double, id string, anchor int"


def sentence(rng, n):
    return " ".join("".join(rng.choice("aeioumnrst") for _ in range(rng.randint(1, 7))) for _ in range(n))


def documents():
    rng = random.Random(5)
    passage, line = sentence(rng, 70), sentence(rng, 60)
    texts = [(i, f"{sentence(rng, 30)} {line if i % 3 == 0 else ''} {sentence(rng, rng.randint(0, 40))}") for i in range(10, 40)]
    texts += [(3, passage), (2, f"Zuvor {passage}, danach"), (50, f"{passage} {passage}"), (51, passage), (51, passage),
              (52, passage + " x"), (52, "y " + passage), (None, passage), (None, None), (60, None), (61, ""),
              (62, " \t\n "), (63, "a"), (64, "Éß ñ 中文 🙂 <|endoftext|> it's 12  x\n\n y"), (65, "!?"),
              (66, "ab " * 30_000), (67, "x" * 70_000), (68, sentence(rng, 9_000))]
    texts += [(100 + i, texts[0][1]) for i in range(6)]
    return texts


def frame(spark, rows=None):
    return spark.createDataFrame(
        [(i, t, "xx", 1, "i", 0.5, "k", 7) for i, t in (documents() if rows is None else rows)], ROW).repartition(3)
