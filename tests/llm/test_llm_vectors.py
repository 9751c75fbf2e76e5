"""Product codes against plain k-means with whole numbers."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from vitrine.llm import vectorcodes

ROW = "vec_id long, embedding array<float>, label int, code string, part int"


def plain(rows, parts, entries, rounds):
    """rows of (vec_id, vector, label) in order of id."""
    cut = [[[math.floor(4096 * float(x)) for x in v[p * len(v) // parts:(p + 1) * len(v) // parts]] for p in range(parts)]
           for _, v, _ in rows]
    books = [[list(cut[i][p]) for i in range(min(entries, len(rows)))] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            mine = [nearest(c[p], book)[1] for c in cut]
            for e in range(len(book)):
                own = [c[p] for c, m in zip(cut, mine, strict=True) if m == e]
                if own:
                    book[e] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(f[0] for f in x) for x in found]
    out = sorted((i, "".join(f"{f[1]:02x}" for f in x), e, sum(e2 for e2, r2 in zip(errors, rows, strict=True) if r2[2] == label))
                 for (i, _, label), x, e in zip(rows, found, errors, strict=True))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return out, digest


def as_frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], ROW).repartition(3)


@pytest.mark.parametrize("n, parts, entries, width", [(150, 4, 16, 12), (9, 2, 16, 4), (200, 2, 70, 2), (40, 8, 4, 8)])
def test_codes(spark, n, parts, entries, width):
    rng = random.Random(n)
    # Coarse values make ties.
    rows = [(7 * i % n, [float(np.float32(rng.choice([rng.gauss(0, 1), round(rng.gauss(0, 1)), -0.0]))) for _ in range(width)],
             rng.choice([None, 1, 2])) for i in range(n)]
    broken = [(-1, None, 1), (-2, [], 1), (-3, [None] + [0.0] * (width - 1), 1), (-4, [float("nan")] * width, None),
              (-5, [float("-inf")] + [0.0] * (width - 1), 1), (-6, [0.5] * (width + parts), 2)]
    coded, books = vectorcodes.compress(as_frame(spark, rows + broken), parts, entries, 4)
    found = sorted((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in coded.collect())
    expected, digest = plain(sorted(rows, key=lambda r: r[0]), parts, entries, 4)
    assert found == expected and vectorcodes.books_digest(books) == digest


def test_masks_find_the_nearest():
    rng = np.random.default_rng(2)
    for entries, width, size in ((16, 8, 1000), (1, 3, 5), (70, 2, 6), (16, 8, 2), (130, 4, 100), (16, 1, 100_000_000)):
        book, points = rng.integers(-size, size, (entries, width)), rng.integers(-size, size, (3000, width))
        index, far = vectorcodes.PartBook(book).nearest(points)
        all_far = ((points[:, None] - book) ** 2).sum(axis=2)
        assert (index == all_far.argmin(axis=1)).all() and (far == all_far.min(axis=1)).all()


def test_boxes_leave_out_entries():
    book = vectorcodes.PartBook(np.arange(64)[:, None] * np.array([1000, 10]))
    masks = book.box(np.array([[3000, 30], [3000, 600]]), np.array([1500, 1500]))
    assert masks[:, 0].tolist() == [0b11100, 0b11100] and book.box(np.array([[3000, 30]]), np.array([15]))[0, 0] == 0b1000


def test_repeated_and_null_ids_and_empty(spark):
    rows = [(None, [5.0, 5.0], 1), (1, [0.0, 1.0], None), (1, [0.0, 1.0], None), (1, [-1.0, 0.0], 3)]
    coded, books = vectorcodes.compress(as_frame(spark, rows), 2, 2, 1)
    assert coded.count() == 4 and [b[:, 0].tolist() for b in books] == [[-4096, 6826], [0, 9557]]
    empty, none = vectorcodes.compress(as_frame(spark, []), 2)
    assert empty.count() == 0 and none == [] and empty.columns == ["vec_id", "label", "code", "error", "label_error"]
    with pytest.raises(ValueError):
        vectorcodes.compress(as_frame(spark, [(1, [0.0, 1.0, 2.0], 1)]), 2)
