"""Plain versions of the text operators, for small inputs."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import xxhash

FOLDED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def folded(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def repeats(rows, length, split, join):
    """By row: number of symbols, removed ones, removed runs, digest of the rest. ``rows``: (id, text)."""
    order = sorted({r[0] for r in rows}, key=lambda i: (i is not None, i))
    rank = {i: n for n, i in enumerate(order)}
    first, parts = {}, [split(text or "") for _, text in rows]
    for (id_, _), symbols in sorted(zip(rows, parts), key=lambda x: rank[x[0][0]]):
        for i in range(len(symbols) - length + 1):
            first.setdefault(tuple(symbols[i:i + length]), rank[id_])
    out = []
    for (id_, _), symbols in zip(rows, parts):
        gone = [False] * len(symbols)
        for i in range(len(symbols) - length + 1):
            if first[tuple(symbols[i:i + length])] < rank[id_]:
                gone[i:i + length] = [True] * length
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = join([s for s, g in zip(symbols, gone) if not g])
        out.append((id_, len(symbols), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def overlaps(rows, items, window):
    known, out = {}, []
    for item, text in items:
        words = FOLDED.findall(folded(text))
        for i in range(max(len(words) - window, 0) + 1 if words else 0):
            known.setdefault(tuple(words[i:i + window]), set()).add(str(item))
    for id_, text in rows:
        words, hit, found = FOLDED.findall(folded(text)), set(), set()
        for size in {len(k) for k in known}:
            for i in range(len(words) - size + 1):
                holders = known.get(tuple(words[i:i + size]))
                if holders:
                    hit.update(range(i, i + size))
                    found |= holders
        out.append((id_, len(words), len(hit), sorted(found)))
    return out


def simhash(text):
    words = SPACED.findall(folded(text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints):
    """Smallest id reachable by links of at most 2 bits; ``prints``: id -> fingerprint."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    values = np.array([prints[i] for i in ids], np.uint64)
    for i, id_ in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(values[i] ^ values) <= 2):
            a, b = find(id_), find(ids[j])
            root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}
