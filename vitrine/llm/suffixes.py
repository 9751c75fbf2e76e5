"""Suffix arrays by Larsson-Sadakane refinement and their common prefixes, in arrays."""

from __future__ import annotations

import numpy as np

#: Places that fit, three times over, into one 64-bit sort key.
MOST = (1 << 21) - 2
_BITS = np.uint64(21)
_STRIDE = 8


def first_ranks(symbols: np.ndarray) -> tuple[np.ndarray, int]:
    """Rank keys of the first symbols of every suffix, and how many symbols they cover.

    As many symbols as fit are packed into 42 bits.
    """
    n = len(symbols)
    present = np.zeros(int(symbols.max()) + 1, np.uint64)
    present[symbols] = 1
    dense = np.cumsum(present).astype(np.uint64)  # 1, 2, ...; 0 stands behind the end
    width = max(1, int(dense[-1]).bit_length())
    depth = max(1, 42 // width)
    codes = dense[symbols]
    key = np.zeros(n, np.uint64)
    for i in range(depth):
        key <<= np.uint64(width)
        if i < n:
            key[:n - i] |= codes[i:]
    return key, depth


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and ranks of ``symbols`` (small non-negative integers, at most ``MOST`` of them).

    Suffixes are sorted by their first symbols; then, round by round, only those
    still tied are sorted by the rank of the suffix that stands as far behind
    them as is sorted already, which doubles the sorted length. Rank, following
    rank and place share one number, so a round is one sort of plain integers.
    """
    n = len(symbols)
    if n > MOST:
        raise ValueError(f"a shard holds at most {MOST} symbols")
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    low = (np.uint64(1) << _BITS) - np.uint64(1)
    key, depth = first_ranks(symbols)
    packed = np.sort((key << _BITS) | np.arange(n, dtype=np.uint64))
    order = (packed & low).astype(np.int64)
    top = packed >> _BITS
    new = np.concatenate([[True], top[1:] != top[:-1]])
    # A group's rank is the place of its last member, as in the original method; here of its first.
    heads = np.flatnonzero(new)
    group = heads[np.cumsum(new) - 1]
    rank = np.empty(n + 1, np.int64)
    rank[order] = group + 1
    rank[n] = 0
    sizes = np.diff(np.append(heads, n))
    tied = np.flatnonzero(np.repeat(sizes > 1, sizes))
    while len(tied):
        at = order[tied]
        packed = ((rank[at].astype(np.uint64) << (_BITS * np.uint64(2)))
                  | (rank[np.minimum(at + depth, n)].astype(np.uint64) << _BITS) | at.astype(np.uint64))
        packed.sort()
        at = (packed & low).astype(np.int64)
        order[tied] = at
        top = packed >> _BITS
        new = np.concatenate([[True], top[1:] != top[:-1]])
        heads = np.flatnonzero(new)
        rank[at] = tied[heads[np.cumsum(new) - 1]] + 1
        sizes = np.diff(np.append(heads, len(tied)))
        tied = tied[np.repeat(sizes > 1, sizes)]
        depth *= 2
    return order, rank[:n] - 1


def common_prefixes(data: np.ndarray, order: np.ndarray, rank: np.ndarray, most: int) -> np.ndarray:
    """Common prefix of every suffix of bytes with the one before it in the suffix array, up to ``most``; by place.

    Kasai's rule: the prefix at place i + s is at least that at i less s. Every
    ``_STRIDE``-th place is compared from its begin, the places behind it from that
    bound on, eight bytes at a time.
    """
    n = len(data)
    found = np.zeros(n, np.int64)
    padded = np.zeros(n + most + 16, np.uint8)
    padded[:n] = data
    eight = np.zeros(n + most + 8, np.uint64)
    for i in range(8):
        eight |= padded[i:i + n + most + 8].astype(np.uint64) << np.uint64(8 * i)
    before = np.where(rank > 0, order[rank - 1], -1)

    def compare(places: np.ndarray, length: np.ndarray) -> None:
        other = before[places]
        limit = np.where(other >= 0, np.minimum(most, n - np.maximum(places, other)), 0)
        active = np.flatnonzero(length < limit)
        while len(active):
            at = length[active]
            differ = eight[places[active] + at] ^ eight[other[active] + at]
            lowest = differ & (~differ + np.uint64(1))
            same = np.where(differ == 0, 8, np.bitwise_count(lowest - np.uint64(1)) >> 3)
            length[active] = at + same
            active = active[(same == 8) & (length[active] < limit[active])]
        found[places] = np.minimum(length, limit)

    every = np.arange(0, n, _STRIDE)
    compare(every, np.zeros(len(every), np.int64))
    rest = np.arange(n)
    rest = rest[rest % _STRIDE != 0]
    compare(rest, np.maximum(found[rest - rest % _STRIDE] - rest % _STRIDE, 0))
    return found
