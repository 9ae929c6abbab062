"""Suffix arrays by induced sorting, and common prefixes in text order (used by operator 13).

A sequence holds separators, each of a value of its own, below all other values; it ends in the smallest of them, 0.
A common prefix therefore never reaches beyond a separator.
"""

from __future__ import annotations

import numpy as np


def _smaller(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one after it (the last one counts as such)."""
    step = np.sign(np.diff(t))
    at = np.where(step != 0, np.arange(len(step)), len(step))
    decided = np.minimum.accumulate(at[::-1])[::-1]
    return np.append(np.append(step, -1)[decided] > 0, True)


def _chained(places: np.ndarray, reach: np.ndarray, keys: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """``places`` in order of their keys up to and at the one ``reach`` away, where a chain ends, and of its rank.

    Sorted from the far ends of the chains: a pass per distance takes in the chains that end there.
    """
    ends = places + reach
    by_rank = places[np.argsort(rank[ends], kind="stable")]
    far = np.zeros(len(keys), np.int64)
    far[places] = reach
    groups = by_rank[np.argsort(-far[by_rank], kind="stable")]
    cuts = np.searchsorted(-far[groups], np.arange(-int(reach.max(initial=0)), 1))
    cuts = np.append(cuts, len(groups))
    out = groups[:0]
    for k, distance in enumerate(range(int(reach.max(initial=0)), -1, -1)):
        out = np.concatenate([out, groups[cuts[k] : cuts[k + 1]]])
        out = out[np.argsort(keys[out + distance], kind="stable")]
    return out


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Start places of the suffixes of ``t`` in order. The last value is 0 and stands once.

    Suffixes are classed as smaller or larger than their successor. The leftmost smaller ones are sorted first, by
    their substrings and, where those repeat, by the suffix array of their names, in the same way. The larger suffixes
    follow from them, each through the chain of larger ones up to a leftmost smaller one, and then the smaller
    suffixes, through the chains up to a larger one.
    """
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int64)
    small = _smaller(t)
    leftmost = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    keys = 2 * t + small
    if keys.max() < 1 << 16:
        keys = keys.astype(np.uint16)
    places = np.arange(n)
    next_small = np.minimum.accumulate(np.where(small, places, n)[::-1])[::-1]
    next_large = np.minimum.accumulate(np.where(small, n, places)[::-1])[::-1]
    large_places = np.flatnonzero(~small)
    small_places = np.flatnonzero(small)[:-1]
    small_places = small_places[next_large[small_places] < n]

    def induced(order: np.ndarray) -> np.ndarray:
        """All suffixes in order, from the leftmost smaller ones in order."""
        rank = np.zeros(n, np.int64)
        rank[order] = np.arange(len(order))
        large = _chained(large_places, next_small[large_places] - large_places, keys, rank)
        rank[large] = np.arange(len(large))
        smaller = _chained(small_places, next_large[small_places] - small_places, keys, rank)
        both = np.concatenate([places[-1:], large, smaller])
        return both[np.argsort(keys[both], kind="stable")]

    is_left = np.zeros(n, bool)
    is_left[leftmost] = True
    ordered = induced(leftmost)
    ordered = ordered[is_left[ordered]]
    lengths = np.zeros(n, np.int64)
    lengths[leftmost] = np.append(np.diff(leftmost), 0)
    a, b = ordered[:-1], ordered[1:]
    equal = lengths[a] == lengths[b]
    open_, reach = np.flatnonzero(equal), 0
    while len(open_):
        same = t[a[open_] + reach] == t[b[open_] + reach]
        equal[open_[~same]] = False
        open_ = open_[same]
        reach += 1
        open_ = open_[lengths[a[open_]] >= reach]
    if equal.any():
        names = np.empty(n, np.int64)
        names[ordered] = np.concatenate([[0], np.cumsum(~equal)])
        ordered = leftmost[suffix_array(names[leftmost])]
    return induced(ordered)


def common_prefixes(t: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(lengths, before)`` in text order: of each suffix, the suffix just before it in ``order`` (-1: none) and the
    length of their common prefix.

    Where both are preceded by the same value the length is one less than that of the suffix one place to the left;
    only the other suffixes are compared.
    """
    n = len(t)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    follows = np.zeros(n, bool)
    follows[1:] = (before[1:] > 0) & (t[:-1] == t[before[1:] - 1])
    own = np.flatnonzero(~follows & (before >= 0))
    length, open_, reach = np.zeros(n, np.int64), own, 0
    while len(open_):
        open_ = open_[t[open_ + reach] == t[before[open_] + reach]]
        reach += 1
        length[open_] = reach
    at = np.maximum.accumulate(np.where(follows, 0, np.arange(n)))
    return np.maximum(length[at] - (np.arange(n) - at), 0), before
