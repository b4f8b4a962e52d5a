"""Suffix arrays of byte strings by induced sorting, and their permuted common prefixes, in numpy.

``suffix_array`` classifies every suffix as smaller or larger than its right
neighbour, sorts the substrings between leftmost-smaller positions by one
induction, names them, orders the string of names recursively, and induces the
whole array from that order.  An induction goes through the alphabet once and
handles all entries of a bucket together, so its work is linear in the string.
"""

from __future__ import annotations

import numpy as np


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order.  ``t``: small non-negative integers (16 bits); the last one is a unique 0; under 2^31 of them."""
    n = len(t)
    if n < 3:
        return np.arange(n)[::-1].copy()
    t = t.astype(np.uint16)
    smaller = classify(t)
    left = (np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1).astype(np.int32)
    ends = np.cumsum(np.bincount(t, minlength=int(t.max()) + 1))
    # any order of the leftmost-smaller positions by their first symbol sorts the substrings between them
    first = left[np.argsort(t[left], kind="stable")]
    rough = induce(t, smaller, ends, first)
    is_left = np.zeros(n, dtype=bool)
    is_left[left] = True
    ordered = rough[is_left[rough]]
    names = name(t, left, ordered)
    if names[-1] + 1 < len(ordered):
        # the string of names, in text order, is ordered in turn
        by_place = np.empty(n, dtype=np.int32)
        by_place[ordered] = names
        ordered = left[order_names(by_place[left])]
    return induce(t, smaller, ends, ordered)


def classify(t: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one: decided at the end of each run of equal symbols."""
    edge = np.flatnonzero(t[1:] != t[:-1])
    rising = t[edge] < t[edge + 1]
    run = np.diff(np.concatenate([[-1], edge, [len(t) - 1]]))
    return np.repeat(np.concatenate([rising, [True]]), run)


def induce(t: np.ndarray, smaller: np.ndarray, ends: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The array induced from ``seeds``, the leftmost-smaller positions in order.

    Upwards, every bucket in turn puts the larger-type predecessors of its
    entries at the front of their buckets; downwards, the smaller-type ones at
    the back.  Predecessors in the bucket itself (runs) are followed first.
    """
    starts = np.concatenate([[0], ends[:-1]])
    symbols = np.flatnonzero(ends > starts)
    out = np.empty(len(t), dtype=np.int32)
    seed_ends = np.searchsorted(t[seeds], np.arange(len(ends)), side="right")
    seed_starts = np.concatenate([[0], seed_ends[:-1]])

    def deal(entries, c, wanted):
        """Predecessors of ``entries`` of the wanted type: those in bucket c are placed and returned, the others placed."""
        before = entries[entries > 0] - 1
        before = before[smaller[before] == wanted]
        symbol = t[before]
        return before[symbol == c], before, symbol

    def spread(before, symbol, pointer, front):
        by = np.argsort(symbol, kind="stable")
        before, symbol = before[by], symbol[by]
        edge = np.flatnonzero(symbol[1:] != symbol[:-1]) + 1
        for lo, hi in zip([0, *edge.tolist()], [*edge.tolist(), len(symbol)]):
            s, m = int(symbol[lo]), hi - lo
            if front:
                out[pointer[s]:pointer[s] + m] = before[lo:hi]
                pointer[s] += m
            else:
                out[pointer[s] - m:pointer[s]] = before[lo:hi][::-1]
                pointer[s] -= m

    front = starts.copy()
    for c in symbols.tolist():
        wave, away = out[starts[c]:front[c]], []
        while len(wave):
            own, before, symbol = deal(wave, c, False)
            away.append((before, symbol))
            out[front[c]:front[c] + len(own)] = own
            front[c] += len(own)
            wave = own
        _, before, symbol = deal(seeds[seed_starts[c]:seed_ends[c]], c, False)
        away.append((before, symbol))
        before, symbol = (np.concatenate(x) for x in zip(*away))
        other = symbol != c
        if other.any():
            spread(before[other], symbol[other], front, True)
    back = ends.copy()
    for c in symbols.tolist()[::-1]:
        # entries of a bucket from its back: smaller-type ones as they arrive, then the larger-type ones
        wave, away = out[back[c]:ends[c]][::-1], []
        while len(wave):
            own, before, symbol = deal(wave, c, True)
            away.append((before, symbol))
            out[back[c] - len(own):back[c]] = own[::-1]
            back[c] -= len(own)
            wave = own
        _, before, symbol = deal(out[starts[c]:front[c]][::-1], c, True)
        away.append((before, symbol))
        before, symbol = (np.concatenate(x) for x in zip(*away))
        other = symbol != c
        if other.any():
            spread(before[other], symbol[other], back, False)
    out[0] = len(t) - 1
    return out


def name(t: np.ndarray, left: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Names 0, 1, ... along ``ordered``: equal for equal substrings from one leftmost-smaller position to the next."""
    length = np.empty(len(t), dtype=np.int32)
    length[left] = np.diff(np.concatenate([left, [len(t) - 1]])) + 1
    a, b = ordered[:-1], ordered[1:]
    same = length[a] == length[b]
    if len(same):
        same[0] = False  # the end mark's own
    live = np.flatnonzero(same)
    offset = 0
    while len(live):
        x, y = a[live], b[live]
        same[live[t[x + offset] != t[y + offset]]] = False
        offset += 1
        live = live[same[live] & (length[x] > offset)]
    return np.concatenate([[0], np.cumsum(~same)])


def order_names(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of the string of names: by pairs, then pairs of pairs, among those still equal."""
    n = len(names)
    sizes = np.bincount(names)
    rank = (np.cumsum(sizes) - sizes)[names]  # how many suffixes are certainly smaller
    equal = np.flatnonzero(sizes[names] > 1)
    step = 1
    while len(equal) and step < n:
        after = np.where(equal + step < n, rank[np.minimum(equal + step, n - 1)] + 1, 0)
        key = rank[equal] * (n + 1) + after
        by = np.argsort(key, kind="stable")
        equal, key = equal[by], key[by]
        old = rank[equal]
        place = np.arange(len(equal))
        new_start = np.concatenate([[True], key[1:] != key[:-1]])
        old_start = np.concatenate([[True], old[1:] != old[:-1]])
        head = np.maximum.accumulate(np.where(new_start, place, 0))
        rank[equal] = old + head - np.maximum.accumulate(np.where(old_start, place, 0))
        alone = new_start & np.concatenate([new_start[1:], [True]])
        equal = np.sort(equal[~alone])
        step *= 2
    order = np.empty(n, dtype=np.int64)
    order[rank] = np.arange(n)
    return order


def common_prefixes(t: np.ndarray, sa: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Per text position, the common prefix with the suffix before it in ``sa``; no prefix runs past a ``stop`` symbol.

    In text order a prefix is one shorter than its left neighbour's if the
    symbols before both suffixes agree; only the others are compared.
    """
    n = len(t)
    previous = np.full(n, -1, dtype=np.int32)
    previous[sa[1:]] = sa[:-1]
    place = np.arange(n, dtype=np.int32)
    known = (previous > 0) & (place > 0)
    at = place[known]
    known[at] = (t[at - 1] == t[previous[at] - 1]) & ~stop[at - 1]
    lcp = np.zeros(n, dtype=np.int32)
    live = np.flatnonzero(~known & (previous >= 0))
    offset = 0
    while len(live):
        x, y = live + offset, previous[live] + offset
        inside = (x < n) & (y < n)
        live, x, y = live[inside], x[inside], y[inside]
        go = (t[x] == t[y]) & ~stop[x]
        live = live[go]
        offset += 1
        lcp[live] = offset
    anchor = np.maximum.accumulate(np.where(known, -1, place))
    return np.where(known, np.maximum(lcp[anchor] - (place - anchor), 0), lcp)
