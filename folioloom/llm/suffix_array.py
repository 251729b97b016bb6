"""Suffix arrays by induced sorting, with whole buckets as array operations.

Suffixes are classified as smaller (S) or larger (L) than their right neighbour.  Leftmost
S-type substrings are sorted, named, and sorted recursively where names repeat; two linear
passes then induce all other suffixes.  Over small alphabets a pass takes a bucket's newly
placed suffixes at once, since what they induce keeps their order, and a first round of it
sorts the substrings; over the names of a recursion it goes suffix by suffix, and substrings
are sorted two symbols a step, only those that are still alike.
"""

from __future__ import annotations

import numpy as np

SMALL_ALPHABET = 1024


def s_types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; ``t`` ends with its unique least symbol."""
    n = len(t)
    up = np.empty(n, np.int8)
    up[-1] = 1
    up[:-1] = np.sign(t[1:].astype(np.int64) - t[:-1])
    known = np.where(up != 0, np.arange(n), n)
    known = np.minimum.accumulate(known[::-1])[::-1]  # an equal neighbour decides by the next unequal one
    return up[known] > 0


def suffix_array(t: np.ndarray, k: int) -> np.ndarray:
    """Suffix array of ``t`` over symbols below ``k``; its last symbol is 0 and occurs once."""
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int64)
    s = s_types(t)
    lms = np.flatnonzero(s[1:] & ~s[:-1]) + 1
    sizes = np.bincount(t, minlength=k)
    if k <= SMALL_ALPHABET:
        induce = _induce_buckets
        sa = induce(t, s, lms, sizes)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        ordered = sa[is_lms[sa]]
        del sa, is_lms
        names = _names(t, ordered, lms)
    else:
        induce = _induce_each
        ordered, names = _sorted_substrings(t, s, lms)
    m = int(names[-1]) + 1
    if m < len(lms):
        place = np.empty(n, np.int32)
        place[ordered] = names
        reduced = place[lms]
        del place, names, ordered
        ordered = lms[suffix_array(reduced, m)]
    return induce(t, s, ordered, sizes)


def _sorted_substrings(t: np.ndarray, s: np.ndarray, lms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """LMS substrings in order and their ranks; symbols count with their types, so none begins another."""
    m = len(lms)
    typed = np.concatenate([2 * t.astype(np.int64) + s, np.zeros(2, np.int64)])
    size = np.append(lms[1:], len(t) - 1) - lms + 1

    def pair(which: np.ndarray, d: int) -> np.ndarray:
        at = lms[which] + d
        return (typed[at] << 32) | np.where(size[which] > d + 1, typed[at + 1], 0)

    key = pair(np.arange(m), 0)
    order = np.argsort(key, kind="stable")
    fresh = np.append(True, np.diff(key[order]) != 0)  # where a new rank begins
    d = 2
    alike = np.flatnonzero(~(fresh & np.append(fresh[1:], True)))
    while len(alike := alike[size[order[alike]] > d]):
        which, rank = order[alike], np.cumsum(fresh)[alike]
        key = pair(which, d)
        by = np.lexsort((key, rank))
        order[alike], key = which[by], key[by]
        fresh[alike[1:]] |= (np.diff(rank) != 0) | (np.diff(key) != 0)
        fresh[alike[0]] = True
        alike = alike[~(fresh[alike] & np.append(fresh, True)[alike + 1])]
        d += 2
    return lms[order], np.cumsum(fresh) - 1


def _names(t: np.ndarray, ordered: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Rank of each LMS substring in sorted order; equal substrings share a rank."""
    n = len(t)
    end = np.empty(n, np.int64)
    end[lms] = np.append(lms[1:], n - 1)
    a, b = ordered[:-1], ordered[1:]
    size = end[a] - a + 1
    same = size == end[b] - b + 1
    open_ = np.flatnonzero(same)
    d = 0
    while len(open_):
        x, y = a[open_], b[open_]
        differs = t[x + d] != t[y + d]
        same[open_[differs]] = False
        open_ = open_[~differs & (d + 1 < size[open_])]
        d += 1
    return np.concatenate([[0], np.cumsum(~same)])


def _induce_buckets(t, s, ordered, sizes) -> np.ndarray:
    n, k = len(t), len(sizes)
    sa = np.full(n, -1, np.int32)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    small = np.uint8 if k <= 256 else np.uint16
    tc = t.astype(small)
    # LMS suffixes at the tails of their buckets, in the given order
    c = tc[ordered]
    by = np.argsort(c, kind="stable")
    count = np.bincount(c, minlength=k)
    tail = ends - count
    at = np.arange(len(ordered)) + np.repeat(tail - (np.cumsum(count) - count), count)
    sa[at] = ordered[by]
    head = starts.copy()

    def put_left(j):
        p = j[j > 0] - 1
        p = p[~s[p]]
        if len(p):
            c = tc[p]
            by = np.argsort(c, kind="stable")
            count = np.bincount(c, minlength=k)
            sa[np.arange(len(p)) + np.repeat(head - (np.cumsum(count) - count), count)] = p[by]
            np.add(head, count, out=head)

    for c in np.flatnonzero(sizes):
        done = starts[c]
        while done < head[c]:
            upto = head[c]
            put_left(sa[done:upto])
            done = upto
        put_left(sa[tail[c] : ends[c]])
    filled = head.copy()  # end of each bucket's L part
    tail = ends.copy()

    def put_right(j):
        p = j[j > 0] - 1
        p = p[s[p]]
        if len(p):
            c = tc[p]
            by = np.argsort(c, kind="stable")
            count = np.bincount(c, minlength=k)
            sa[np.repeat(tail - 1 + (np.cumsum(count) - count), count) - np.arange(len(p))] = p[by]
            np.subtract(tail, count, out=tail)

    tail[0] -= 1  # the last symbol alone
    sa[0] = n - 1
    put_right(np.array([n - 1]))
    for c in np.flatnonzero(sizes)[:0:-1]:
        done = ends[c]
        while done > tail[c]:
            upto = tail[c]
            put_right(sa[upto:done][::-1])
            done = upto
        put_right(sa[starts[c] : filled[c]][::-1])
    return sa


def _induce_each(t, s, ordered, sizes) -> np.ndarray:
    n = len(t)
    ends = np.cumsum(sizes)
    tails, heads = ends.tolist(), (ends - sizes).tolist()
    # the symbol to the left of each place, where its suffix is of the type; -1 else, and for places not known yet
    left = np.full((2, n + 1), -1, np.int32)
    left[s[:-1].astype(np.int8), np.arange(1, n)] = t[:-1]
    larger, smaller = left[0].tolist(), left[1].tolist()
    del left
    sa = [-1] * n
    for j, c in zip(ordered[::-1].tolist(), t[ordered[::-1]].tolist(), strict=True):
        tails[c] -= 1
        sa[tails[c]] = j
    for j in sa:  # sees what it has placed further on
        c = larger[j]
        if c >= 0:
            at = heads[c]
            sa[at] = j - 1
            heads[c] = at + 1
    tails = ends.tolist()
    for j in reversed(sa):
        c = smaller[j]
        if c >= 0:
            at = tails[c] = tails[c] - 1
            sa[at] = j - 1
    del larger, smaller
    sa[0] = n - 1
    return np.array(sa, np.int32)


def permuted_lcp(t: np.ndarray, sa: np.ndarray, cap: int, fresh: np.ndarray) -> np.ndarray:
    """For each place, the common prefix with the suffix just before it in ``sa``, up to ``cap``.

    A place whose left symbol equals that of its neighbour has one less than the place to its
    left; only the other places, and those in ``fresh``, are compared symbol by symbol.
    ``fresh`` must hold a place every ``cap`` symbols at least where a value matters.
    """
    n = len(t)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    i = np.arange(1, n)
    direct = np.ones(n, bool)
    direct[1:] = (before[1:] <= 0) | (t[i - 1] != t[np.maximum(before[1:] - 1, 0)])
    direct[fresh] = True
    lcp = np.zeros(n, np.int64)
    pad = np.concatenate([t, np.zeros(cap + 1, t.dtype)])
    left = np.flatnonzero(direct & (before >= 0))
    x, y, d = left, before[left], 0
    while len(x) and d < cap:
        go = (pad[x + d] == pad[y + d]) & (x + d < n) & (y + d < n)
        lcp[x[~go]] = d
        x, y = x[go], y[go]
        d += 1
    lcp[x] = cap
    base = np.maximum.accumulate(np.where(direct, np.arange(n), 0))
    return np.maximum(lcp[base] - (np.arange(n) - base), 0)
