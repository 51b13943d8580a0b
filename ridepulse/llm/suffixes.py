"""Suffix arrays by induced sorting, and common prefixes, on whole numpy arrays.

Suffixes are classified as smaller or larger than their successors, the
leftmost-smaller (LMS) substrings are sorted by induction and named, the
string of names is sorted recursively, and the array is induced from it. The
induction scans bucket by bucket instead of entry by entry: all entries of a
bucket that are known are expanded at once, in waves where a symbol repeats.
A string of names with a large alphabet is ranked by prefix doubling, since
its buckets would hold a few entries each.
"""

from __future__ import annotations

import numpy as np

from ridepulse.llm.words import Ranges

# Alphabets up to this size are sorted by induction.
_BUCKETS = 1024


def _doubled(s: np.ndarray) -> np.ndarray:
    """Suffix array of ``s`` by prefix doubling; a suffix's end is smaller than any symbol."""
    n = len(s)
    rank = np.unique(s, return_inverse=True)[1].astype(np.int64) + 1
    step = 1
    while True:
        key = rank * (n + 2)
        key[:-step or n] += rank[step:] if step < n else 0
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        if new.all() or step >= n:
            return order
        step *= 2


def _within(group: np.ndarray) -> np.ndarray:
    """Place of each entry in its run of equal values (``group`` is sorted)."""
    return np.arange(len(group)) - np.searchsorted(group, group)


def _induced(s: np.ndarray, small: np.ndarray, lms: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The array induced from LMS suffixes in the order ``lms``."""
    n, tail = len(s), np.cumsum(size)
    head = tail - size
    out = np.full(n, -1, np.int64)
    by = lms[np.argsort(s[lms], kind="stable")]
    n_lms = np.bincount(s[by], minlength=len(size))
    lms_from = tail - n_lms
    out[lms_from[s[by]] + _within(s[by])] = by

    # larger suffixes, buckets and entries ascending
    fill = head.copy()

    def add_larger(entries: np.ndarray) -> None:
        at = entries[entries > 0] - 1
        at = at[~small[at]]
        if len(at):
            c = s[at]
            o = np.argsort(c, kind="stable")
            at, c = at[o], c[o]
            out[fill[c] + _within(c)] = at
            np.add.at(fill, c, 1)

    used = np.flatnonzero(size)
    for c in used:
        done = head[c]
        while done < fill[c]:
            upto = fill[c]
            add_larger(out[done:upto])
            done = upto
        add_larger(out[lms_from[c] : tail[c]])

    # smaller suffixes, buckets and entries descending
    larger_to, fill = fill, tail.copy()

    def add_smaller(entries: np.ndarray) -> None:
        at = entries[entries > 0] - 1
        at = at[small[at]]
        if len(at):
            c = s[at]
            o = np.argsort(c, kind="stable")
            at, c = at[o], c[o]
            out[fill[c] - 1 - _within(c)] = at
            np.subtract.at(fill, c, 1)

    for c in used[::-1]:
        done = tail[c]
        while done > fill[c]:
            downto = fill[c]
            add_smaller(out[downto:done][::-1])
            done = downto
        add_smaller(out[head[c] : larger_to[c]][::-1])
    out[0] = n - 1  # the end mark
    return out


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``s`` (non-negative integers) in order; a suffix's end is smaller than any symbol."""
    if not len(s):
        return np.empty(0, np.int64)
    if int(s.max()) >= _BUCKETS:
        return _doubled(s)
    s = np.concatenate([s.astype(np.int64) + 1, [0]])
    n = len(s)
    step = np.sign(np.diff(s))
    changes = np.where(step != 0, np.arange(n - 1), n)
    changes = np.minimum.accumulate(changes[::-1])[::-1]  # the next place where symbols differ
    small = np.concatenate([step[changes] > 0, [True]])
    is_lms = np.concatenate([[False], small[1:] & ~small[:-1]])
    lms = np.flatnonzero(is_lms)
    size = np.bincount(s)
    order = _induced(s, small, lms, size)
    in_order = order[is_lms[order]]
    # equal LMS substrings (both ends included) share a name
    after = np.concatenate([lms[1:] + 1, [n]])
    text = Ranges(s.astype(np.uint64) * np.uint64(2))
    place = np.searchsorted(lms, in_order)
    hashes, lengths = text.hash(lms, after)[place], (after - lms)[place]
    new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (lengths[1:] != lengths[:-1])])
    if not new.all():
        names = np.empty(len(lms), np.int64)
        names[place] = np.cumsum(new) - 1
        in_order = lms[suffix_array(names)]
    return _induced(s, small, in_order, size)[1:]


def common_prefixes(s: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Permuted common prefixes: for each position the length shared with the suffix before it in ``order``.

    Where the symbols before both suffixes are equal, the value is the one at
    the position before less one; only the other positions are compared, by
    bisection over range hashes.
    """
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    at = np.arange(n)
    reducible = (at > 0) & (before > 0)
    reducible[reducible] = s[at[reducible] - 1] == s[before[reducible] - 1]
    # the suffix before this one's must be the shifted neighbour, which holds unless that ends
    start = np.flatnonzero(~reducible)
    other = before[start]
    text = Ranges(s.astype(np.uint64) * np.uint64(2))
    low, high = np.zeros(len(start), np.int64), np.where(other >= 0, n - np.maximum(start, other), 0)
    while (low < high).any():
        mid = (low + high + 1) // 2
        o = np.maximum(other, 0)
        same = text.hash(start, start + mid) == text.hash(o, o + mid)
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    out = np.zeros(n, np.int64)
    out[start] = low
    last = np.maximum.accumulate(np.where(~reducible, at, 0))
    return np.where(reducible, out[last] - (at - last), out)
