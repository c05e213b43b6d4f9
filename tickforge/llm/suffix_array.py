"""Suffix arrays by induced sorting, and common prefixes in text order, on numpy arrays."""

from __future__ import annotations

import numpy as np


def _types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (S type); the last one is."""
    step = np.sign(np.diff(t.astype(np.int64)))
    # Equal neighbours take the type of the next place where the text changes.
    at = np.where(step != 0, np.arange(len(step)), len(step))
    at = np.minimum.accumulate(at[::-1])[::-1]
    return np.append(np.append(step, 1)[at] > 0, True)


def _ranks(chars: np.ndarray) -> np.ndarray:
    """For each entry, how many equal entries stand before it; ``chars`` is sorted."""
    start = np.concatenate([[True], chars[1:] != chars[:-1]])
    first = np.flatnonzero(start)
    return np.arange(len(chars)) - np.repeat(first, np.diff(np.append(first, len(chars))))


def _induce_by_bucket(t, small, lms, width):
    """Suffixes in order, induced from LMS suffixes in order; whole buckets at a time."""
    n = len(t)
    size = np.bincount(t, minlength=width)
    end = np.cumsum(size)
    begin = end - size
    sa = np.full(n, -1, dtype=np.int64)
    # LMS suffixes at the end of their buckets, in the given order.
    order = np.argsort(t[lms], kind="stable")
    chars = t[lms][order]
    number = np.bincount(chars, minlength=width)
    sa[end[chars] - number[chars] + _ranks(chars)] = lms[order]
    head = begin.copy()

    def put_large(suffixes):
        j = suffixes[suffixes > 0] - 1
        j = j[~small[j]]
        if len(j):
            order = np.argsort(t[j], kind="stable")
            j = j[order]
            c = t[j]
            sa[head[c] + _ranks(c)] = j
            np.add(head, np.bincount(c, minlength=width), out=head)

    for c in np.flatnonzero(size):
        at = begin[c]
        while at < head[c]:
            at, chunk = head[c], sa[at : head[c]].copy()
            put_large(chunk)
        if number[c]:
            put_large(sa[end[c] - number[c] : end[c]].copy())
    tail = end.copy()
    large = head  # where the large suffixes of each bucket end

    def put_small(suffixes):
        j = suffixes[suffixes > 0] - 1
        j = j[small[j]]
        if len(j):
            order = np.argsort(t[j], kind="stable")
            j = j[order]
            c = t[j]
            sa[tail[c] - 1 - _ranks(c)] = j
            np.subtract(tail, np.bincount(c, minlength=width), out=tail)

    for c in np.flatnonzero(size)[::-1]:
        at = end[c]
        if t[-1] == c and number[c]:  # the sentinel follows nothing and stays
            tail[c] = at = end[c] - 1
            put_small(np.array([n - 1]))
        while at > tail[c]:
            at, chunk = tail[c], sa[tail[c] : at][::-1].copy()
            put_small(chunk)
        if large[c] > begin[c]:
            put_small(sa[begin[c] : large[c]][::-1].copy())
    return sa


def _order_runs(t, member, stop, rank):
    """Positions of ``member`` in suffix order. From each of them a run of members leads on to a
    position of ``stop``, whose order within its symbol is known (``rank``); at equal symbols a
    large suffix is smaller than a small one, so ``t`` comes doubled with the type added. Ties of
    the first symbols are broken by the ranks of the symbols behind, twice as far each time."""
    n = len(t)
    at = np.flatnonzero(member | stop)
    key = t[at] * (n + 1) + np.where(stop[at], rank[at] + 1, 0)
    by = np.argsort(key, kind="stable")
    at, key = at[by], key[by]
    head = np.concatenate([[True], key[1:] != key[:-1]])
    place = np.zeros(n, dtype=np.int64)
    place[at] = np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))
    far = 1
    while True:
        # Suffixes that share their rank with a neighbour: only they are told apart further.
        tied = np.flatnonzero(~(head & np.append(head[1:], True)))
        if not len(tied):
            return at[member[at]]
        j = at[tied]
        key = place[j] * n + place[j + far]
        by = np.argsort(key, kind="stable")
        j, key = j[by], key[by]
        at[tied] = j
        head[tied] = np.concatenate([[True], key[1:] != key[:-1]])
        place[j] = np.maximum.accumulate(np.where(head[tied], tied, 0))
        far *= 2


def _induce_by_runs(t, small, lms, width):
    """The same for wide alphabets: large suffixes are ordered by their runs down to an LMS
    suffix, then small ones by their runs up to a large suffix; all of a type at once."""
    n = len(t)
    typed = 2 * t + small
    rank = np.zeros(n, dtype=np.int64)
    rank[lms] = np.arange(len(lms))
    is_lms = np.zeros(n, dtype=bool)
    is_lms[lms] = True
    large = _order_runs(typed, ~small, is_lms, rank)
    rank[large] = np.arange(len(large))
    ends = np.concatenate([[False], small[:-1]]) & ~small
    rest = _order_runs(typed, small, ends, rank)
    # Within a symbol the large suffixes come first.
    size = np.bincount(typed, minlength=2 * width)
    begin = np.cumsum(size) - size
    sa = np.empty(n, dtype=np.int64)
    for group in (large, rest):
        c = typed[group]
        sa[begin[c] + _ranks(c)] = group
    return sa


def _induce(t, small, lms, width):
    return (_induce_by_bucket if width <= 1024 else _induce_by_runs)(t, small, lms, width)


def suffix_array(t: np.ndarray, width: int) -> np.ndarray:
    """Start positions of the suffixes of ``t`` in order. ``t`` holds integers below ``width`` and
    ends with a 0 that occurs nowhere else."""
    n = len(t)
    if n == 1:
        return np.zeros(1, dtype=np.int64)
    t = t.astype(np.int64)
    small = _types(t)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(lms) <= 1:
        return _induce(t, small, lms, width)
    sa = _induce(t, small, lms, width)
    is_lms = np.zeros(n, dtype=bool)
    is_lms[lms] = True
    order = sa[is_lms[sa]]
    # Name the LMS substrings: equal neighbours share a name (compared symbol by symbol, all
    # pairs at once, until they differ or end).
    length = np.zeros(n, dtype=np.int64)
    length[lms[:-1]] = np.diff(lms) + 1
    length[lms[-1]] = 1
    a, b = order[:-1], order[1:]
    equal = length[a] == length[b]
    left = np.flatnonzero(equal)
    d = 0
    while len(left):
        left = left[length[a[left]] > d]
        differ = t[a[left] + d] != t[b[left] + d]
        equal[left[differ]] = False
        left = left[~differ]
        d += 1
    names = np.concatenate([[0], np.cumsum(~equal)])
    if names[-1] + 1 < len(lms):
        named = np.zeros(n, dtype=np.int64)
        named[order] = names
        order = lms[suffix_array(named[lms], int(names[-1]) + 1)]
    return _induce(t, small, order, width)


def words8(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a little-endian number (zeros past the end)."""
    n = len(raw)
    padded = np.zeros(n + 16, dtype=np.uint8)
    padded[:n] = raw
    out = np.empty(n + 8, dtype=np.uint64)
    for s in range(8):
        view = padded[s : s + (len(out) - s + 7) // 8 * 8]
        got = view[: len(view) // 8 * 8].view("<u8")
        out[s::8] = got[: len(out[s::8])]
    return out[:n]


def common_prefixes(raw: np.ndarray, before: np.ndarray, least: int) -> np.ndarray:
    """For each place, how many bytes its suffix shares with the suffix at ``before`` (its
    neighbour in the suffix array; -1: none), as far as ``least``; in text order."""
    n = len(raw)
    w = np.concatenate([words8(raw), np.zeros(least + 8, dtype=np.uint64)])
    out = np.zeros(n, dtype=np.int64)
    left = np.flatnonzero(before >= 0)
    for d in range(0, least, 8):
        x = w[left + d] ^ w[before[left] + d]
        same = x == 0
        y = x[~same]
        low = y & (~y + np.uint64(1))
        out[left[~same]] = d + (np.log2(low.astype(np.float64)).astype(np.int64) >> 3)
        left = left[same]
        out[left] = d + 8
    return np.minimum(out, least)
