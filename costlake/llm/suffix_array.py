"""Suffix arrays in numpy: Larsson-Sadakane refinement, Kasai common prefixes and
binary search in sorted windows. Inputs are one shard's bytes."""

from __future__ import annotations

import numpy as np

LANES_STEP = 64
_BYTE_ENDS = np.uint64(1) << np.arange(0, 64, 8, dtype=np.uint64)


def _first_eight(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one big-endian number; a byte past
    the end counts as zero, and ``suffix_array`` breaks that tie by length."""
    x = data.astype(np.uint64)
    for h in (1, 2, 4):
        nxt = np.zeros_like(x)
        nxt[:-h] = x[h:]
        x = (x << np.uint64(8 * h)) | nxt
    return x


def suffix_array(data: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Start positions in the order of their suffixes (of their first ``depth``
    bytes at least)."""
    return ranked_suffixes(data, depth)[0]


def ranked_suffixes(data: np.ndarray, depth: int | None = None,
                    need: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, rank of each position; equal up to ``depth``, equal rank).
    With ``need`` (bytes per position) a position takes part only while a round can tell
    it apart within its own: the order holds for those that need ``depth``. Groups of equal prefixes are refined by the rank of what follows, doubling
    the prefix each round; singleton groups are never sorted again (Larsson and
    Sadakane)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = _first_eight(data)
    sa = np.argsort(key)
    k = key[sa]
    new = np.r_[True, k[1:] != k[:-1]]
    # Near the end a suffix may be a prefix of another: the shorter is first.
    for end in np.unique(key[max(0, n - 8):]):
        lo, hi = np.searchsorted(k, end, "left"), np.searchsorted(k, end, "right")
        left = np.minimum(n - sa[lo:hi], 8)
        order = np.argsort(left)
        sa[lo:hi] = sa[lo:hi][order]
        new[lo + 1:hi] = left[order][1:] != left[order][:-1]
    first = np.flatnonzero(new)
    rank = np.empty(n + 1, np.int64)
    rank[sa] = np.repeat(first, np.diff(np.r_[first, n]))
    rank[n] = -1
    size = np.diff(np.r_[first, n])
    at = np.flatnonzero(np.repeat(size > 1, size))
    h = 8
    while len(at) and (depth is None or h < depth):
        if need is not None:
            at = at[need[sa[at]] > h]
            if not len(at):
                break
        who = sa[at]
        key = rank[who] * (n + 1) + rank[np.minimum(who + h, n)] + 1
        order = np.argsort(key)
        who, key = who[order], key[order]
        sa[at] = who
        begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.diff(np.r_[begin, len(at)])
        rank[who] = np.repeat(at[begin], size)
        at = at[np.repeat(size > 1, size)]
        h *= 2
    return sa, rank[:n]


def kasai(data: np.ndarray, sa: np.ndarray, cap: int | None = None, rank: np.ndarray | None = None) -> np.ndarray:
    """Common prefix (up to ``cap``) of each suffix with its predecessor in ``sa``,
    which may hold some of the positions only.

    Kasai's walk in text order, where a common prefix shrinks by one at most
    from one position to the next, is run on many stretches of the text at once,
    one vector step per position of a stretch. The bound needs both this position and
    the one behind the last predecessor in ``sa``; else the comparison starts
    anew. For a suffix array of bounded depth (``cap`` at most that), ``rank`` tells ties:
    equal ranks share ``cap`` bytes without a comparison, and the bound from the
    position before holds only if what follows its predecessor ranks truly lower."""
    n, m = len(data), len(sa)
    if m < 2:
        return np.zeros(m, np.int64)
    cap = n if cap is None else cap
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    held = np.zeros(n, bool)
    held[sa] = True
    at = np.flatnonzero(held)
    plcp, eight = np.zeros(n, np.int64), _first_eight(data)
    starts = np.arange(0, m, LANES_STEP)
    h, was = np.zeros(len(starts), np.int64), np.full(len(starts), n, np.int64)
    last = np.full(len(starts), -2, np.int64)
    for step in range(LANES_STEP):
        k = starts + step
        live = k < m
        if not live.all():
            k, h, was, last, starts = k[live], h[live], was[live], last[live], starts[live]
        i = at[k]
        j = before[i]
        h = np.maximum(h - 1, 0)
        after = np.minimum(was + 1, n - 1)
        lost = (was + 1 >= n) | (last + 1 != i) | ~held[after]
        if rank is not None:
            lost |= rank[after] >= rank[i]
        h[lost] = 0
        if rank is not None:
            h[(j >= 0) & (rank[j] == rank[i])] = cap
        h[j < 0] = 0
        room = np.minimum(cap, n - np.maximum(i, j))
        todo = np.flatnonzero((j >= 0) & (h < room))
        while len(todo):                       # eight bytes a step
            l, most = h[todo], room[todo]
            x = eight[i[todo] + l] ^ eight[j[todo] + l]
            l = np.minimum(l + 8 - np.searchsorted(_BYTE_ENDS, x, "right"), most)
            h[todo] = l
            todo = todo[(x == 0) & (l < most)]
        plcp[i] = h
        was, last = np.where(j < 0, n, j), i
    return plcp[sa]


def find_rows(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Index in the sorted distinct byte rows ``table`` of each of the byte rows
    ``rows`` (equal widths), -1 where there is none, by binary search."""
    if not len(table) or not len(rows):
        return np.full(len(rows), -1, np.int64)
    kind = f"S{table.shape[1]}"         # rows of one width compare byte by byte
    t, r = (np.ascontiguousarray(x).view(kind).reshape(-1) for x in (table, rows))
    at = np.minimum(np.searchsorted(t, r), len(t) - 1)
    return np.where(t[at] == r, at, -1)
