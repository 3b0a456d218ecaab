"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

Induction reads an array from one end and writes suffixes farther on.  Here it reads batches: as long as nothing is written into the
batch itself, all its writes are known at once, in order; where something is, the batch ends there.
"""

from __future__ import annotations

import numpy as np

#: Positions that are read at once, at least and at most.
LEAST_BATCH, MOST_BATCH = 256, 1 << 16
#: Positions.  Narrower ones take less memory, but numpy widens them for every look-up, which costs a tenth of the time.
INT = np.int64


def _types(t: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the next one.  The last symbol is the only smallest."""
    n = len(t)
    rises = np.sign(t[1:].astype(INT) - t[:-1]).astype(np.int8)
    at = np.where(rises != 0, np.arange(n - 1, dtype=INT), INT(n))
    following = np.minimum.accumulate(at[::-1])[::-1]
    return np.append(rises[following] > 0, True)


def _groups(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbol, first, count) of each run of equals.  Equal symbols stand together."""
    last = (symbols[1:] != symbols[:-1]).nonzero()[0]
    first = np.empty(len(last) + 2, INT)
    first[0], first[-1] = 0, len(symbols)
    np.add(last, 1, out=first[1:-1])
    return symbols[first[:-1]], first[:-1], first[1:] - first[:-1]


def _induce(t: np.ndarray, smaller: np.ndarray, lms: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The suffix array that follows from the order of the leftmost-smaller suffixes."""
    n = len(t)
    sa = np.full(n, -1, INT)
    larger, steps = ~smaller, np.arange(max(MOST_BATCH, len(lms)), dtype=INT)
    by_symbol = np.argsort(t[lms], kind="stable")
    symbol, first, count = _groups(t[lms][by_symbol])
    sa[np.repeat(ends[symbol] - count - first, count) + steps[: len(lms)]] = lms[by_symbol]

    heads, i, batch = starts.copy(), 0, LEAST_BATCH
    while i < n:
        end = min(n, i + batch)
        found = sa[i:end]
        at = (found > 0).nonzero()[0]
        before = found[at] - 1
        chosen = larger[before]
        at, before = at[chosen] + i, before[chosen]
        stop = end
        if len(at):
            symbols = t[before]
            order = symbols.argsort(kind="stable")
            before, symbols = before[order], symbols[order]
            symbol, first, count = _groups(symbols)
            head = heads[symbol]
            to = (head - first).repeat(count) + steps[: len(before)]
            if head.min() < end:  # something is written into the batch
                stop = int(head.min())
                ready = at[order] < stop
                before, to = before[ready], to[ready]
                symbol, _, count = _groups(symbols[ready])
            sa[to] = before
            heads[symbol] += count
        batch = min(MOST_BATCH, max(LEAST_BATCH, 2 * (stop - i)))
        i = stop

    # What was placed first is found again from the right; the smallest suffix has no successor that finds it.
    placed = sa >= 0
    placed[placed] = smaller[sa[placed]]
    sa[placed] = -1
    sa[0] = n - 1
    tails, i, batch = ends.copy(), n - 1, LEAST_BATCH
    while i >= 0:
        end = max(-1, i - batch)
        found = sa[i:end:-1] if end >= 0 else sa[i::-1]
        at = (found > 0).nonzero()[0]
        before = found[at] - 1
        chosen = smaller[before]
        at, before = i - at[chosen], before[chosen]
        stop = end
        if len(at):
            symbols = t[before]
            order = symbols.argsort(kind="stable")
            before, symbols = before[order], symbols[order]
            symbol, first, count = _groups(symbols)
            tail = tails[symbol] - 1
            to = (tail + first).repeat(count) - steps[: len(before)]
            if tail.max() > end:
                stop = int(tail.max())
                ready = at[order] > stop
                before, to = before[ready], to[ready]
                symbol, _, count = _groups(symbols[ready])
            sa[to] = before
            tails[symbol] -= count
        batch = min(MOST_BATCH, max(LEAST_BATCH, 2 * (i - stop)))
        i = stop
    return sa


def _names(t: np.ndarray, ordered: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Numbers of the sorted leftmost-smaller substrings; equal ones share a number."""
    length = np.ones(len(t), INT)
    length[lms[:-1]] = np.diff(lms) + 1
    a, b = ordered[:-1], ordered[1:]
    same = length[a] == length[b]
    live, offset = np.flatnonzero(same), 0
    while len(live):
        x, y = a[live], b[live]
        equal = t[x + offset] == t[y + offset]
        same[live[~equal]] = False
        offset += 1
        live = live[equal]
        live = live[length[a[live]] > offset]
    return np.concatenate([[0], np.cumsum(~same)]).astype(INT)


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Suffixes of ``t`` in order.  ``t``: whole numbers from 0; the last one is smaller than all others."""
    n = len(t)
    if n < 3:
        return np.arange(n - 1, -1, -1, dtype=INT)
    smaller = _types(t)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]).astype(INT) + INT(1)
    size = np.bincount(t)
    ends = np.cumsum(size)
    starts = ends - size
    sa = _induce(t, smaller, lms, starts, ends)
    if len(lms) > 1:
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        ordered = sa[is_lms[sa]]
        names = _names(t, ordered, lms)
        if names[-1] + 1 < len(lms):
            number = np.empty(n, INT)
            number[ordered] = names
            ordered = lms[suffix_array(number[lms])]
        sa = _induce(t, smaller, ordered, starts, ends)
    return sa


def permuted_common_prefixes(t: np.ndarray, sa: np.ndarray, whole: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For each position the suffix before it in order, and the length of their common prefix.

    Only positions whose common prefix is not that of the position before, less one symbol, are compared (and those in ``whole``);
    lengths are followed up to ``most``, which no common prefix that matters is beyond.  ``t``: bytes.
    """
    n = len(t)
    previous = np.full(n, -1, INT)
    previous[sa[1:]] = sa[:-1]
    own = np.ones(n, bool)
    inner = np.flatnonzero(previous[1:] > 0) + 1
    own[inner] = t[inner - 1] != t[previous[inner] - 1]
    own[whole] = True
    del sa, inner  # what is not needed any more goes at once: a shard's arrays are most of a worker's memory
    start = np.flatnonzero(own & (previous >= 0)).astype(INT)
    padded = np.concatenate([t, np.zeros(most + 16, np.uint8)])
    words = np.ndarray((n + most,), "<u8", padded, strides=(1,))
    length = np.zeros(n, INT)
    live, offset = start, 0
    while len(live) and offset < most:
        differ = words[live + offset] ^ words[previous[live] + offset]
        done = differ != 0
        low = differ[done] & (~differ[done] + np.uint64(1))  # the lowest set bit: its byte is the first that differs
        length[live[done]] = offset + np.floor(np.log2(low.astype(np.float64))).astype(np.int64) // 8
        offset += 8
        live = live[~done]
    length[live] = most
    del start, live
    at = np.arange(n, dtype=INT)
    last = np.where(own, at, INT(0))
    np.maximum.accumulate(last, out=last)
    common = length[last]
    del length
    at -= last
    common -= at
    return previous, np.maximum(common, 0, out=common)
