"""Suffix array of one shard by induced sorting, and its permuted common prefixes.

Induced sorting classifies the suffixes (larger or smaller than their right neighbour), sorts the
leftmost-smaller substrings - by a first induction and, where they repeat, recursively on their
names - and induces the order of all suffixes from them in two linear scans. A scan reads a front of
entries at a time: as far as no entry it places falls into the front itself, all of them are placed
in one step.
"""

from __future__ import annotations

import numpy as np


def _smaller(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than their right neighbours; the last one counts as smaller."""
    n = len(text)
    out = np.ones(n, bool)
    turns = np.flatnonzero(text[:-1] != text[1:])
    if len(turns):
        next_turn = turns[np.minimum(np.searchsorted(turns, np.arange(n - 1)), len(turns) - 1)]
        out[:-1] = text[next_turn] < text[next_turn + 1]
    return out


def _ranks(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each entry in its run of equal keys, and which entries end a run."""
    n = len(sorted_keys)
    last = np.ones(n, bool)
    np.not_equal(sorted_keys[1:], sorted_keys[:-1], out=last[:-1])
    starts = np.zeros(n, np.int64)
    turns = last[:-1].nonzero()[0] + 1
    starts[turns] = turns
    np.maximum.accumulate(starts, out=starts)
    return np.arange(n) - starts, last


def _induce_larger(text: np.ndarray, order: np.ndarray, smaller: np.ndarray, heads: np.ndarray) -> None:
    """Place the larger suffixes from left to right; empty entries of ``order`` are -1."""
    n, at, size = len(text), 0, 1024
    while at < n:
        end = min(n, at + size)
        before = order[at:end] - 1
        where = (before >= 0).nonzero()[0]
        where = where[~smaller[before[where]]]
        if not len(where):
            at, size = end, min(2 * size, 1 << 16)
            continue
        placed = before[where]
        keys = text[placed]
        by_key = np.argsort(keys, kind="stable")
        keys = keys[by_key]
        rank, last = _ranks(keys)
        target = heads[keys] + rank
        first = int(target.min())
        if first < end:
            kept = where[by_key] + at < first
            by_key, keys, target = by_key[kept], keys[kept], target[kept]
            last = np.append(keys[1:] != keys[:-1], True)
            end = first
            size = max(256, 2 * (end - at))
        else:
            size = min(2 * size, 1 << 16)
        order[target] = placed[by_key]
        heads[keys[last]] = target[last] + 1
        at = end


def _induce_smaller(text: np.ndarray, order: np.ndarray, smaller: np.ndarray, tails: np.ndarray) -> None:
    """Place the smaller suffixes from right to left."""
    at, size = len(text), 1024
    while at > 0:
        end = max(0, at - size)
        before = order[end:at][::-1] - 1
        where = (before >= 0).nonzero()[0]
        where = where[smaller[before[where]]]
        if not len(where):
            at, size = end, min(2 * size, 1 << 16)
            continue
        placed = before[where]
        keys = text[placed]
        by_key = np.argsort(keys, kind="stable")
        keys = keys[by_key]
        rank, last = _ranks(keys)
        target = tails[keys] - 1 - rank
        first = int(target.max())
        if first >= end:
            kept = at - 1 - where[by_key] > first
            by_key, keys, target = by_key[kept], keys[kept], target[kept]
            last = np.append(keys[1:] != keys[:-1], True)
            end = first + 1
            size = max(256, 2 * (at - end))
        else:
            size = min(2 * size, 1 << 16)
        order[target] = placed[by_key]
        tails[keys[last]] = target[last]
        at = end


def _induced(text: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The order of all suffixes that follows from the given order of the leftmost-smaller ones."""
    n = len(text)
    order = np.full(n, -1)
    by_key = np.argsort(text[leftmost], kind="stable")
    keys = text[leftmost][by_key]
    rank, last = _ranks(keys)
    sizes = np.zeros(len(ends), np.int64)
    sizes[keys[last]] = rank[last] + 1
    order[ends[keys] - sizes[keys] + rank] = leftmost[by_key]
    _induce_larger(text, order, smaller, np.concatenate([[0], ends[:-1]]))
    order[(order >= 0) & smaller[order]] = -1
    order[0] = n - 1
    _induce_smaller(text, order, smaller, ends.copy())
    return order


def _names(text: np.ndarray, order: np.ndarray, leftmost: np.ndarray) -> np.ndarray:
    """Names of the leftmost-smaller substrings, in text order: equal ones share one, order holds."""
    marked = np.zeros(len(text), bool)
    marked[leftmost] = True
    in_order = order[marked[order]]
    length = np.zeros(len(text), np.int64)
    length[leftmost] = np.append(np.diff(leftmost), 0)
    left, right = in_order[:-1], in_order[1:]
    differs = length[left] != length[right]
    rest = np.flatnonzero(~differs)
    step = 0
    while len(rest):
        rest = rest[length[left[rest]] >= step]
        unlike = text[left[rest] + step] != text[right[rest] + step]
        differs[rest[unlike]] = True
        rest = rest[~unlike]
        step += 1
    names = np.zeros(len(text), np.int64)
    names[in_order] = np.concatenate([[0], np.cumsum(differs)])
    return names[leftmost]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order. The last value of ``text`` must be its only smallest one."""
    n = len(text)
    if n < 3:
        return np.arange(n)[::-1].copy()
    smaller = _smaller(text)
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    ends = np.cumsum(np.bincount(text))
    order = _induced(text, smaller, leftmost, ends)
    names = _names(text, order, leftmost)
    repeated = len(names) > 0 and names.max() + 1 < len(names)
    in_order = suffix_array(names) if repeated else np.argsort(names)
    return _induced(text, smaller, leftmost[in_order], ends)


def common_prefixes(text: np.ndarray, order: np.ndarray, cap: int, stretch: int = 64) -> np.ndarray:
    """By text position, the prefix a suffix shares with the one before it in order, up to ``cap``.

    Zero ends a string and is never part of a prefix. Read in text order a value is at least the one
    before less one, so only its end has to be compared; stretches of the text are read side by side.
    """
    n = len(text)
    before = np.full(n, n - 1)
    before[order[1:]] = order[:-1]
    out = np.zeros(n, np.int64)
    padded = np.concatenate([text, np.zeros(cap + 1, text.dtype)])
    starts = np.arange(0, n, stretch)
    held = np.zeros(len(starts), np.int64)
    for offset in range(min(stretch, n)):
        at = starts + offset
        if at[-1] >= n:
            at, held = at[:-1], held[:-1]
        other = before[at]
        held = np.maximum(held - 1, 0)
        grows = np.flatnonzero(held < cap)
        while len(grows):
            mine = padded[at[grows] + held[grows]]
            grows = grows[(mine != 0) & (mine == padded[other[grows] + held[grows]])]
            held[grows] += 1
            grows = grows[held[grows] < cap]
        out[at] = held
        if len(held) < len(starts):
            starts = starts[: len(held)]
    return out
