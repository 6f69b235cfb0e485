"""Suffix arrays by induced sorting, and permuted common prefixes, on numpy arrays.

Suffixes are classed as smaller (S) or larger (L) than their right neighbour. Leftmost S suffixes are
sorted by their substrings, the substrings are named and the string of names is sorted recursively;
from these the L suffixes are induced from left to right and the S suffixes from right to left. Narrow
alphabets are induced bucket by bucket with array operations, wide ones (the strings of names) one
suffix at a time.
"""

from __future__ import annotations

import numpy as np


def classes(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last one (the sentinel) is."""
    n = len(text)
    change = np.append(text[1:] != text[:-1], True)
    at = np.where(change, np.arange(n), n)
    nearest = np.minimum.accumulate(at[::-1])[::-1]
    out = np.ones(n, bool)
    inner = nearest < n - 1
    out[inner] = text[nearest[inner]] < text[nearest[inner] + 1]
    return out


def suffix_array(text: np.ndarray, width: int) -> np.ndarray:
    """Suffix array of ``text``: symbols below ``width``, the last one 0 and found nowhere else."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64)
    smaller = classes(text)
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    counts = np.bincount(text, minlength=width)
    induce = by_bucket if width * 40 < n else one_by_one
    order = induce(text, smaller, leftmost[np.argsort(text[leftmost], kind="stable")], counts)
    is_leftmost = np.zeros(n, bool)
    is_leftmost[leftmost] = True
    order = order[is_leftmost[order]]
    names = named(text, leftmost, order)
    if names.max() + 1 < len(leftmost):
        order = leftmost[suffix_array(names, int(names.max()) + 1)]
    return induce(text, smaller, order, counts)


def named(text: np.ndarray, leftmost: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Names of the substrings between leftmost S suffixes, in text order; equal substrings share one."""
    size = np.diff(np.append(leftmost, len(text) - 1)) + 1
    length = np.zeros(len(text), np.int64)
    length[leftmost] = size
    a, b = order[:-1], order[1:]
    same = length[a] == length[b]
    active, k = np.flatnonzero(same), 0
    while len(active):
        equal = text[a[active] + k] == text[b[active] + k]
        same[active[~equal]] = False
        k += 1
        active = active[equal & (length[a[active]] > k)]
    name = np.zeros(len(text), np.int64)
    name[order] = np.concatenate([[0], np.cumsum(~same)])
    return name[leftmost]


def by_bucket(text: np.ndarray, smaller: np.ndarray, order: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Induce all suffixes from the leftmost S suffixes in ``order``."""
    n, width = len(text), len(counts)
    ends = np.cumsum(counts)
    begins = ends - counts
    out = np.empty(n, np.int64)
    per = np.bincount(text[order], minlength=width)
    stop = np.cumsum(per)
    left = begins.copy()

    def push(found: np.ndarray, head: np.ndarray, step: int) -> None:
        """Append suffixes to their buckets in the order they come."""
        symbol = text[found]
        if len(found) > 1:
            by = np.argsort(symbol, kind="stable")
            found, symbol = found[by], symbol[by]
        first = np.flatnonzero(np.append(True, symbol[1:] != symbol[:-1]))
        size = np.diff(np.append(first, len(found)))
        rank = np.arange(len(found)) - np.repeat(first, size)
        out[head[symbol] + step * rank] = found
        head[symbol[first]] += step * size

    for c in np.flatnonzero(counts):
        done = begins[c]
        while done < left[c]:
            part = out[done : left[c]] - 1
            done = left[c]
            part = part[part >= 0]
            part = part[~smaller[part]]
            if len(part):
                push(part, left, 1)
        part = order[stop[c] - per[c] : stop[c]] - 1
        part = part[part >= 0]
        if len(part):
            push(part, left, 1)
    right = ends - 1
    for c in np.flatnonzero(counts)[::-1]:
        done = ends[c] - 1
        while done > right[c]:
            part = out[right[c] + 1 : done + 1][::-1] - 1
            done = right[c]
            part = part[part >= 0]
            part = part[smaller[part]]
            if len(part):
                push(part, right, -1)
        part = out[begins[c] : left[c]][::-1] - 1
        part = part[part >= 0]
        part = part[smaller[part]]
        if len(part):
            push(part, right, -1)
    out[0] = n - 1
    return out


def one_by_one(text: np.ndarray, smaller: np.ndarray, order: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """As ``by_bucket``, for alphabets with few suffixes a bucket."""
    n = len(text)
    symbols, small = text.tolist(), smaller.tolist()
    ends = np.cumsum(counts)
    out = [-1] * n
    tail = (ends - 1).tolist()
    for p in order[::-1].tolist():
        c = symbols[p]
        out[tail[c]] = p
        tail[c] -= 1
    head = (ends - counts).tolist()
    for i in range(n):
        p = out[i] - 1
        if p >= 0 and not small[p]:
            c = symbols[p]
            out[head[c]] = p
            head[c] += 1
    tail = (ends - 1).tolist()
    for i in range(n - 1, -1, -1):
        p = out[i] - 1
        if p >= 0 and small[p]:
            c = symbols[p]
            out[tail[c]] = p
            tail[c] -= 1
    out[0] = n - 1
    return np.array(out, np.int64)


def permuted_prefixes(text: np.ndarray, array: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """For each position the length it shares with the suffix before it in order.

    Nothing is compared past ``limit`` symbols from a position. Only positions whose left neighbours
    differ are compared; the others share one symbol less than the position before them.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[array[1:]] = array[:-1]
    whole = before >= 0
    position = np.arange(n)
    start = (position == 0) | (before <= 0)
    start[1:] |= (text[:-1] != text[before[1:] - 1])
    # after a limit the next position starts anew
    room = np.where(whole, np.minimum(limit, limit[before]), 0)
    start[1:] |= room[1:] < room[:-1] - 1
    start[1:] |= room[1:] >= room[:-1]
    shared = np.zeros(n, np.int64)
    active = np.flatnonzero(start & (room > 0))
    k = 0
    while len(active):
        active = active[text[active + k] == text[before[active] + k]]
        k += 1
        shared[active] = k
        active = active[room[active] > k]
    last = np.maximum.accumulate(np.where(start, position, 0))
    return np.where(whole, np.maximum(shared[last] - (position - last), 0), 0)
