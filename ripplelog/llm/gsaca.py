"""A suffix array in linear time by grouping: no recursion, no renaming.

First all suffixes are grouped by their longest prefix that is a Lyndon word. Groups are taken in descending order; each
suffix of a group looks for the nearest position before it that is in a lower group, whose prefix grows by this group's.
Then the array is filled from the left: whatever ends where a placed suffix begins comes next in its own group.
"""

from __future__ import annotations

from array import array

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Positions of all suffixes in order; the end counts as smaller than any symbol. Symbols are small numbers."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")  # by counting, for 16-bit symbols
    arranged = symbols[order]
    heads = np.flatnonzero(np.diff(arranged, prepend=arranged[:1] - 1)) if n else np.zeros(0, np.int64)
    head_of = np.empty(n, np.int64)
    head_of[order] = np.repeat(heads, np.diff(np.append(heads, n)))
    # compact arrays: four bytes a place each, an eighth of what lists of numbers take
    compact = lambda x: array("i", x.astype(np.int32).tobytes())
    inverse = np.empty(n, np.int64)
    inverse[order] = np.arange(n)
    sa, group, place = compact(order), compact(head_of), compact(inverse)  # suffixes by group; where each one's group begins; its place
    past = array("i", bytes(4 * n))  # where the group that begins at a place is over
    for a, b in zip(heads.tolist(), np.append(heads, n)[1:].tolist(), strict=True):
        past[a] = b
    length, before = array("i", [1]) * n, array("i", [-1]) * n
    end = n
    while end:
        start = group[sa[end - 1]]
        if end - start == 1:  # most groups, in the end: one suffix, which lengthens one other
            s = sa[start]
            p = s - 1
            while p >= 0 and group[p] > start:
                p = before[p]
            before[s] = p
            if p >= 0:
                g = group[p]
                last = past[g] - 1
                past[g] = last
                i, other = place[p], sa[last]
                sa[i], place[other] = other, i
                sa[last], place[p], group[p] = p, last, last
                past[last] = last + 1
                length[p] += length[s]
            end = start
            continue
        members = sa[start:end]
        size = length[members[0]]
        # the nearest position before each one that is in a lower group, or in this one at first
        grows: dict[int, int] = {}
        inside = []
        for s in members:
            p = s - 1
            while p >= 0 and group[p] > start:
                p = before[p]
            before[s] = p
            if p >= 0:
                if group[p] == start:
                    inside.append(s)
                else:
                    grows[p] = grows.get(p, 0) + 1
        # a pointer inside the group is followed once and then points out of it
        for s in inside:
            p, way = before[s], [s]
            while p >= 0 and group[p] == start:
                way.append(p)
                p = before[p]
            for q in way:
                before[q] = p
            if p >= 0:
                grows[p] = grows.get(p, 0) + 1
        # those that meet this group most often are the highest of their own group
        by_times: dict[int, list[int]] = {}
        for p, k in grows.items():
            by_times.setdefault(k, []).append(p)
        for k in range(max(by_times, default=0), 0, -1) if len(by_times) > 1 else by_times:
            chosen = by_times.get(k, ())
            touched = []
            for p in chosen:
                g = group[p]
                last = past[g] - 1
                past[g] = last
                i, other = place[p], sa[last]
                sa[i], place[other] = other, i
                sa[last], place[p] = p, last
                length[p] += k * size
                touched.append((g, p))
            # what has left a group together begins a group of its own behind it
            ends: dict[int, int] = {}
            for g, p in touched:
                ends[g] = ends.get(g, 0) + 1
            for g, p in touched:
                group[p] = past[g]
            for g, m in ends.items():
                if past[g] < n:
                    past[past[g]] = past[g] + m
        end = start
    return _emit(n, group, length, before)


def _emit(n: int, group: array, length: array, before: array) -> np.ndarray:
    out, free = array("i", [-1]) * n, array("i", range(n))  # free: the next place in the group that begins there
    s, i = n, 0
    while True:
        j = s - 1
        while j >= 0 and j + length[j] == s:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            j = before[j]
        if i == n:
            return np.array(out, np.int64)
        s = out[i]
        i += 1
