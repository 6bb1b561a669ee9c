"""Suffix arrays by grouping: linear work, and no recursion on renamed texts."""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """The starts of all suffixes of ``symbols`` (positive integers) in ascending order.

    First suffixes are grouped by their longest Lyndon prefix. Groups begin as one per
    symbol and are taken from the highest down. For each member the nearest position
    before it that lies in a lower group is found along pointers of the same kind; these
    positions then begin with a longer Lyndon word than the rest of their own group, by
    as many repeats of the member's as they are pointed to, and move behind that rest.
    Then the suffixes are emitted from the smallest on: each one places the suffix before
    it, and those its pointers lead to, at the next free place of their group.
    """
    n = len(symbols) + 1
    if n == 1:
        return np.zeros(0, np.int64)
    text = np.append(np.asarray(symbols, np.int64), 0)
    order = np.argsort(text, kind="stable")
    first = np.concatenate(([True], np.diff(text[order]) != 0))
    starts = np.flatnonzero(first)
    group_at = np.repeat(starts, np.diff(np.append(starts, n)))
    group_of = np.empty(n, np.int64)
    group_of[order] = group_at
    place_of = np.empty(n, np.int64)
    place_of[order] = np.arange(n)
    sizes = np.zeros(n, np.int64)
    sizes[starts] = np.diff(np.append(starts, n))
    group, previous = _group(order.tolist(), place_of.tolist(), group_of.tolist(), sizes.tolist())
    return np.array(_emit(group, previous)[1:], np.int64)


def _group(row: list[int], place: list[int], group: list[int], size: list[int]) -> tuple[list[int], list[int]]:
    """The final group of each suffix (as its first place) and its pointer, -1 for none.

    ``row`` holds the suffixes group by group, ``place`` where each stands in it.
    """
    n = len(row)
    previous = [-1] * n
    pointed = [0] * n
    end = n - 1
    while end > 0:
        start = group[row[end]]
        members = row[start : end + 1] if start == end else sorted(row[start : end + 1])
        targets = []
        most = 1
        for i in members:
            j = i - 1
            while j >= 0 and group[j] >= start:
                j = previous[j]
            previous[i] = j
            if j >= 0:
                count = pointed[j]
                if not count:
                    targets.append(j)
                pointed[j] = count + 1
                if count >= most:
                    most = count + 1
        if most == 1:
            levels = [targets]
        else:
            levels = [[] for _ in range(most)]
            for j in targets:
                levels[most - pointed[j]].append(j)
        for level in levels:
            for j in level:
                pointed[j] = 0
                own = group[j]
                rest = size[own] - 1
                size[own] = rest
                at, to = place[j], own + rest
                if at != to:
                    other = row[to]
                    row[at], row[to] = other, j
                    place[other], place[j] = at, to
            new = [group[j] + size[group[j]] for j in level]
            for j, own in zip(level, new, strict=True):
                group[j] = own
                size[own] += 1
        end = start - 1
    return group, previous


def _emit(group: list[int], previous: list[int]) -> list[int]:
    n = len(group)
    out = [0] * n
    out[0] = n - 1
    free = list(range(n))
    open_ = [True] * n
    open_[n - 1] = False
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and open_[j]:
            own = group[j]
            out[free[own]] = j
            free[own] += 1
            open_[j] = False
            j = previous[j]
    return out
