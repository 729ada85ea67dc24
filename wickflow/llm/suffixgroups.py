"""Suffix arrays by linear grouping.

Every suffix begins with a longest Lyndon word. Phase one sorts the suffixes into groups
by that word: groups are visited in descending order, the nearest smaller suffix before
each member (its previous-smaller pointer) has its own word extended by the group's, and
moves to a new group right above the one it was in. Phase two walks the suffix array from
the smallest suffix and puts each suffix that ends its Lyndon word there at the front of
its group, following the same pointers. No symbols are renamed and nothing is sorted
again recursively.
"""

from __future__ import annotations

from collections import Counter

import numpy as np


def group_by_lyndon_prefix(symbols: np.ndarray) -> tuple[list[int], list[int]]:
    """First place of each suffix's group in the suffix array, and the previous-smaller
    pointers (-1: none). The last symbol is the only one of its kind and the smallest."""
    n = len(symbols)
    by_symbol = np.argsort(symbols, kind="stable")
    ordered = symbols[by_symbol]
    heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    widths = np.diff(np.concatenate([heads, [n]]))
    first_of = np.empty(n, np.int64)
    first_of[by_symbol] = np.repeat(heads, widths)
    place_of = np.empty(n, np.int64)
    place_of[by_symbol] = np.arange(n)
    size_at = np.zeros(n, np.int64)
    size_at[heads] = widths
    order, first, place, size = by_symbol.tolist(), first_of.tolist(), place_of.tolist(), size_at.tolist()
    smaller = [-1] * n

    def to_tail(suffix: int) -> int:
        """Swap the suffix to the end of its group and cut it off; the place it has now."""
        head = first[suffix]
        size[head] -= 1
        tail = head + size[head]
        here, other = place[suffix], order[tail]
        order[here], order[tail] = other, suffix
        place[other], place[suffix] = here, tail
        return tail

    top = n - 1
    while top > 0:
        low = first[order[top]]
        if low == top:
            suffix = order[top]
            parent = suffix - 1
            while parent >= 0 and first[parent] >= low:
                parent = smaller[parent]
            smaller[suffix] = parent
            if parent >= 0 and size[first[parent]] > 1:
                tail = to_tail(parent)
                first[parent], size[tail] = tail, 1
        else:
            children: Counter[int] = Counter()
            for suffix in sorted(order[low : top + 1]):
                parent = suffix - 1
                while parent >= 0 and first[parent] >= low:
                    parent = smaller[parent]
                smaller[suffix] = parent
                if parent >= 0:
                    children[parent] += 1
            # more copies of the group's word make a greater suffix
            levels: dict[int, list[int]] = {}
            for parent, copies in children.items():
                levels.setdefault(copies, []).append(parent)
            for copies in sorted(levels, reverse=True):
                cut: Counter[int] = Counter()
                for parent in levels[copies]:
                    to_tail(parent)
                    cut[first[parent]] += 1
                new = {head: head + size[head] for head in cut}
                for parent in levels[copies]:
                    first[parent] = new[first[parent]]
                for head, count in cut.items():
                    size[new[head]] = count
        top = low - 1
    return first, smaller


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in ascending order. Any non-negative integers; the last is
    the only one of its kind and the smallest."""
    n = len(symbols)
    if n <= 1:
        return np.arange(n)
    front, smaller = group_by_lyndon_prefix(symbols)
    head = list(range(n))
    out = [n - 1] * n
    placed = bytearray(n)
    placed[n - 1] = 1
    for k in range(n):
        suffix = out[k] - 1
        while suffix >= 0 and not placed[suffix]:
            group = front[suffix]
            out[head[group]] = suffix
            head[group] += 1
            placed[suffix] = 1
            suffix = smaller[suffix]
    return np.array(out, np.int64)


def common_prefixes(symbols: np.ndarray, array: np.ndarray, most: int) -> np.ndarray:
    """Symbols that each suffix shares with the one before it in the array, up to ``most``."""
    n = len(symbols)
    shared = np.zeros(n, np.int64)
    live = np.arange(1, n)
    for depth in range(most):
        a, b = array[live] + depth, array[live - 1] + depth
        inside = np.maximum(a, b) < n
        live = live[inside]
        live = live[symbols[a[inside]] == symbols[b[inside]]]
        if not len(live):
            break
        shared[live] += 1
    return shared
