"""Suffix arrays of many short strings at once, by linear grouping construction.

First the suffixes of each string are grouped by their first character. Groups are taken in
descending order; every suffix of a group points to the nearest earlier suffix of a smaller group,
and those it points to move to groups of their own behind the one they were in, further the more
often they are pointed to. In the end a group holds the suffixes with the same Lyndon prefix. Then
one pass over the order, from the smallest suffix, places each suffix's predecessors at the front of
their groups. Nothing is renamed and solved again.

All strings advance together: a step takes the next group of each, as numpy arrays.
"""

from __future__ import annotations

import numpy as np


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each start on, one list after the other."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    return np.arange(total) - np.repeat(ends - counts, counts) + np.repeat(starts, counts)


def suffix_arrays(text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Suffix order of each string; ``text`` holds them in a row, with ends at ``starts[1:]``.

    Every string must end with a character smaller than all others in it. The result holds, for
    each string in its own range, the places of its suffixes in ``text`` from smallest to largest.
    """
    starts = np.asarray(starts, np.int64)
    lengths = np.diff(starts)
    total = int(starts[-1])
    owner = np.repeat(np.arange(len(lengths)), lengths)
    if not total:
        return np.zeros(0, np.int64)
    group, previous = _lyndon_groups(text, starts, lengths, owner)
    return _emit(starts, lengths, group, previous)


def _lyndon_groups(text, starts, lengths, owner) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix the place where its final group begins, and its previous smaller suffix."""
    total = len(owner)
    order = np.lexsort((text, owner))
    place = np.empty(total, np.int64)
    place[order] = np.arange(total)
    new = np.ones(total, bool)
    new[1:] = (owner[order][1:] != owner[order][:-1]) | (text[order][1:] != text[order][:-1])
    heads = np.flatnonzero(new)
    size = np.zeros(total, np.int64)
    size[heads] = np.diff(heads, append=total)
    group = np.empty(total, np.int64)
    group[order] = np.repeat(heads, size[heads])
    previous = np.full(total, -1, np.int64)
    moved = np.zeros(total, bool)
    first_of = starts[:-1][owner]
    last = starts[1:] - 1
    live = np.flatnonzero(lengths > 0)
    while len(live):
        # The highest group not yet taken of each string.
        head = group[order[last[live]]]
        count = last[live] - head + 1
        members = order[_ranges(head, count)]
        own = np.repeat(head, count)
        last[live] = head - 1
        live = live[last[live] >= starts[live]]
        previous[members] = np.where(members > first_of[members], members - 1, -1)
        pending = np.arange(len(members))
        while len(pending):
            at = previous[members[pending]]
            far = at >= 0
            far[far] = group[at[far]] >= own[pending[far]]
            pending = pending[far]
            previous[members[pending]] = previous[at[far]]
        pointed, times = np.unique(previous[members], return_counts=True)
        if len(pointed) and pointed[0] < 0:
            pointed, times = pointed[1:], times[1:]
        if not len(pointed):
            continue
        base = group[pointed]
        by = np.lexsort((times, base))
        pointed, times, base = pointed[by], times[by], base[by]
        begins = np.ones(len(base), bool)
        begins[1:] = base[1:] != base[:-1]
        touched = base[begins]
        number = np.diff(np.flatnonzero(begins), append=len(base))
        tail = touched + size[touched] - number
        slots = _ranges(tail, number)
        moved[pointed] = True
        sitting = order[slots]
        out = sitting[~moved[sitting]]
        free = place[pointed]
        free = free[free < np.repeat(tail, number)]
        order[free], place[out] = out, free
        order[slots], place[pointed] = pointed, slots
        moved[pointed] = False
        begins[1:] |= times[1:] != times[:-1]
        heads = slots[begins]
        runs = np.diff(np.flatnonzero(begins), append=len(base))
        size[touched] -= number
        size[heads] = runs
        group[pointed] = np.repeat(heads, runs)
    return group, previous


def _emit(starts, lengths, group, previous) -> np.ndarray:
    """The order within groups: predecessors of smaller suffixes come first."""
    total = len(group)
    result = np.full(total, -1, np.int64)
    front = np.arange(total)
    placed = np.zeros(total, bool)
    live = np.flatnonzero(lengths > 0)
    result[starts[live]] = starts[live + 1] - 1
    placed[starts[live + 1] - 1] = True
    front[group[starts[live + 1] - 1]] += 1
    step = 0
    by_length = live[np.argsort(-lengths[live], kind="stable")]
    sorted_lengths = -lengths[by_length]
    while True:
        live = by_length[:np.searchsorted(sorted_lengths, -step)]
        if not len(live):
            return result
        at = result[starts[live] + step] - 1
        low = starts[live]
        keep = at >= low
        at, low = at[keep], low[keep]
        while len(at):
            new = ~placed[at]
            at, low = at[new], low[new]
            where = front[group[at]]
            result[where] = at
            front[group[at]] += 1
            placed[at] = True
            at = previous[at]
            keep = at >= low
            at, low = at[keep], low[keep]
        step += 1
