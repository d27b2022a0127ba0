"""Suffix arrays of many short texts at once, by Lyndon-prefix grouping.

The linear grouping construction has two parts. Suffixes start in groups by
their first symbol. Part one takes the groups in descending order; for each
suffix of the group it finds the nearest earlier suffix in a lower group (its
previous-smaller pointer) and moves those, by how many of the group point at
them, into new groups just above their old ones. Afterwards every group holds
the suffixes with one Lyndon prefix, and the groups are in order. Part two
walks the order from the sentinel up and emits, before each suffix already
placed, its left neighbour and that one's previous-smaller chain at the front
of their groups. Nothing is renamed or sorted again in between.

Every step is done for all texts of a batch together (each text takes its own
highest group), so the work is a few array operations a step.
"""

from __future__ import annotations

import numpy as np

from daystream.llm.text import ranges


def suffix_arrays(symbols: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Suffix arrays of texts ``symbols[off[i]:off[i+1]]``, as positions in ``symbols``.

    Each text must end with a symbol smaller than all its others. The result
    has text i's suffixes in ascending order at ``off[i]:off[i+1]``.
    """
    n = int(off[-1])
    if n >= 2 ** 31:
        raise ValueError("batch of texts too large")
    i4 = np.int32
    off = off.astype(np.int64)
    text = np.repeat(np.arange(len(off) - 1, dtype=np.int64), np.diff(off))
    key = text * (int(symbols.max(initial=0)) + 1) + symbols
    sa = np.argsort(key, kind="stable").astype(i4)
    place = np.empty(n, i4)
    place[sa] = np.arange(n, dtype=i4)
    cut = np.flatnonzero(np.r_[True, np.diff(key[sa]) != 0]) if n else np.zeros(0, np.int64)
    size = np.diff(np.r_[cut, n])
    start = np.empty(n, i4)           # of the group that a suffix is in
    start[sa] = np.repeat(cut, size)
    end = np.zeros(n + 1, i4)         # of the group that starts in a place
    end[cut] = cut + size
    before = np.full(n, -1, i4)       # previous-smaller pointers
    moving = np.zeros(n, bool)
    lowest = off[:-1]

    live = np.flatnonzero(np.diff(off) > 0)
    top = off[live + 1].copy()
    while len(live):
        s = start[sa[top - 1]].astype(np.int64)
        size = top - s
        m = sa[ranges(s, size)]
        group = np.repeat(s, size)
        top = s
        p = m - 1
        p[m == np.repeat(lowest[live], size)] = -1
        before[m] = p
        todo, limit = np.arange(len(m)), group
        while len(todo):
            j = before[m[todo]]
            on = (j >= 0) & (start[j] >= limit[todo])
            todo, j = todo[on], j[on]
            before[m[todo]] = before[j]
        p = before[m]
        p = np.sort(p[p >= 0])
        if len(p):
            new = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
            many = np.diff(np.r_[new, len(p)])
            p = p[new]
            g = start[p]
            o = np.lexsort((p, many, g))
            p, many, g = p[o], many[o], g[o].astype(np.int64)
            run = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
            length = np.diff(np.r_[run, len(g)])
            stop = end[g[run]].astype(np.int64)
            tail = stop - length
            slot = ranges(tail, length)
            moving[p] = True
            there = sa[slot]
            stay = there[~moving[there]]
            old = place[p]
            free = old[old < np.repeat(tail, length)]
            sa[free] = stay
            place[stay] = free
            sa[slot] = p
            place[p] = slot
            moving[p] = False
            sub = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (many[1:] != many[:-1])])
            sub_len = np.diff(np.r_[sub, len(g)])
            end[g[run]] = tail
            end[slot[sub]] = slot[sub] + sub_len
            start[p] = np.repeat(slot[sub], sub_len)
        on = top > lowest[live]
        live, top = live[on], top[on]

    out = np.full(n, -1, i4)
    front = np.arange(n, dtype=i4)    # next free place of the group that starts in a place
    done = np.zeros(n, bool)
    live = np.flatnonzero(np.diff(off) > 0)
    last = off[live + 1] - 1
    out[off[live]] = last
    done[last] = True
    at = off[live].copy()
    while len(live):
        j = out[at] - 1
        j = j[j >= lowest[live]]
        j = j[~done[j]]
        while len(j):
            g = start[j]
            f = front[g]
            out[f] = j
            front[g] = f + 1
            done[j] = True
            j = before[j]
            j = j[j >= 0]
            j = j[~done[j]]
        at += 1
        on = at < off[live + 1]
        live, at = live[on], at[on]
    return out
