"""Suffix arrays by linear grouping.

Phase 1 groups suffixes by their Lyndon prefixes. Groups are taken in descending order. Each member
finds its previous smaller suffix: the nearest one to its left in a lower group, by following the
pointers of those already taken. Suffixes pointed at leave their group for a new one just above it,
higher the more members point at them. Phase 2 walks the array from its smallest suffix and puts the
suffix before each entry, and those along its pointers, at the next free place of their group. No
part is renamed or sorted recursively.
"""

from __future__ import annotations

from collections.abc import Sequence


def suffix_array(symbols: Sequence[int]) -> list[int]:
    """Starts of the suffixes of symbols (integers of 0 or more) in order."""
    text = [s + 1 for s in symbols] + [0]
    n = len(text)
    members: list[list[int]] = []
    group = [0] * n
    number = {s: g for g, s in enumerate(sorted(set(text)))}
    members = [[] for _ in number]
    for i, s in enumerate(text):
        g = number[s]
        group[i] = g
        members[g].append(i)
    top = len(members) - 1
    up, down = list(range(1, top + 2)), list(range(-1, top))
    taken, prev = bytearray(n), [-1] * n
    g = top
    while g >= 0:
        own = [i for i in members[g] if group[i] == g]
        members[g] = own
        for i in own:
            taken[i] = 1
        pointed: dict[int, list[int]] = {}
        last, times = -1, 0
        for i in own:
            j = i - 1
            while j >= 0 and taken[j]:
                j = prev[j]
            prev[i] = j
            if j == last:
                times += 1
            else:
                if last >= 0:
                    pointed.setdefault(times, []).append(last)
                last, times = j, 1
        if last >= 0:
            pointed.setdefault(times, []).append(last)
        above: dict[int, int] = {}
        for times in sorted(pointed):
            fresh: dict[int, int] = {}
            for p in pointed[times]:
                h = group[p]
                new = fresh.get(h)
                if new is None:
                    at = above.get(h, h)
                    new = fresh[h] = len(members)
                    members.append([])
                    up.append(up[at])
                    down.append(at)
                    down[up[at]] = new
                    up[at] = new
                    above[h] = new
                group[p] = new
                members[new].append(p)
        g = down[g]
    place, at, g = [0] * len(members), 0, 0
    while down[g] >= 0:
        g = down[g]
    while True:
        place[g] = at
        at += len(members[g])
        if g == top:
            break
        g = up[g]
    out, done = [-1] * n, bytearray(n)
    out[0] = n - 1
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not done[j]:
            g = group[j]
            out[place[g]] = j
            place[g] += 1
            done[j] = 1
            j = prev[j]
    return out[1:]
