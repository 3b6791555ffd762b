"""Suffix arrays by linear grouping: Lyndon-prefix groups, then each group's order."""

from __future__ import annotations

from collections import defaultdict


def suffix_array(text: list[int]) -> list[int]:
    """The starts of the suffixes of ``text`` in order; its last symbol must be its only
    least one.

    First every suffix is put into the group of its longest Lyndon prefix. Groups start
    as the first symbols and are taken from the highest to the lowest. The suffixes of
    the group at hand extend those that stand before them with a smaller group
    (``before``, the pointer to the previous smaller suffix): these leave their group for
    a new one right above it, the further up the more often they are extended.

    Then suffixes are written out in ascending order. One that is written puts the
    suffixes whose Lyndon prefix ends where it starts at the next free place of their
    groups; they are found along the same pointers.
    """
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    place = [0] * n  # of a suffix in ``order``
    group = [0] * n  # a group's name is its first place
    size = [0] * (n + 1)
    first = 0
    for k, i in enumerate(order):
        if k and text[order[k - 1]] != text[i]:
            first = k
        place[i], group[i] = k, first
        size[first] += 1

    before = [-1] * n
    known = bytearray(n)
    end = n
    while end > 1:
        top = group[order[end - 1]]
        extended: dict[int, int] = defaultdict(int)
        for i in sorted(order[top:end]):
            p = i - 1
            while p >= 0 and group[p] >= top:
                p = before[p] if known[p] else p - 1
            before[i] = p
            known[i] = 1
            if p >= 0:
                extended[p] += 1
        by_count: dict[int, list[int]] = defaultdict(list)
        for p, times in extended.items():
            by_count[times].append(p)
        for times in sorted(by_count, reverse=True):
            moved: dict[int, int] = {}
            members = by_count[times]
            for p in members:
                g = group[p]
                size[g] -= 1
                last = g + size[g]
                other, at = order[last], place[p]
                order[at], place[other] = other, at
                order[last], place[p] = p, last
                moved[g] = last
            for p in members:
                g = moved[group[p]]
                group[p] = g
                size[g] += 1
        end = top

    free = list(range(n + 1))
    written = bytearray(n)
    found = [0] * n
    found[0] = n - 1
    written[n - 1] = 1
    free[group[n - 1]] += 1
    for k in range(n):
        i = found[k] - 1
        while i >= 0 and not written[i]:
            g = group[i]
            found[free[g]] = i
            free[g] += 1
            written[i] = 1
            i = before[i]
    return found
