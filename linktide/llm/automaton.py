"""A generalised suffix automaton over word sequences."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


class ItemAutomaton:
    """All word substrings of the items, with what a window of ``window`` words needs.

    Items are ``(key, words)``. A window is ``window`` consecutive words of an item, or
    all words of an item that has fewer. Items without words have none.
    """

    def __init__(self, items: Sequence[tuple[str, Sequence[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        spelled = [
            (key, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words])
            for key, words in items
            if words
        ]
        self.shortest = min([window, *(len(words) for _, words in spelled)])
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in spelled:
            state = 0
            for w in words:
                state = self._extend(state, w)
        self._mark(spelled)
        size = max(1, len(self.vocabulary))
        self._pairs = np.unique(np.array(
            [a * size + b for _, words in spelled for a, b in zip(words, words[1:], strict=False)], np.int64
        ))

    def _new(self, length: int, link: int, after: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(after)
        return len(self.length) - 1

    def _split(self, p: int, q: int, w: int) -> int:
        """The state for ``p`` + ``w`` cut out of ``q``, which also ends longer strings."""
        copy = self._new(self.length[p] + 1, self.link[q], dict(self.next[q]))
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def _extend(self, last: int, w: int) -> int:
        q = self.next[last].get(w)
        if q is not None:  # the string is known from an item before
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, w)
        state = self._new(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = state
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, w)
        return state

    def _mark(self, spelled: list[tuple[str, list[int]]]) -> None:
        order = sorted(range(1, len(self.length)), key=self.length.__getitem__)
        # The state on the suffix path of each state that stands for its last ``window`` words.
        self.whole = [-1] * len(self.length)
        for v in order:
            if self.length[v] >= self.window:
                up = self.link[v]
                self.whole[v] = v if self.length[up] < self.window else self.whole[up]
        self.items: list[set[str]] = [set() for _ in self.length]
        short: dict[int, list[tuple[int, str]]] = {}
        for key, words in spelled:
            state = 0
            for w in words:
                state = self.next[state][w]
                if self.whole[state] >= 0:
                    self.items[self.whole[state]].add(key)
            if len(words) < self.window:
                short.setdefault(state, []).append((len(words), key))
        self.short = short
        # The nearest state on the suffix path that ends a short item.
        self.ender = [-1] * len(self.length)
        for v in order:
            self.ender[v] = v if v in short else self.ender[self.link[v]]

    def stretches(self, codes: np.ndarray) -> list[tuple[int, int]]:
        """Where windows can lie: runs of item words whose neighbours are neighbours in
        an item, at least as long as the shortest window. ``codes`` are word numbers, -1
        for words of no item."""
        if not self.vocabulary or len(codes) < self.shortest:
            return []
        joined = np.zeros(len(codes) + 1, bool)
        known = codes >= 0
        pairs = codes[:-1] * len(self.vocabulary) + codes[1:]
        place = np.minimum(np.searchsorted(self._pairs, pairs), max(0, len(self._pairs) - 1))
        if len(self._pairs):
            joined[1:-1] = known[:-1] & known[1:] & (self._pairs[place] == pairs)
        begins = np.flatnonzero(known & ~joined[:-1])
        ends = np.flatnonzero(known & ~joined[1:]) + 1
        long = ends - begins >= self.shortest
        return list(zip(begins[long].tolist(), ends[long].tolist(), strict=True))

    def matches(self, codes: np.ndarray) -> tuple[list[tuple[int, int]], set[str]]:
        """``(spans, items)``: merged word spans (end exclusive) covered by windows.

        Words are streamed through the automaton, which keeps the longest suffix that is
        in an item; a window ends where that is long enough.
        """
        spans: list[list[int]] = []
        items: set[str] = set()
        window, after, link, length = self.window, self.next, self.link, self.length
        for begin, end in self.stretches(codes):
            state = size = 0
            for i, w in enumerate(codes[begin:end].tolist(), begin):
                while state and w not in after[state]:
                    state = link[state]
                    size = length[state]
                if w in after[state]:
                    state, size = after[state][w], size + 1
                covered = 0
                if size >= window:
                    covered = window
                    v = state
                    while length[link[v]] >= size:
                        v = link[v]
                    items |= self.items[self.whole[v]]
                v = self.ender[state] if state else -1
                while v > 0:
                    for n, key in self.short[v]:
                        if n <= size:
                            covered = max(covered, n)
                            items.add(key)
                    v = self.ender[link[v]]
                if covered:
                    first = i + 1 - covered
                    while spans and spans[-1][1] >= first:
                        first = min(first, spans.pop()[0])
                    spans.append([first, i + 1])
        return [(a, b) for a, b in spans], items
