"""Suffix automaton over sequences of integers, and matching statistics against it."""

from __future__ import annotations

from collections.abc import Sequence


class SuffixAutomaton:
    """Holds every run of items of the sequences added so far; linear in their total length."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, items: Sequence[int]) -> None:
        last = 0
        for c in items:
            last = self._extend(last, c)

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(following)
        return len(self.length) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """A copy of q that ends the runs of p's length plus one."""
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    def statistics(self, items: Sequence[int]) -> list[int]:
        """For each item the length of the longest run ending there that some added sequence holds."""
        state = n = 0
        out = []
        for c in items:
            while state and c not in self.next[state]:
                state = self.link[state]
                n = self.length[state]
            if c in self.next[state]:
                state, n = self.next[state][c], n + 1
            out.append(n)
        return out
