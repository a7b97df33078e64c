"""Suffix automata over word numbers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator


class SuffixAutomaton:
    """Automaton of several sequences; each state knows the least owner of its occurrences."""

    def __init__(self, sequences: Iterable[tuple[int, list[int]]]) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.owner: list[float] = [float("inf")]
        for owner, sequence in sequences:
            last = 0
            for symbol in sequence:
                last = self._extend(last, symbol, owner)
        # an occurrence of a state is one of every shorter suffix
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            up = self.link[state]
            if self.owner[state] < self.owner[up]:
                self.owner[up] = self.owner[state]

    def _clone(self, p: int, q: int, symbol: int) -> int:
        """A copy of ``q`` for the shorter strings that reach it over ``p``."""
        copy = len(self.length)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        self.owner.append(float("inf"))
        while p != -1 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def _extend(self, last: int, symbol: int, owner: int) -> int:
        known = self.next[last].get(symbol)
        if known is not None:  # another sequence went here before
            state = known if self.length[known] == self.length[last] + 1 else self._clone(last, known, symbol)
        else:
            state = len(self.length)
            self.next.append({})
            self.link.append(0)
            self.length.append(self.length[last] + 1)
            self.owner.append(float("inf"))
            p = last
            while p != -1 and symbol not in self.next[p]:
                self.next[p][symbol] = state
                p = self.link[p]
            if p != -1:
                q = self.next[p][symbol]
                self.link[state] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, symbol)
        self.owner[state] = min(self.owner[state], owner)
        return state

    def ends_of_earlier(self, sequence: list[int], size: int, owner: int) -> Iterator[int]:
        """Positions where a window of ``size`` symbols ends that also occurs under a smaller owner.

        ``sequence`` is streamed once; the state kept is the longest suffix of
        what was read that occurs, cut back to the window's length.
        """
        state, matched = 0, 0
        for k, symbol in enumerate(sequence):
            while state and symbol not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if symbol in self.next[state]:
                state = self.next[state][symbol]
                matched += 1
            else:
                state, matched = 0, 0
            while self.link[state] > 0 and self.length[self.link[state]] >= size:
                state = self.link[state]
                matched = self.length[state]
            if matched >= size and self.owner[state] < owner:
                yield k
