"""A suffix automaton over word sequences that knows where each subsequence occurs first."""

from __future__ import annotations

from collections.abc import Hashable, Sequence


class SuffixAutomaton:
    """All subsequences of the sequences added so far. ``first[state]`` is the number of the symbol that ended its first occurrence."""

    def __init__(self) -> None:
        self.next: list[dict[Hashable, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [-1]
        self.size = 0  # symbols added

    def _state(self, moves: dict, link: int, length: int, first: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.first.append(first)
        return len(self.next) - 1

    def _split(self, p: int, symbol: Hashable, q: int) -> int:
        """The state of p's sequences followed by ``symbol``, cut out of q."""
        copy = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1, self.first[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = copy
            p = self.link[p]
        return copy

    def add(self, sequence: Sequence[Hashable]) -> int:
        """Add a sequence; returns the number of its first symbol."""
        start, last = self.size, 0
        for symbol in sequence:
            q = self.next[last].get(symbol)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, symbol, q)
            else:
                p, last = last, self._state({}, 0, self.length[last] + 1, self.size)
                while p >= 0 and symbol not in self.next[p]:
                    self.next[p][symbol] = last
                    p = self.link[p]
                if p >= 0:
                    q = self.next[p][symbol]
                    self.link[last] = q if self.length[q] == self.length[p] + 1 else self._split(p, symbol, q)
            self.size += 1
        return start

    def matches(self, sequence: Sequence[Hashable], least: int):
        """For every place whose last ``least`` symbols occur in the automaton: (end, number of the symbol ending their first occurrence)."""
        state, size = 0, 0
        for end, symbol in enumerate(sequence, 1):
            while state and symbol not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if symbol in self.next[state]:
                state = self.next[state][symbol]
                size += 1
            if size >= least:
                at = state
                while self.length[self.link[at]] >= least:
                    at = self.link[at]
                yield end, self.first[at]
