"""Probabilistic automata inferred from example strings by merging compatible states (ALERGIA)."""

from __future__ import annotations

from collections import Counter, deque
from collections.abc import Iterable
from dataclasses import dataclass
from math import log, log2, sqrt

#: Kinds of characters and how many characters each has; any other character is a kind of its own.
KINDS = {"0": "0123456789", "a": "abcdef", "g": "ghijklmnopqrstuvwxyz", "A": "ABCDEF", "G": "GHIJKLMNOPQRSTUVWXYZ"}
_KIND = {ord(c): k for k, chars in KINDS.items() for c in chars}
_BITS = {k: log2(len(chars)) for k, chars in KINDS.items()}
#: Weight of what a state has never seen, and the number of symbols it is spread over.
UNSEEN, SYMBOLS = 0.5, 16


def shape(text: str) -> str:
    """The kinds of the text's characters."""
    return text.translate(_KIND)


@dataclass
class Automaton:
    """States with, by symbol, the bits it costs and the next state; ``end`` are the bits of stopping.

    A symbol that a state has not seen costs ``miss`` bits and goes back to the start.
    """

    steps: list[dict[str, tuple[float, int]]]
    end: list[float]
    miss: list[float]

    def bits(self, text: str) -> float:
        """Minus the binary logarithm of the text's probability."""
        state, total = 0, 0.0
        for c in shape(text):
            cost, state_after = self.steps[state].get(c) or (self.miss[state], 0)
            total += cost + _BITS.get(c, 0.0)
            state = state_after
        return total + self.end[state]

    def plain(self) -> dict:
        """As lists and dicts, for JSON; ``Automaton(**plain)`` is the way back."""
        return {"steps": self.steps, "end": self.end, "miss": self.miss}


class _Tree:
    """The prefix tree with its counts; merged states share one entry."""

    def __init__(self, words: Iterable[str]):
        self.count, self.ends, self.next = [0], [0], [{}]
        for word, n in sorted(Counter(map(shape, words)).items()):
            at = 0
            self.count[0] += n
            for c in word:
                if c not in self.next[at]:
                    self.next[at][c] = len(self.count)
                    self.count.append(0)
                    self.ends.append(0)
                    self.next.append({})
                at = self.next[at][c]
                self.count[at] += n
            self.ends[at] += n

    def alike(self, a: int, b: int, bound: float) -> bool:
        """Whether two states and all below them agree in every frequency, by Hoeffding's bound."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self.count[a], self.count[b]
            if not n or not m:
                continue
            far = bound * (1 / sqrt(n) + 1 / sqrt(m))
            if abs(self.ends[a] / n - self.ends[b] / m) > far:
                return False
            for c in self.next[a].keys() | self.next[b].keys():
                x, y = self.next[a].get(c), self.next[b].get(c)
                p = self.arcs[a].get(c, 0) / n
                q = self.arcs[b].get(c, 0) / m
                if abs(p - q) > far:
                    return False
                if x is not None and y is not None:
                    todo.append((x, y))
        return True

    def fold(self, into: int, state: int) -> None:
        """Adds a state of the tree and all below it to another state. While the target has no
        state for a symbol, the branch is hung on as it is."""
        todo = [(into, state)]
        while todo:
            a, b = todo.pop()
            self.count[a] += self.count[b]
            self.ends[a] += self.ends[b]
            for c, y in self.next[b].items():
                self.arcs[a][c] = self.arcs[a].get(c, 0) + self.arcs[b][c]
                if c in self.next[a]:
                    todo.append((self.next[a][c], y))
                else:
                    self.next[a][c] = y

    def _apart(self, a: int, b: int) -> float:
        """How much the frequencies of two states differ in all."""
        n, m = self.count[a], self.count[b]
        ends = abs(self.ends[a] / n - self.ends[b] / m)
        symbols = self.arcs[a].keys() | self.arcs[b].keys()
        return ends + sum(abs(self.arcs[a].get(c, 0) / n - self.arcs[b].get(c, 0) / m) for c in symbols)

    def merge(self, bound: float, least: float) -> list[int]:
        """States that stay, the start first. In the order of the tree each state below one that
        stays is merged into the first it agrees with, or stays itself; one reached less than
        ``least`` times that agrees with none goes to the nearest."""
        self.arcs = [{c: self.count[y] for c, y in row.items()} for row in self.next]
        kept, todo = [0], deque((0, c) for c in sorted(self.next[0]))
        seen = {0}
        while todo:
            parent, c = todo.popleft()
            state = self.next[parent][c]
            if state in seen:
                continue
            other = next((k for k in kept if self.alike(k, state, bound)), None)
            if other is None and self.count[state] < least:
                other = min(kept, key=lambda k: (self._apart(k, state), k))
            if other is None:
                kept.append(state)
                seen.add(state)
                todo.extend((state, x) for x in sorted(self.next[state]))
                continue
            self.next[parent][c] = other
            self.fold(other, state)
            # folding may have hung new branches on any state that stays
            todo.extend((k, x) for k in kept for x, y in sorted(self.next[k].items()) if y not in seen)
        return kept


def infer(words: Iterable[str], alpha: float = 0.05, floor: float = 0.0) -> Automaton:
    """The automaton of the words' shapes. ``alpha``: how often equal states may be kept apart.
    ``floor``: share of the words below which a state is not kept apart, so that what only few
    words have is not learnt as a form of its own.

    No words give an automaton of one state that has seen nothing.
    """
    tree = _Tree(words)
    kept = tree.merge(sqrt(0.5 * log(2 / alpha)), floor * tree.count[0])
    place = {state: k for k, state in enumerate(kept)}
    steps, end, miss = [], [], []
    for state in kept:
        whole = tree.count[state] + UNSEEN
        steps.append(
            {c: (-log2(n / whole), place[tree.next[state][c]]) for c, n in sorted(tree.arcs[state].items())}
        )
        end.append(-log2((tree.ends[state] + UNSEEN / SYMBOLS) / whole))
        miss.append(-log2(UNSEEN / SYMBOLS / whole))
    return Automaton(steps, end, miss)
