"""Probabilistic automata learnt from strings by state merging.

The strings form a prefix tree with counts. Going from the root, each state is merged
into the first earlier state whose outgoing frequencies are statistically compatible
with its own, all the way down (Hoeffding bounds), or becomes a state of its own.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

_FLOOR = math.log(1e-6)


@dataclass
class Automaton:
    """``moves[state][symbol]`` is ``(next state, log probability)``; ``ends`` has that of stopping."""

    moves: list[dict[str, tuple[int, float]]] = field(default_factory=lambda: [{}])
    ends: list[float] = field(default_factory=lambda: [0.0])

    def likelihood(self, value: str) -> float:
        """Mean log-likelihood of a symbol of ``value``, its end counted as one."""
        state, total = 0, 0.0
        for c in value:
            step = self.moves[state].get(c)
            if step is None:
                total += _FLOOR
            else:
                state = step[0]
                total += step[1]
        return (total + self.ends[state]) / (len(value) + 1)


class _Tree:
    def __init__(self, strings: Sequence[str]) -> None:
        self.seen: list[int] = [0]
        self.stop: list[int] = [0]
        self.next: list[dict[str, int]] = [{}]
        self.flow: list[dict[str, int]] = [{}]
        for s in strings:
            at = 0
            self.seen[0] += 1
            for c in s:
                if c not in self.next[at]:
                    self.next[at][c] = len(self.seen)
                    self.flow[at][c] = 0
                    self.seen.append(0)
                    self.stop.append(0)
                    self.next.append({})
                    self.flow.append({})
                self.flow[at][c] += 1
                at = self.next[at][c]
                self.seen[at] += 1
            self.stop[at] += 1

    def alike(self, a: int, b: int, bound: float) -> bool:
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            nx, ny = self.seen[x], self.seen[y]
            if not nx or not ny:
                continue
            limit = bound * (1 / math.sqrt(nx) + 1 / math.sqrt(ny))
            if abs(self.stop[x] / nx - self.stop[y] / ny) > limit:
                return False
            fx, fy = self.flow[x], self.flow[y]
            for c in fx.keys() | fy.keys():
                if abs(fx.get(c, 0) / nx - fy.get(c, 0) / ny) > limit:
                    return False
                if c in fx and c in fy:
                    todo.append((self.next[x][c], self.next[y][c]))
        return True

    def fold(self, a: int, b: int) -> None:
        """Put the subtree of ``b`` onto state ``a``."""
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            self.seen[x] += self.seen[y]
            self.stop[x] += self.stop[y]
            for c, n in self.flow[y].items():
                self.flow[x][c] = self.flow[x].get(c, 0) + n
                if c in self.next[x]:
                    todo.append((self.next[x][c], self.next[y][c]))
                else:
                    self.next[x][c] = self.next[y][c]


def learn(values: Sequence[str], alpha: float = 0.05) -> Automaton:
    """Automaton of the format of ``values``."""
    tree = _Tree(sorted(values))
    bound = math.sqrt(0.5 * math.log(2 / alpha))
    kept = [0]
    while True:
        known = set(kept)
        edge = next(((r, c, q) for r in kept for c, q in sorted(tree.next[r].items()) if q not in known), None)
        if edge is None:
            break
        r, c, q = edge
        into = next((k for k in kept if tree.alike(k, q, bound)), None)
        if into is None:
            kept.append(q)
        else:
            tree.next[r][c] = into
            tree.fold(into, q)
    place = {s: i for i, s in enumerate(kept)}
    moves, ends = [], []
    for s in kept:
        total = tree.seen[s] + 1
        moves.append({c: (place[q], math.log(tree.flow[s][c] / total)) for c, q in tree.next[s].items()})
        ends.append(math.log((tree.stop[s] + 0.05) / total))
    return Automaton(moves, ends)
