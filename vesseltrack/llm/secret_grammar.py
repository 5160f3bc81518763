"""Probabilistic automata inferred from examples by merging compatible states of their prefix tree.

Examples are strings over a fixed alphabet. Each node of the prefix tree counts
the examples that pass and those that end there. From the root outward a node is
merged with the first accepted state that it is compatible with, or becomes a
state itself. Two nodes are compatible if the shares of examples that end, that
continue with each letter and that continue with each kind of letter (capital,
small, digit, other) differ by no more than a Hoeffding bound allows, there and
at all nodes that they both lead to. Nodes with fewer than
``MIN_STATE`` examples say too little: what leads there leads to the state of
its letter, in which only the last letter is known.
"""

from __future__ import annotations

import math

import numpy as np

# The letters of candidate runs.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
CODE = {c: i for i, c in enumerate(ALPHABET)}
END = len(ALPHABET)
KIND = [0 if c.isupper() else 1 if c.islower() else 2 if c.isdigit() else 3 for c in ALPHABET]
MIN_STATE = 16
ALPHA = 0.05
PRIOR = 2.0  # weight of the shorter context in each estimate


class _Tree:
    def __init__(self, examples):
        self.n, self.ends, self.to = [0], [0], [{}]
        for value in examples:
            at = 0
            self.n[0] += 1
            for c in value:
                nxt = self.to[at].get(CODE[c])
                if nxt is None:
                    nxt = self.to[at][CODE[c]] = len(self.n)
                    self.n.append(0)
                    self.ends.append(0)
                    self.to.append({})
                at = nxt
                self.n[at] += 1
            self.ends[at] += 1

    def compatible(self, a: int, b: int) -> bool:
        slack, work = math.sqrt(0.5 * math.log(2 / ALPHA)), [(a, b)]
        while work:
            a, b = work.pop()
            na, nb = self.n[a], self.n[b]
            bound = slack * (1 / math.sqrt(na) + 1 / math.sqrt(nb))
            if bound >= 1:
                continue
            if abs(self.ends[a] / na - self.ends[b] / nb) > bound:
                return False
            kinds = [0.0] * 4
            for c in self.flow[a].keys() | self.flow[b].keys():
                apart = self.flow[a].get(c, 0) / na - self.flow[b].get(c, 0) / nb
                if abs(apart) > bound:
                    return False
                kinds[KIND[c]] += apart
                if c in self.to[a] and c in self.to[b]:
                    work.append((self.to[a][c], self.to[b][c]))
            if max(map(abs, kinds)) > bound:
                return False
        return True

    def fold(self, a: int, b: int) -> None:
        """Adds the subtree of ``b`` to the state ``a``."""
        work = [(a, b)]
        while work:
            a, b = work.pop()
            self.n[a] += self.n[b]
            self.ends[a] += self.ends[b]
            for c, y in self.to[b].items():
                self.flow[a][c] = self.flow[a].get(c, 0) + self.flow[b][c]
                if c in self.to[a]:
                    work.append((self.to[a][c], y))
                else:
                    self.to[a][c] = y

    def merged(self) -> list[int]:
        """Accepted states, the root first; ``to`` leads from them to states, or to nodes that are too small."""
        self.flow = [{c: self.n[y] for c, y in to.items()} for to in self.to]
        states, known = [0], {0}
        while True:
            fringe = [(-self.n[y], i, c) for i, s in enumerate(states) for c, y in self.to[s].items() if y not in known and self.n[y] >= MIN_STATE]
            if not fringe:
                return states
            _, i, c = min(fringe)
            node = self.to[states[i]][c]
            for s in states:
                if self.compatible(s, node):
                    self.to[states[i]][c] = s
                    self.fold(s, node)
                    break
            else:
                states.append(node)
                known.add(node)


class Automaton:
    """Letter and end probabilities of each state, smoothed by those of the last letter, and these by those of any letter."""

    def __init__(self, examples):
        examples = sorted(examples)
        tree = _Tree(examples)
        states = tree.merged()
        place = {s: i for i, s in enumerate(states)}
        size, rows = END + 1, len(states) + END
        after = np.zeros((END + 1, size))  # row END: first letters
        for value in examples:
            codes = [*(CODE[c] for c in value), END]
            for x, y in zip([END, *codes], codes):
                after[x, y] += 1
        any_letter = (after.sum(axis=0) + PRIOR / size) / (after.sum() + PRIOR)
        after = (after + PRIOR * any_letter) / (after.sum(axis=1, keepdims=True) + PRIOR)

        count = np.zeros((len(states), size))
        self.next = np.empty((rows, END), dtype=np.int32)
        self.next[:] = len(states) + np.arange(END)  # the state of a letter
        for i, s in enumerate(states):
            count[i, END] = tree.ends[s]
            for c, y in tree.to[s].items():
                count[i, c] = tree.flow[s][c]
                if y in place:
                    self.next[i, c] = place[y]
        share = np.zeros((len(states), size))  # of the letters that lead to a state: its shorter context
        share[0, END] = 1
        for i in range(len(states)):
            for c in range(END):
                if self.next[i, c] < len(states):
                    share[self.next[i, c], c] += count[i, c]
        share /= share.sum(axis=1, keepdims=True)
        own = (count + PRIOR * share @ after) / (count.sum(axis=1, keepdims=True) + PRIOR)
        self.log = np.log(np.vstack((own, after[:END])))
        self.states = len(states)
        self._rows = None

    def likelihood(self, value: str) -> float:
        """Log probability of a string."""
        if self._rows is None:
            self._rows = self.next.tolist(), self.log.tolist()
        to, log = self._rows
        s, total = 0, 0.0
        for c in map(CODE.__getitem__, value):
            total += log[s][c]
            s = to[s][c]
        return total + log[s][END]

    def __getstate__(self):
        return {"next": self.next, "log": self.log, "states": self.states, "_rows": None}
