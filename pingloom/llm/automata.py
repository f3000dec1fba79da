"""Probabilistic automata inferred from example strings by merging compatible states of their prefix tree.

The strings are sequences of small symbol numbers. States of the prefix tree are merged when their frequencies of
ending and of going on with each symbol, and those of all states below, agree within a Hoeffding bound.

The tree may be given as counted prefixes instead, without what follows rare ones: what is not known there is not
compared. The counts of the merged automaton come from a replay of all strings, which can be made in parts.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Automaton:
    """``next[state, symbol]``, log-probabilities of each step and of ending; the last state takes in the unseen."""

    next: np.ndarray
    step: np.ndarray
    end: np.ndarray

    def score(self, symbols: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Log-probability of each span of ``symbols``; all spans walk in step."""
        total = np.zeros(len(first))
        state = np.zeros(len(first), np.int64)
        order = np.argsort(first - last, kind="stable")
        first, length = first[order], (last - first)[order]
        active = len(first)
        for k in range(int(length[0]) if len(length) else 0):
            active = int(np.searchsorted(-length[:active], -k, "left"))
            symbol = symbols[first[:active] + k]
            total[:active] += self.step[state[:active], symbol]
            state[:active] = self.next[state[:active], symbol]
        out = np.empty(len(first))
        out[order] = total + self.end[state]
        return out


class Tree:
    """Prefix tree with counts, merged in place; ``known`` counts the strings whose way on from a state is in the tree."""

    def __init__(self, prefixes: Iterable[tuple[bytes, float, float, bool]]):
        """Of each prefix, parents first: how many strings begin with it, end with it, and whether its children are given."""
        self.seen, self.ended, self.known, self.after = [0], [0], [0], [{}]
        at = {b"": 0}
        for prefix, seen, ended, open_ in prefixes:
            if prefix:
                at[prefix] = self.after[at[prefix[:-1]]][prefix[-1]] = len(self.seen)
                for counts in (self.seen, self.ended, self.known):
                    counts.append(0)
                self.after.append({})
            node = at[prefix]
            self.seen[node] = seen
            if open_:
                self.ended[node], self.known[node] = ended, seen

    def alike(self, a: int, b: int, bound: float) -> bool:
        pairs = [(a, b)]
        while pairs:
            a, b = pairs.pop()
            n, m = self.known[a], self.known[b]
            if n == 0 or m == 0:
                continue
            limit = bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if abs(self.ended[a] / n - self.ended[b] / m) > limit:
                return False
            for symbol in self.after[a].keys() | self.after[b].keys():
                x, y = self.after[a].get(symbol), self.after[b].get(symbol)
                if abs((self.seen[x] / n if x else 0) - (self.seen[y] / m if y else 0)) > limit:
                    return False
                if x and y:
                    pairs.append((x, y))
        return True

    def fold(self, a: int, b: int) -> None:
        """Add the subtree ``b`` to the state ``a``."""
        pairs = [(a, b)]
        while pairs:
            a, b = pairs.pop()
            self.seen[a] += self.seen[b]
            self.ended[a] += self.ended[b]
            self.known[a] += self.known[b]
            for symbol, y in self.after[b].items():
                x = self.after[a].get(symbol)
                if x is None:
                    self.after[a][symbol] = y
                else:
                    pairs.append((x, y))


def merged(tree: Tree, symbols: int, confidence: float = 0.05) -> np.ndarray:
    """Merge a prefix tree; ``next[state, symbol]`` of what is left, its last state for ways that are not known."""
    bound = math.sqrt(0.5 * math.log(2 / confidence))
    kept = [0]
    edges: dict[tuple[int, int], int] = {}
    border = [(0, s) for s in tree.after[0]]
    while border:
        source, symbol = border.pop(max(range(len(border)), key=lambda i: tree.seen[tree.after[border[i][0]][border[i][1]]]))
        node = tree.after[source][symbol]
        same = next((k for k in kept if tree.alike(k, node, bound)), None)
        if same is None:
            kept.append(node)
            border += [(node, s) for s in tree.after[node]]
            edges[source, symbol] = node
        else:
            edges[source, symbol] = same
            had = {k: set(tree.after[k]) for k in kept}
            tree.after[source][symbol] = same
            tree.fold(same, node)
            border += [(k, s) for k in kept for s in tree.after[k].keys() - had[k] if (k, s) not in edges]
    number = {node: i for i, node in enumerate(kept)}
    follow = np.full((len(kept) + 1, symbols), len(kept), np.int64)
    for (source, symbol), node in edges.items():
        follow[number[source], symbol] = number[node]
    return follow


def replay(follow: np.ndarray, symbols: np.ndarray, first: np.ndarray, last: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """How often spans of ``symbols`` go on from each state with each symbol, and end there."""
    size, width = follow.shape
    out = np.zeros((size, width + 1), np.int64)
    state = np.zeros(len(first), np.int64)
    order = np.argsort(first - last, kind="stable")
    first, length, weight = first[order], (last - first)[order], weight[order]
    active = len(first)
    for k in range(int(length[0]) if len(length) else 0):
        active = int(np.searchsorted(-length[:active], -k, "left"))
        symbol = symbols[first[:active] + k]
        np.add.at(out, (state[:active], symbol), weight[:active])
        state[:active] = follow[state[:active], symbol]
    np.add.at(out, (state, width), weight)
    return out


def weighted(follow: np.ndarray, counts: np.ndarray, prior: float = 0.1) -> Automaton:
    """The automaton of these ways and counts; ``prior`` is added to each count, so that nothing is impossible."""
    raised = counts + prior
    logs = np.log(raised / raised.sum(axis=1, keepdims=True))
    return Automaton(follow, logs[:, :-1], logs[:, -1])


def infer(strings: list[bytes], symbols: int, confidence: float = 0.05, prior: float = 0.1) -> Automaton:
    """Merge the whole prefix tree of a few strings and replay them."""
    seen: dict[bytes, list[int]] = {b"": [0, 0]}
    for string in strings:
        for k in range(len(string) + 1):
            seen.setdefault(string[:k], [0, 0])[0] += 1
        seen[string][1] += 1
    follow = merged(Tree((prefix, n, ended, True) for prefix, (n, ended) in seen.items()), symbols, confidence)
    at = np.cumsum([0, *map(len, strings)])
    raw = np.frombuffer(b"".join(strings), np.uint8)
    return weighted(follow, replay(follow, raw, at[:-1], at[1:], np.ones(len(strings), np.int64)), prior)
