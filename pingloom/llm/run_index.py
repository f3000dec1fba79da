"""A run-length index of short segments of bytes: run-compressed Burrows-Wheeler transform with sampled run borders.

Segments end with end marks of their own that are smaller than any byte, in the order of the segments. Where two
neighbouring suffixes follow the same symbol, inside a run, the length they share is one less than that of the suffixes
one symbol earlier. So lengths are compared only at the borders of runs, where the positions are sampled too, and
streaming over the text gives those of all other positions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# Symbols in the first sort key: seven of nine bits each, byte + 1, with 0 after the end of a segment.
_FIRST = 7


def suffix_order(text: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes; ``left`` is the number of bytes to the end of the segment.

    Suffixes that are equal up to their end marks stand in the order of their positions. Only groups that are still
    tied are sorted again, at twice the depth each time.
    """
    n = len(text)
    if n >= 1 << 32:
        raise ValueError("a bucket is too large for its index: use more buckets")
    padded = np.concatenate((text.astype(np.uint64) + np.uint64(1), np.zeros(_FIRST, np.uint64)))
    key = np.zeros(n, np.uint64)
    for k in range(_FIRST):
        key = (key << np.uint64(9)) | np.where(left > k, padded[k : k + n], np.uint64(0))
    order = np.argsort(key, kind="stable")
    new = np.concatenate(([True], key[order][1:] != key[order][:-1])) if n else np.empty(0, bool)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    depth, longest = _FIRST, int(left.max()) if n else 0
    while depth < longest:
        tied = ~new
        tied[:-1] |= ~new[1:]
        rows = np.flatnonzero(tied)
        if len(rows) == 0:
            break
        own = order[rows]
        further = np.where(left[own] > depth, rank[np.minimum(own + depth, n - 1)], -1)
        group = rank[own]
        sort = np.argsort((group.astype(np.uint64) << np.uint64(32)) | (further + 1).astype(np.uint64), kind="stable")
        own, group, further = own[sort], group[sort], further[sort]
        order[rows] = own
        differs = np.concatenate(([True], (group[1:] != group[:-1]) | (further[1:] != further[:-1])))
        new[rows] = differs
        rank[own] = np.maximum.accumulate(np.where(differs, rows, 0))
        depth *= 2
    return order


@dataclass(frozen=True)
class RunIndex:
    """``row`` and ``symbol`` of each run's start (symbol 256 before a segment), its sampled text position and shared length."""

    order: np.ndarray
    run_row: np.ndarray
    run_symbol: np.ndarray
    run_position: np.ndarray
    run_shared: np.ndarray

    def shared(self) -> np.ndarray:
        """For each text position, how far its suffix agrees with the one before it in the order; streamed from the samples."""
        reach = np.zeros(len(self.order), np.int64)
        reach[self.run_position] = self.run_shared + self.run_position
        return np.maximum.accumulate(reach) - np.arange(len(self.order))


def build(text: np.ndarray, begins: np.ndarray) -> RunIndex:
    """Index of the segments of ``text`` that begin at ``begins``."""
    n = len(text)
    ends = np.append(begins[1:], n)
    segment = np.repeat(np.arange(len(begins)), ends - begins)
    left = ends[segment] - np.arange(n)
    order = suffix_order(text, left)
    before = np.full(n, 256, np.int64)
    before[1:] = text[:-1]
    before[begins] = 256
    symbol = before[order]
    # End marks differ from each other, so no run goes over the start of a segment.
    border = np.ones(n, dtype=bool)
    border[1:] = (symbol[1:] != symbol[:-1]) | (symbol[1:] == 256)
    rows = np.flatnonzero(border)
    here = order[rows]
    there = order[np.maximum(rows - 1, 0)]
    limit = np.minimum(left[here], left[there])
    limit[rows == 0] = 0
    return RunIndex(order, rows, symbol[rows], here, np.minimum(_agreement(text, here, there, limit), limit))


def _agreement(text: np.ndarray, here: np.ndarray, there: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """How many bytes agree from each pair of positions on, at least up to the limit; eight at a time."""
    n = len(text)
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    word = np.zeros(n, np.uint64)
    for k in range(8):
        word = (word << np.uint64(8)) | padded[k : k + n]
    found = np.zeros(len(here), np.int64)
    rows, step = np.flatnonzero(limit > 0), 0
    while len(rows):
        differing = word[here[rows] + step] ^ word[there[rows] + step]
        agreed = np.zeros(len(rows), np.int64)
        for bits in range(0, 64, 8):
            agreed += differing < np.uint64(1 << bits)
        found[rows] += agreed
        step += 8
        rows = rows[(agreed == 8) & (limit[rows] > step)]
    return found


def window_classes(index: RunIndex, width: int) -> np.ndarray:
    """For each row of the order, the number of its class: rows whose suffixes agree in the first ``width`` bytes."""
    return np.cumsum(index.shared()[index.order] < width)
