"""Vectorised work on batches of UTF-8 texts: words, hashes of words and of byte windows.

A batch is one contiguous byte buffer with an offset per text. Every function works on whole buffers,
so that the cost per byte is a few numpy passes; buffers are kept small by ``pieces``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

# White space of the word definition [^\x20\x09-\x0D]+.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
PIECE_BYTES = 1 << 18

BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(BASE, -1, 1 << 64)
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[list(SPACES)] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_CODES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all bits."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


# Numbers kept for places, and powers kept; what few long spans and buffers need beyond that is made for them.
_KEPT, _KEPT_POWERS = 1 << 16, 1 << 20


def _numbers(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


@cache
def _multipliers() -> np.ndarray:
    return _numbers(_KEPT)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


@cache
def _table(base: int) -> np.ndarray:
    return _powers(base, _KEPT_POWERS)


def powers(base: int, n: int) -> np.ndarray:
    """The powers of a base modulo 2**64."""
    return _table(base)[:n] if n <= _KEPT_POWERS else _powers(base, n)


def view(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and n + 1 offsets; a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts
    if texts.null_count:
        texts = texts.fill_null(b"")
    if len(texts) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, at - at[0]


def pieces(batch: pa.RecordBatch, column: str = "text", size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``size`` bytes of text; a longer text is a piece of its own."""
    _, at = view(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(at, at[start] + size, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def runs(inside: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every maximal run of marked bytes; runs end with their text."""
    if len(inside) == 0:
        none = np.empty(0, np.int64)
        return none, none, none
    border = np.zeros(len(inside) + 1, dtype=bool)
    border[at] = True
    starts = inside & (border[:-1] | ~np.concatenate(([False], inside[:-1])))
    ends = inside & (border[1:] | ~np.concatenate((inside[1:], [False])))
    first, last = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return first, last, owners(first, at)


def owners(positions: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Text number of each byte position."""
    return np.searchsorted(at, positions, "right") - 1


def words(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word ``[^\\x20\\x09-\\x0D]+``."""
    return runs(_IS_WORD[raw], at)


def points(raw: np.ndarray) -> np.ndarray:
    """n + 1 counts of the code points that begin before each byte."""
    out = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=out[1:])
    return out


def multipliers(n: int) -> np.ndarray:
    """The first ``n`` of a fixed sequence of 64-bit numbers without structure."""
    return _multipliers()[:n] if n <= _KEPT else _numbers(n)


def span_hashes(raw: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes (or code points) of each span; equal ones give equal hashes wherever they stand.

    A sum of the values times a number that stands for their place in the span. No texts collide by their make, as they do
    with a polynomial modulo a power of two; two given different spans of bytes agree with probability 2**-56 at most.
    """
    size = last - first
    out = np.zeros(len(size), np.uint64)
    full = np.flatnonzero(size > 0)
    if len(full):
        begin = np.cumsum(size) - size
        place = np.arange(begin[-1] + size[-1])
        values = raw[place + np.repeat(first - begin, size)].astype(np.uint64)
        place -= np.repeat(begin, size)
        values += np.uint64(1)
        values *= multipliers(int(size.max()))[place]
        out[full] = np.add.reduceat(values, begin[full])
    return mix(out + size.astype(np.uint64))


def prefix_hashes(raw: np.ndarray) -> np.ndarray:
    """n + 1 running sums from which the hash of any short window follows by ``window_hashes`` and ``short_hashes``.

    These are polynomials modulo 2**64, for which there are texts of 1024 bytes that collide by their make: windows must be
    shorter than that.
    """
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_CODES[raw] * powers(BASE, len(raw)), out=sums[1:])
    return sums


def short_hashes(sums: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each of some short spans, which may overlap."""
    h = (sums[last] - sums[first]) * powers(_INVERSE, len(sums))[first]
    return mix(h + (last - first).astype(np.uint64))


def window_hashes(sums: np.ndarray, width: int) -> np.ndarray:
    """Hash of every window of ``width`` bytes."""
    n = len(sums) - width
    if n <= 0:
        return np.empty(0, np.uint64)
    return mix((sums[width:] - sums[:n]) * powers(_INVERSE, n))


def counts(owner: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Per text number, how many entries it owns (or the sum of integer weights)."""
    return np.bincount(owner, weights, n).astype(np.int64) if len(owner) else np.zeros(n, np.int64)


def shingles(hashes: np.ndarray, owner: np.ndarray, n: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each run of ``width`` words; a shorter text gives its whole sequence, an empty one nothing."""
    per = counts(owner, n)
    begin = np.concatenate(([0], np.cumsum(per)))[:-1]
    out = hashes.copy()
    for k in range(1, width):
        nxt = np.zeros_like(hashes)
        nxt[: max(0, len(hashes) - k)] = hashes[k:]
        out = mix(out * np.uint64(BASE) + nxt)
    rank = np.arange(len(hashes)) - begin[owner]
    full = rank + width <= per[owner]
    found, whose = out[full], owner[full]
    for t in np.flatnonzero((per > 0) & (per < width)):
        h = hashes[begin[t] : begin[t] + 1].copy()
        for k in range(1, per[t]):
            h = mix(h * np.uint64(BASE) + hashes[begin[t] + k : begin[t] + k + 1])
        found, whose = np.append(found, mix(h + np.uint64(per[t]))), np.append(whose, t)
    return found, whose


def distinct(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, hash), sorted by both."""
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    if len(hashes):
        new = np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])))
        hashes, owner = hashes[new], owner[new]
    return hashes, owner
