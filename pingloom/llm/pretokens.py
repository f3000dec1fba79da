"""Byte-level BPE of whole batches: split into pre-tokens at once, encode each distinct pre-token once.

The split is the pattern of the byte-level pre-tokenizer,
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``, on arrays of code points. Merges
never cross a pre-token, so the ids of a text are those of its pre-tokens in a row; the ids themselves always come from
the tokenizer. Pre-tokens are looked up by hash and then compared by their code points, so no two are ever mixed up.
"""

from __future__ import annotations

import unicodedata
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from pingloom.llm import text as T

# Distinct pre-tokens a worker remembers, and their code points; beyond that it starts afresh.
REMEMBERED, REMEMBERED_CODES = 400_000, 4_000_000
_LETTER, _NUMBER, _SPACE, _OTHER = 1, 2, 3, 0
# The code points of the Unicode property White_Space.
_WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 for itself, the rest from U+0100 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_LETTERS = {b: chr(b) for b in _PRINTABLE} | {
    b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE)))
}
PROBE = "It's  a\n\nprobe: 12 \u00e9t\u00e9 \u4e2d\u6587 we'll\tsee. "
_CONTRACTIONS = ("s", "t", "m", "d", "re", "ve", "ll")


@cache
def _classes() -> np.ndarray:
    kinds = {"L": _LETTER, "N": _NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    out[_WHITE] = _SPACE
    return out


def split(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Start of every pre-token; ``at`` are the n + 1 offsets of the texts in the code points."""
    n = len(codes)
    if n == 0:
        return np.empty(0, np.int64)
    kind = _classes()[codes]
    fresh = np.zeros(n + 1, dtype=bool)
    fresh[at] = True
    start = fresh[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    # The last character of white space before a word is a pre-token of its own, or, if a blank, part of the word.
    space = kind == _SPACE
    final = np.zeros(n, dtype=bool)
    final[:-1] = space[:-1] & ~space[1:] & ~fresh[1:n]
    start |= final
    blank = final & (codes == 32)
    start[1:] &= ~blank[:-1]
    # Contractions: an apostrophe that no blank leads, alone, before small letters.
    quote = np.flatnonzero((codes[:-1] == 39) & start[:-1] & (kind[1:] == _LETTER) & ~fresh[1:n])
    taken = np.zeros(len(quote), dtype=bool)
    for letters in _CONTRACTIONS:
        fits = ~taken & (quote + len(letters) < n)
        for k, letter in enumerate(letters, 1):
            where = np.minimum(quote + k, n - 1)
            fits &= (codes[where] == ord(letter)) & ~fresh[where]
        taken |= fits
        begin = quote[fits]
        start[begin + 1] = False
        after = begin + 1 + len(letters)
        after = after[after < n]
        start[after] |= kind[after] == _LETTER
    return np.flatnonzero(start)


class Encoder:
    """Ids of many texts with one tokenizer file. Remembers the ids of pre-tokens, in a table sorted by their hash."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._forget()
        if self.encode(pa.array([PROBE]))[0].tolist() != self.tokenizer.encode(PROBE, add_special_tokens=False).ids:
            raise ValueError(f"{path} is not a byte-level tokenizer with the usual split")

    def _forget(self) -> None:
        self.hashes = np.empty(0, np.uint64)
        self.slots = np.empty(0, np.int32)
        self.begin = np.zeros(1, np.int64)
        self.ids = np.empty(0, np.uint32)
        self.code_begin = np.zeros(1, np.int64)
        self.codes = np.empty(0, np.uint32)

    def _learn(self, hashes: np.ndarray, words: list[bytes], codes: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
        """Remember the ids of new pre-tokens, given in the order of their hashes, and their code points."""
        merge = self.tokenizer.model.tokenize
        lists = [[t.id for t in merge(w.decode("latin-1").translate(_LETTERS))] for w in words]
        size = np.fromiter(map(len, lists), np.int64, len(lists))
        at = np.searchsorted(self.hashes, hashes)
        number = np.arange(len(self.begin) - 1, len(self.begin) - 1 + len(words), dtype=np.int32)
        self.hashes, self.slots = np.insert(self.hashes, at, hashes), np.insert(self.slots, at, number)
        self.begin = np.concatenate((self.begin, self.begin[-1] + np.cumsum(size)))
        self.ids = np.concatenate((self.ids, np.fromiter(chain.from_iterable(lists), np.uint32, int(size.sum()))))
        self.code_begin = np.concatenate((self.code_begin, self.code_begin[-1] + np.cumsum(last - first)))
        self.codes = np.concatenate((self.codes, *[codes[x:y] for x, y in zip(first, last)]))

    def _same(self, slot: np.ndarray, codes: np.ndarray, first: np.ndarray, last: np.ndarray) -> bool:
        """Whether every pre-token, one after the other in a text, is the one remembered in its slot."""
        size = last - first
        if not np.array_equal(size, self.code_begin[slot + 1] - self.code_begin[slot]):
            return False
        return np.array_equal(codes, self.codes[np.arange(len(codes)) + np.repeat(self.code_begin[slot] - first, size)])

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash in the table, -1 for those that are not there."""
        if len(self.hashes) == 0:
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and n + 1 offsets; a null text has none."""
        raw, at = T.view(texts)
        whole = raw.tobytes()
        if any(t in whole for t in self.special):
            return self._one_by_one(texts)
        joined = whole.decode()
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        cuts = T.points(raw)[at]
        first = split(codes, cuts)
        last = np.append(first[1:], len(codes))
        kinds, example, which = np.unique(T.span_hashes(codes, first, last), return_index=True, return_inverse=True)
        if len(self.hashes) + len(kinds) > REMEMBERED or len(self.codes) > REMEMBERED_CODES:
            self._forget()
        new = np.flatnonzero(self._find(kinds) < 0)
        if len(new):
            begin = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
            a, b = first[example[new]], last[example[new]]
            self._learn(kinds[new], [whole[x:y] for x, y in zip(begin[a].tolist(), begin[b].tolist())], codes, a, b)
        slot = self.slots[self._find(kinds)][which] if len(kinds) else np.empty(0, np.int32)
        if not self._same(slot, codes, first, last):
            return self._one_by_one(texts)
        start = self.begin[slot]
        length = self.begin[slot + 1] - start
        before = np.zeros(len(slot) + 1, np.int64)
        np.cumsum(length, out=before[1:])
        place = np.arange(before[-1]) + np.repeat(start - before[:-1], length)
        return self.ids[place], before[np.searchsorted(first, cuts)]

    def _one_by_one(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Texts with the string of a special token go through the tokenizer whole."""
        lists = [self.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts.to_pylist()]
        return np.array([i for ids in lists for i in ids], np.uint32), np.concatenate(([0], np.cumsum([len(x) for x in lists])))


@cache
def encoder(path: str) -> Encoder:
    """The encoder of this worker, which serves one task after another."""
    return Encoder(path)
