"""Personal data by anchor expansion.

One Aho-Corasick automaton passes over a text and stops at anchors: at-signs, plus signs, digits, colons, ``://`` and the
words that lead to an identifier (``CUES``, in small, capital and title letters). At an anchor a local parser expands to
the left and right as far as its grammar reaches and checks what it holds; it looks at nothing else, and where a parser has
been, the anchors of its kind are passed over, so the work is linear in the text.

Kinds of ``BASE`` have a fixed grammar, found leftmost and not overlapping within a kind; a match that fails its check is
dropped and not tried again shorter:

* ``email`` ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``
* ``ip`` four numbers joined by dots, each at most 255
* ``card`` 16 to 19 digits, single blanks or hyphens between them, that pass the Luhn check
* ``phone`` ``\\+[0-9][\\x20().0-9-]+[0-9]`` with 8 to 15 digits

Kinds of ``ADDED`` are spans that these grammars cut short or miss. One that lies inside a base span is left out.

* ``mailbox`` an e-mail address with Latin letters beyond ASCII, or at an address literal
* ``login`` a URL with user information, up to the end of host and port
* ``ip6`` an IPv6 address of at least three groups
* ``tel`` the number behind ``tel:``, 7 to 15 digits
* ``iban`` behind its cue, the longest value with the right check digits
* ``account``, ``ssn``, ``passport`` the number behind its cue, where a word border follows

Defined cases: a null or empty text has no spans; very long texts are handled whole, one at a time; equal rows and equal
ids stay rows of their own; a null ``doc_id`` stays null; extra columns are ignored by ``find`` and kept by ``redact``; no
rows give no rows.
"""

from __future__ import annotations

import ipaddress
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pingloom.llm import text as T
from pingloom.llm.frames import prepare, tidied

BASE = ("email", "ip", "card", "phone")
ADDED = ("mailbox", "login", "ip6", "tel", "iban", "account", "ssn", "passport")
KINDS = BASE + ADDED
Span = tuple[int, int, int]

_AT, _PLUS, _DIGIT, _COLON, _SCHEME = "@", "+", "digit", ":", "://"
CUES = {
    "tel:": "tel", "iban": "iban", "account": "account", "acct": "account", "ssn": "ssn",
    "social security": "ssn", "passport": "passport",
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SCHEME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_HEX_COLON = frozenset("0123456789ABCDEFabcdef:")
# Latin letters beyond ASCII, without the signs of multiplication and division.
_LATIN = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_WIDE_LETTER = re.compile(f"[{_LATIN}]")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_WIDE_DOMAIN = re.compile(rf"\[[0-9A-Fa-f:.]+\]|[A-Za-z0-9{_LATIN}-]+(?:\.[A-Za-z0-9{_LATIN}-]+)+")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])*")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_USER_AND_HOST = re.compile(
    r"[^\s/?#\"'<>@]+@(?:\[[0-9A-Fa-f:.]+\]|[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*)(?::[0-9]{1,5})?"
)
_IP6_REST = re.compile(r"[0-9A-Fa-f:]*(?:(?<=:)[0-9]{1,3}(?:\.[0-9]{1,3}){3})?")
_TEL = re.compile(r"\x20?([0-9(+][\x20().0-9-]*[0-9])")
_TO_NUMBER = r"(?i:\x20?(?:no|nr|num|number|id)\b\.?)?[\x20:#=.]{0,3}"
_IBAN = re.compile(_TO_NUMBER + r"([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})")
_NUMBER_OF = {
    "account": re.compile(_TO_NUMBER + r"([0-9](?:[\x20-]?[0-9]){5,17})(?![\x20-]?[0-9])(?!\w)"),
    "ssn": re.compile(_TO_NUMBER + r"((?!000|666|9)[0-9]{3}([\x20-]?)(?!00)[0-9]{2}\2(?!0000)[0-9]{4})(?!\w)"),
    "passport": re.compile(_TO_NUMBER + r"([A-Z]{0,2}[0-9]{6,9})(?!\w)"),
}


@cache
def _anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for sign in (_AT, _PLUS, _COLON, _SCHEME):
        found.add_word(sign, sign)
    for digit in "0123456789":
        found.add_word(digit, _DIGIT)
    for cue, kind in CUES.items():
        for form in (cue, cue.upper(), cue.capitalize(), cue.title()):
            found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _small(number: str) -> bool:
    """Whether a string of digits is at most 255, however long it is."""
    number = number.lstrip("0")
    return len(number) <= 3 and int(number or "0") <= 255


def _n_digits(value: str) -> int:
    return sum(c in "0123456789" for c in value)


def _border(text: str, at: int) -> bool:
    """Whether no letter or digit stands on one of the sides of a position."""
    return at <= 0 or at >= len(text) or not (text[at - 1].isalnum() and text[at].isalnum())


def _left(text: str, at: int, chars: frozenset[str], least: int = 0) -> int:
    while at > least and text[at - 1] in chars:
        at -= 1
    return at


def _check_digits(value: str) -> bool:
    """ISO 7064 mod 97-10, as account numbers have it: the first four characters go to the end, letters count from 10."""
    turned = value[4:] + value[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


class _Parsers:
    """The local parsers over one text. ``after`` is, for each kind, where its last match ended."""

    def __init__(self, text: str):
        self.text = text
        self.after = dict.fromkeys((*KINDS, "numbers"), 0)
        self.spans: list[Span] = []

    def _add(self, kind: str, start: int, end: int) -> None:
        self.spans.append((KINDS.index(kind), start, end))

    def digit(self, at: int) -> None:
        text, after = self.text, self.after
        if at >= after["card"]:
            after["card"] = end = _DIGITS.match(text, at).end()
            if end - at >= 16:
                digits = text[at:end].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and _luhn(digits):
                    self._add("card", at, end)
        if at >= after["numbers"]:
            after["numbers"] = end = _NUMBERS.match(text, at).end()
            parts = text[at:end].split(".")
            for k in range(0, len(parts) - 3, 4):
                four = parts[k : k + 4]
                size = sum(map(len, four)) + 3
                if all(map(_small, four)):
                    self._add("ip", at, at + size)
                at += size + 1

    def plus(self, at: int) -> None:
        found = _PHONE.match(self.text, at)
        if found and 8 <= _n_digits(found[0]) <= 15:
            self._add("phone", at, found.end())

    def at_sign(self, at: int) -> None:
        text = self.text
        start = _left(text, at, _LOCAL, self.after["email"])
        domain = _DOMAIN.match(text, at + 1)
        if start < at and domain:
            self.after["email"] = domain.end()
            self._add("email", start, domain.end())
        wide = start
        while wide > self.after["mailbox"] and (text[wide - 1] in _LOCAL or _WIDE_LETTER.match(text, wide - 1)):
            wide -= 1
        while wide < at and text[wide] == ".":
            wide += 1
        host = _WIDE_DOMAIN.match(text, at + 1)
        if wide == at or not host or at - wide > 64 or host.end() - at > 254:
            return
        name = text[wide : host.end()]
        if name.endswith("]"):
            try:
                ipaddress.ip_address(host[0][1:-1])
            except ValueError:
                return
        elif not _WIDE_LETTER.search(name) or not host[0].rpartition(".")[2].isalpha():
            return
        self.after["mailbox"] = host.end()
        self._add("mailbox", wide, host.end())

    def scheme(self, last: int) -> None:
        text, at = self.text, last - 2
        start = _left(text, at, _SCHEME_CHARS, self.after["login"])
        while start < at and not text[start].isalpha():
            start += 1
        whole = _USER_AND_HOST.match(text, last + 1)
        if start < at and whole:
            self.after["login"] = whole.end()
            self._add("login", start, whole.end())

    def colon(self, at: int) -> None:
        text = self.text
        if at < self.after["ip6"]:
            return
        start = _left(text, at, _HEX_COLON, max(self.after["ip6"], at - 4))
        end = self.after["ip6"] = max(_IP6_REST.match(text, at).end(), at + 1)
        while end > at and text[end - 1] == ":" and text[end - 2 : end] != "::":
            end -= 1
        value = text[start:end]
        if not 2 <= value.count(":") <= 7 or len(value) > 45 or not (_border(text, start) and _border(text, end)):
            return
        if sum(1 for part in value.split(":") if part) < 3:
            return
        try:
            ipaddress.IPv6Address(value)
        except ValueError:
            return
        self._add("ip6", start, end)

    def cue(self, kind: str, last: int, size: int) -> None:
        text, end = self.text, last + 1
        if end - size and text[end - size - 1].isalnum() or end < self.after[kind]:
            return
        if kind == "tel":
            found = _TEL.match(text, end)
            if not found or not 7 <= _n_digits(found[1]) <= 15:
                return
            span = found.span(1)
        elif kind == "iban":
            found = _IBAN.match(text, end)
            span = self._iban(*found.span(1)) if found else None
        else:
            found = _NUMBER_OF[kind].match(text, end)
            span = found.span(1) if found else None
        if span:
            self.after[kind] = span[1]
            self._add(kind, *span)

    def _iban(self, start: int, end: int) -> tuple[int, int] | None:
        for stop in range(end, start + 14, -1):
            value = self.text[start:stop]
            if value[-1] != " " and _border(self.text, stop) and _check_digits(value.replace(" ", "")):
                return start, stop
        return None


def spans_of(text: str) -> list[Span]:
    """Kind number, start and end in code points of all findings in a text, by kind and start."""
    parse = _Parsers(text)
    for last, anchor in _anchors().iter(text):
        if anchor is _DIGIT:
            parse.digit(last)
        elif anchor is _AT:
            parse.at_sign(last)
        elif anchor is _PLUS:
            parse.plus(last)
        elif anchor is _COLON:
            parse.colon(last)
        elif anchor is _SCHEME:
            parse.scheme(last)
        else:
            parse.cue(anchor[0], last, anchor[1])
    fixed = sorted((s for s in parse.spans if s[0] < len(BASE)), key=lambda s: s[1])
    starts, reach = [s[1] for s in fixed], list(accumulate((s[2] for s in fixed), max))

    def inside(span: Span) -> bool:
        before = bisect_right(starts, span[1])
        return before > 0 and reach[before - 1] >= span[2]

    return sorted(fixed + [s for s in parse.spans if s[0] >= len(BASE) and not inside(s)])


SPANS = "array<struct<kind: string, start: bigint, end: bigint>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def _as_arrow(found: list[list[Span]]) -> pa.Array:
    flat = np.array([s for own in found for s in own], np.int64).reshape(-1, 3)
    rows = pa.StructArray.from_arrays(
        [pa.array(KINDS).take(pa.array(flat[:, 0])), pa.array(flat[:, 1]), pa.array(flat[:, 2])], fields=list(_SPAN)
    )
    offsets = np.concatenate(([0], np.cumsum([len(own) for own in found], dtype=np.int64))).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, rows)


def find(documents: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans`` (kind, start, end in code points; by kind as listed, then start) of every document."""
    prepare(documents.sparkSession)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.pieces(batch):
                found = [spans_of(t or "") for t in piece.column("text").to_pylist()]
                yield pa.RecordBatch.from_pydict({"doc_id": piece.column("doc_id"), "spans": _as_arrow(found)})

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, f"doc_id long, spans {SPANS}")


def hidden(text: str) -> str:
    """The text with its findings replaced by their kind in angle brackets; of overlapping ones the first, then longest."""
    out, at = [], 0
    for start, end, kind in sorted(((s, e, k) for k, s, e in spans_of(text)), key=lambda x: (x[0], -x[1], x[2])):
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind]}>"]
        if end > at:
            at = end
    return "".join([*out, text[at:]])


def redact(documents: DataFrame) -> DataFrame:
    """The documents with their findings replaced in ``text``, and all other columns as they are."""
    prepare(documents.sparkSession)
    place = documents.columns.index("text")

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.pieces(batch):
                texts = [None if t is None else hidden(t) for t in piece.column("text").to_pylist()]
                yield piece.set_column(place, piece.schema.field(place), pa.array(texts, piece.schema.field(place).type))

    return documents.mapInArrow(run, documents.schema)
