"""Secret scans: fixed patterns, and automata inferred from the credentials these label.

Values found by the patterns are labelled credentials of their kind; other long tokens are ordinary ones. One
probabilistic automaton per kind and one for ordinary tokens are inferred from the formats (symbol classes) of all distinct
values. Their prefixes are counted by Spark; the states are merged from the prefixes of at most ``LONGEST`` symbols that
one in ``RESOLUTION`` values has, with the next symbols of each, as finely as so many values would tell them apart; the
steps of the merged automaton are then counted over all values, whole.
Every candidate, each maximal run of token characters in every text, is then scored by its best format likelihood
against that of ordinary tokens; a candidate above the limit is added as ``format``, unless a pattern span holds all of it.
A longer run that a pattern found in part only is added beside that span.

In the order of hashes, every second distinct ordinary token, of those that meet no pattern span, serves the automaton; the
others set the limit, an exact quantile of their scores.
A kind has an automaton as soon as it has a labelled value: states merge where the few values cannot tell them apart, and
the limit, which comes from ordinary tokens, holds for all kinds alike.

Defined cases: a null or empty text has no spans; without labelled values or without ordinary tokens only pattern spans are
reported; very long texts are scanned whole, in batches of bounded bytes; runs of equal score are treated alike; repeated
rows stay; extra columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pingloom.llm import text as T
from pingloom.llm.automata import Automaton, Tree, merged, replay, weighted
from pingloom.llm.frames import hashed_sums, numbered, prepare, quantiles, tidied
from pingloom.session import spool

KINDS = ("assign", "access", "hex")
FORMAT = "format"
ORDINARY = "ordinary"
RESOLUTION = 3000
LONGEST = 256
CANDIDATE_BYTES = 12
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 12, 18, 16
# The limit lies this far, in nats, above this quantile of the scores of the ordinary tokens set aside for it. The
# highest few do not count, since unlabelled credentials may be among them.
QUANTILE, MARGIN = 0.999, 6.0

_ASSIGN = re.compile(rb"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")


def _mask(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_LOWER, _UPPER, _DIGITS = b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
_HEX = _mask(_DIGITS + _LOWER[:6])
_TOKEN = _mask(_LOWER + _UPPER + _DIGITS + b"+/_.=-")
_CLASSES = (_LOWER[:6], _LOWER[6:], _UPPER[:6], _UPPER[6:], _DIGITS, b"+", b"/", b"_", b".", b"=", b"-")
_SYMBOL = np.full(256, len(_CLASSES), np.uint8)
for _number, _members in enumerate(_CLASSES):
    _SYMBOL[list(_members)] = _number
SYMBOLS = len(_CLASSES) + 1
# Formats as text: a letter for each symbol.
_LETTER = _SYMBOL + np.uint8(65)


@dataclass
class Spans:
    """Kind number, text number, byte span and value span of each finding, positions in the whole buffer."""

    kind: np.ndarray
    owner: np.ndarray
    first: np.ndarray
    last: np.ndarray
    value_first: np.ndarray
    value_last: np.ndarray


def pattern_spans(raw: np.ndarray, at: np.ndarray) -> Spans:
    """What the fixed patterns find, leftmost and not overlapping for each kind."""
    rows: list[tuple[int, int, int, int, int, int]] = []
    whole = raw.tobytes()
    for owner in np.unique(T.owners(np.flatnonzero((raw == ord(":")) | (raw == ord("="))), at)):
        for m in _ASSIGN.finditer(whole[at[owner] : at[owner + 1]]):
            if m.end(2) - m.start(2) >= MIN_ASSIGN:
                rows.append((0, owner, *(at[owner] + x for x in (m.start(), m.end(), m.start(2), m.end(2)))))
    hits = np.array([m.start() for m in re.finditer(b"AKIA", whole)], np.int64)
    for owner in np.unique(T.owners(hits, at)):
        for m in _ACCESS.finditer(whole[at[owner] : at[owner + 1]]):
            if m.end() - m.start() >= MIN_ACCESS:
                rows.append((1, owner, *(at[owner] + x for x in (m.start(), m.end(), m.start(), m.end()))))
    first, last, owner = T.runs(_HEX[raw], at)
    long = last - first >= MIN_HEX
    found = np.array(rows, np.int64).reshape(-1, 6)
    digits = np.stack([np.full(long.sum(), 2), owner[long], first[long], last[long], first[long], last[long]], axis=1)
    found = np.concatenate((found, digits))
    found = found[np.lexsort((found[:, 0], found[:, 2], found[:, 1]))]
    return Spans(*found.T)


def _runs(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every maximal token run, without dots behind it."""
    first, last, owner = T.runs(_TOKEN[raw], at)
    long = last - first >= CANDIDATE_BYTES
    first, last, owner = first[long], last[long], owner[long]
    trim = (last > first) & (raw[last - 1] == ord("."))
    while trim.any():
        last = last - trim
        trim = trim & (last > first) & (raw[np.maximum(last, 1) - 1] == ord("."))
    long = last - first >= CANDIDATE_BYTES
    return first[long], last[long], owner[long]


def candidates(raw: np.ndarray, at: np.ndarray, known: Spans) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token runs that no known span holds whole."""
    first, last, owner = _runs(raw, at)
    if len(known.first) == 0:
        return first, last, owner
    # Known spans stand in the order of their starts; a span of an earlier text ends before this one begins.
    before = np.searchsorted(known.first, first, "right") - 1
    reach = np.where(before >= 0, np.maximum.accumulate(known.last)[before], -1)
    open_ = reach < last
    return first[open_], last[open_], owner[open_]


def ordinary_tokens(raw: np.ndarray, at: np.ndarray, known: Spans) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token runs that meet no known span."""
    first, last, owner = _runs(raw, at)
    covered = np.zeros(len(raw) + 1, np.int64)
    np.add.at(covered, known.first, 1)
    np.add.at(covered, known.last, -1)
    inside = np.concatenate(([0], np.cumsum(np.cumsum(covered[:-1]) > 0)))
    free = inside[last] == inside[first]
    return first[free], last[free], owner[free]


@dataclass(frozen=True)
class Model:
    kinds: tuple[Automaton, ...]
    ordinary: Automaton | None
    limit: float

    def score(self, raw: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Log-likelihood ratio of the best credential format to ordinary tokens."""
        if not self.kinds or self.ordinary is None:
            return np.full(len(first), -np.inf)
        symbols = _SYMBOL[raw]
        best = np.max([k.score(symbols, first, last) for k in self.kinds], axis=0)
        return best - self.ordinary.score(symbols, first, last)


def _values(documents: DataFrame) -> DataFrame:
    """Every distinct value of each kind, and every ordinary token, with its hash and its format."""

    @tidied
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.pieces(batch):
                raw, at = T.view(piece.column("text"))
                known = pattern_spans(raw, at)
                whole, formats = raw.tobytes(), _LETTER[raw].tobytes()
                found = {}
                for kind, a, b in zip(known.kind.tolist(), known.value_first.tolist(), known.value_last.tolist()):
                    found[KINDS[kind], whole[a:b]] = xxhash.xxh3_64_intdigest(whole[a:b]) >> 1, formats[a:b]
                first, last, _ = ordinary_tokens(raw, at, known)
                hashes = (T.span_hashes(raw, first, last) >> np.uint64(1)).tolist()
                for a, b, h in zip(first.tolist(), last.tolist(), hashes):
                    found[ORDINARY, whole[a:b]] = h, formats[a:b]
                yield pa.RecordBatch.from_pydict({
                    "kind": pa.array([k for k, _ in found], pa.string()), "hash": pa.array([h for h, _ in found.values()], pa.int64()),
                    "value": pa.array([v for _, v in found], pa.binary()),
                    "format": pa.array([f.decode() for _, f in found.values()], pa.string()),
                })

    return spool(documents.select("text").mapInArrow(collect, "kind string, hash long, value binary, format string").distinct(), "secrets")


def _shapes(strings: DataFrame, totals: dict[str, int]) -> dict[str, np.ndarray]:
    """The merged states of each kind, from its frequent prefixes and their children; as many rows at most as a kind's resolution allows."""
    size = F.length("format")
    ends = strings.select("kind", "format", "n", "first", F.explode(F.sequence(F.lit(0), F.least(size, F.lit(LONGEST)))).alias("depth"))
    counts = spool(
        ends.groupBy("kind", F.col("format").substr(F.lit(1), F.col("depth")).alias("prefix"))
        .agg(F.sum("n").alias("seen"), F.sum(F.when(F.col("depth") == size, F.col("n")).otherwise(0)).alias("ended"), F.min("first").alias("first")),
        "prefixes",
    )
    least = F.create_map(*[F.lit(x) for kind, n in totals.items() for x in (kind, n / RESOLUTION)])[F.col("kind")]
    is_open = (F.col("seen") >= least) & (F.length("prefix") < LONGEST)
    parents = counts.filter(is_open).select("kind", F.col("prefix").alias("parent"))
    inner = counts.filter(F.length("prefix") > 0).withColumn("parent", F.expr("substr(prefix, 1, length(prefix) - 1)"))
    nodes = inner.join(parents, ["kind", "parent"]).unionByName(counts.filter(F.length("prefix") == 0), allowMissingColumns=True)
    # in the order in which a tree of the values by their hashes would grow
    rows = nodes.select("kind", "prefix", "seen", "ended", "first", is_open.alias("open")).orderBy("first", F.length("prefix"), "prefix").toArrow()
    grown: dict[str, list[tuple[bytes, float, float, bool]]] = {kind: [] for kind in totals}
    for kind, prefix, seen, ended, open_ in zip(*(rows[c].to_pylist() for c in ("kind", "prefix", "seen", "ended", "open"))):
        scale = min(1.0, RESOLUTION / totals[kind])
        grown[kind].append((bytes(ord(c) - 65 for c in prefix), seen * scale, ended * scale, open_))
    return {kind: merged(Tree(prefixes), SYMBOLS) for kind, prefixes in grown.items()}


def _learn(learned: DataFrame) -> dict[str, Automaton]:
    """An automaton for each kind of value."""
    strings = spool(learned.groupBy("kind", "format").agg(F.count(F.lit(1)).alias("n"), F.min("hash").alias("first")), "formats")
    totals = {r["kind"]: r["n"] for r in strings.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    if not totals:
        return {}
    shapes = _shapes(strings, totals)
    width = SYMBOLS + 1
    begins = dict(zip(shapes, np.cumsum([0, *[len(x) * width for x in shapes.values()]]).tolist()))

    @tidied
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = np.array(batch.column("kind").to_pylist())
            weight = batch.column("n").to_numpy()
            raw, at = T.view(batch.column("format"))
            for kind, follow in shapes.items():
                own = np.flatnonzero(kinds == kind)
                steps = replay(follow, raw - np.uint8(65), at[:-1][own], at[1:][own], weight[own]).ravel()
                seen = np.flatnonzero(steps)
                yield pa.RecordBatch.from_pydict({"slot": seen + begins[kind], "n": steps[seen]})

    parts = strings.select("kind", "format", "n").mapInArrow(count, "slot long, n long")
    sums = hashed_sums(parts, sum(len(x) for x in shapes.values()) * width, "n")["n"]
    return {k: weighted(x, sums[begins[k] : begins[k] + len(x) * width].reshape(-1, width)) for k, x in shapes.items()}


def fit(documents: DataFrame) -> Model:
    """Infer the automata and the limit."""
    prepare(documents.sparkSession)
    values = _values(documents)
    ordinary = spool(numbered(values.filter(F.col("kind") == ORDINARY), "hash", "value"), "ordinary")
    learned = values.filter(F.col("kind") != ORDINARY).unionByName(ordinary.filter("place % 2 = 0").drop("place"))
    found = _learn(learned)
    kinds = tuple(found[k] for k in KINDS if k in found)
    held_out = ordinary.filter("place % 2 = 1").select("value")
    if not kinds or not held_out.take(1):
        return Model(kinds, None, np.inf)
    model = Model(kinds, found[ORDINARY], np.inf)

    @tidied
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = T.view(batch.column("value"))
            yield pa.RecordBatch.from_pydict({"score": model.score(raw, at[:-1], at[1:])})

    (limit,) = quantiles(held_out.mapInArrow(score, "score double"), "score", QUANTILE)
    return Model(kinds, model.ordinary, limit + MARGIN)


def _joined(kinds: list[str], first: np.ndarray, last: np.ndarray) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in zip(kinds, first, last))


def scan(documents: DataFrame) -> DataFrame:
    """Per document the number of spans of each kind, a digest of the pattern spans, and all spans, in code points."""
    model = fit(documents)
    names = np.array([*KINDS, FORMAT])

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.pieces(batch):
                raw, at = T.view(piece.column("text"))
                n, before = piece.num_rows, T.points(raw)
                known = pattern_spans(raw, at)
                first, last, owner = candidates(raw, at, known)
                added = model.score(raw, first, last) >= model.limit
                rows = np.concatenate((
                    np.stack([known.owner, known.first, known.kind, known.last], axis=1),
                    np.stack([owner, first, np.full(len(first), len(KINDS)), last], axis=1)[added],
                ))
                rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
                offset = before[at[rows[:, 0]]]
                begin, stop = before[rows[:, 1]] - offset, before[rows[:, 3]] - offset
                digests = [hashlib.sha256(b"").hexdigest()] * n
                joined = [""] * n
                cuts = np.searchsorted(rows[:, 0], np.arange(n + 1))
                for t in np.flatnonzero(np.diff(cuts)):
                    own = slice(cuts[t], cuts[t + 1])
                    kind, a, b = rows[own, 2], begin[own], stop[own]
                    fixed = kind < len(KINDS)
                    digests[t] = hashlib.sha256(_joined(names[kind[fixed]], a[fixed], b[fixed]).encode()).hexdigest()
                    joined[t] = _joined(names[kind], a, b)
                count = [T.counts(rows[rows[:, 2] == k, 0], n) for k in range(len(KINDS) + 1)]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": piece.column("doc_id"), "n_assign": count[0], "n_access": count[1], "n_hex": count[2],
                    "base_sha256": digests, "spans": joined, "n_format": count[3],
                })

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_format long"
    return rows.mapInArrow(run, schema)
