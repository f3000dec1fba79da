"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are cut into overlapping passages of words, weighted by TF-IDF with the document frequencies of the whole
corpus. Passages of a block are the rows of a sparse matrix, dealt to Spark tasks; a randomised singular value
decomposition, whose products with the matrix are summed over the tasks, gives its leading right singular vectors, as many as
keep ``KEPT`` of the variance. This latent space has fewer dimensions than there are passages, so terms that passages share
fall together. Overlapping windows of every document are folded into it and compared with all passages by their cosine
there; a window of which less than ``IN_SPACE`` lies in the space is not compared.

What the space lost may matter to a copy, so there is a second, exact path: wherever one of the ``ANCHORS`` rarest terms of a
passage occurs in a text, the weight of the passage's terms found around it is added up, and from ``OVERLAP`` on it is a
candidate too. A verbatim copy always is. A candidate of either path stands if the longest common subsequence of its words with the passage's,
weighted by TF-IDF, covers ``LCS_SHARE`` of the passage, and ``ANSWER_SHARE`` of the answer is there. Passages are checked one
by one, so an item of which only a part was copied is found.

Items are handled in blocks of bounded size, each against all documents in tasks of its own; what a task holds is a block and
one piece of text. An item shorter than the window is also compared with windows of about its own length, so that the text
around a copy does not dilute it. A window is left out before it is folded if its known terms cannot reach the limits.

Terms are runs of letters, digits and non-ASCII characters, lower-cased (ASCII and Latin-1 letters). The answer is the
column ``answer`` of the benchmark if there is one, else the ``ANSWER_WORDS`` rarest terms of the passage.

Defined cases: a null or empty text matches nothing; an item without terms or with a null text matches nothing; items
of equal text are all reported; rows that repeat stay and are each reported; very long texts are handled whole; an empty
benchmark or corpus gives no matches; columns other than the named ones are ignored by ``matches`` and kept by ``clean``,
which drops rows of equal id and text alike, also where the id is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pingloom.llm import text as T
from pingloom.llm.frames import hashed_sums, prepare, tidied
from pingloom.session import spool

SLOTS = 1 << 18
WINDOW = 32
# An item shorter than the window gets the least of these that holds it.
WIDTHS = (1, 2, 3, 4, 6, 8, 12, 16, 24, WINDOW)
# The most passages of a space, and the share of their variance that its dimensions keep.
LATENT, KEPT = 256, 0.8
OVERSAMPLE = 16
POWER_ROUNDS = 2
ROWS_PER_TASK = 64
# Least cosine in the space, and least part of a window that lies in it, as lengths of vectors.
COSINE, IN_SPACE = 0.5, 0.5
# Terms of a passage that the second path looks for, and the share of the passage's weight it wants around them.
ANCHORS, OVERLAP = 2, 0.6
LCS_SHARE = 0.6
ANSWER_WORDS, ANSWER_SHARE = 5, 0.6
# An item block is held by every task, with LATENT numbers for each word at most. A single item may be longer.
BLOCK_ITEMS, BLOCK_WORDS = 4000, 1 << 15

_TERM = np.zeros(256, dtype=bool)
_TERM[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")] = True
_TERM[128:] = True


def terms(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every term."""
    low = T.LOWER[raw]
    # Latin-1 capitals are two bytes; the second of them is 0x20 below that of the small letter.
    lead = np.concatenate(([False], raw[:-1] == 0xC3))
    low = low + (0x20 * (lead & (raw >= 0x80) & (raw <= 0x9E) & (raw != 0x97))).astype(np.uint8)
    first, last, owner = T.runs(_TERM[raw], at)
    return T.span_hashes(low, first, last), owner


def slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - 18)).astype(np.int64)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for piece in T.pieces(batch):
            yield piece, *terms(*T.view(piece.column("text")))


def rarity(documents: DataFrame) -> np.ndarray:
    """Inverse document frequency of each term slot over the corpus."""

    @tidied
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(SLOTS + 1, np.int64), 0
        for piece, hashes, owner in _pieces(batches):
            key = np.unique(owner * SLOTS + slot(hashes))
            seen += np.bincount(key % SLOTS, minlength=SLOTS + 1)
            n += piece.num_rows
        seen[SLOTS] = n
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({"slot": at, "n": seen[at]})

    sums = hashed_sums(documents.select("text").mapInArrow(count, "slot long, n long"), SLOTS + 1, "n")["n"]
    return np.log((sums[SLOTS] + 1) / (sums[:SLOTS] + 0.5)).clip(0.01).astype(np.float32)


@dataclass(frozen=True)
class Passage:
    """Terms of a passage in order, their weights, and the answer that has to be near; ``item`` counts within the block."""

    item: int
    terms: np.ndarray
    weights: np.ndarray
    answer: frozenset[int]
    # terms around a candidate that are looked at
    reach: int


@dataclass(frozen=True)
class Item:
    number: int
    passages: list[Passage]


@dataclass(frozen=True)
class Space:
    """Latent space of some passages: the row of the basis of each term of the block, and the folded passages.

    Terms that no passage has share the last row, which is zero. ``passages`` are folded and of length one, ``peak`` is the
    largest weight that any of them gives to the term of a row. ``width`` is the least width of window for them.
    """

    width: int
    row: np.ndarray
    basis: np.ndarray
    peak: np.ndarray
    passages: np.ndarray
    number: np.ndarray


@dataclass(frozen=True)
class Block:
    """Items, the sorted hashes of their terms, the spaces of their passages, and the passages by their rarest terms."""

    rarity: np.ndarray
    items: list[int]
    passages: list[Passage]
    known: np.ndarray
    spaces: list[Space]
    anchors: np.ndarray
    anchored: list[list[int]]


def _passages(item: int, own: np.ndarray, answer: np.ndarray, idf: np.ndarray) -> list[Passage]:
    found = []
    for start in _cut(len(own)):
        terms = own[start : start + WINDOW]
        weights = idf[slot(terms)]
        wanted = answer if len(answer) else terms[np.argsort(-weights, kind="stable")[:ANSWER_WORDS]]
        found.append(Passage(item, terms, weights, frozenset(wanted.tolist()), WINDOW + (len(own) if len(answer) else len(terms))))
    return found


def _blocks(benchmark: DataFrame, idf: np.ndarray) -> Iterator[list[Item]]:
    """Items in blocks of bounded size; rows come to the driver one partition at a time."""
    columns = ["item_id", "text"] + (["answer"] if "answer" in benchmark.columns else [])
    block: list[Item] = []
    n_words = 0
    for row in benchmark.select(F.col("item_id").cast("long").alias("item_id"), *columns[1:]).toLocalIterator():
        raw, at = T.view(pa.array([row["text"], row["answer"] if len(columns) > 2 else None], pa.string()))
        hashes, owner = terms(raw, at)
        own = hashes[owner == 0]
        if len(own) == 0:
            continue
        block.append(Item(row["item_id"], _passages(len(block), own, hashes[owner == 1], idf)))
        n_words += len(own)
        if len(block) >= BLOCK_ITEMS or n_words >= BLOCK_WORDS:
            yield block
            block, n_words = [], 0
    if block:
        yield block


def _cut(n: int) -> list[int]:
    """Starts of passages of ``WINDOW`` words that cover n words."""
    return [0] if n <= WINDOW else [*range(0, n - WINDOW, WINDOW // 2), n - WINDOW]


def _rows(lists: list[np.ndarray], weights: list[np.ndarray], m: np.ndarray) -> np.ndarray:
    """Sparse rows times a dense matrix."""
    return np.stack([w @ m[r] for r, w in zip(lists, weights)]) if lists else np.empty((0, m.shape[1]))


def randomised_svd(spark: SparkSession, rows: list[np.ndarray], weights: list[np.ndarray], size: int, kept: float) -> np.ndarray:
    """Leading right singular vectors, which keep a share of the variance, of a sparse matrix whose rows are in Spark tasks.

    The range is found by multiplying a Gaussian matrix with the matrix and its transpose, and orthogonalised after each
    round. Each task adds up its own share of the products, other tasks add those up by ranges of terms, and the driver gets
    one matrix of terms by at most ``LATENT + OVERSAMPLE`` numbers.
    """
    frame = spark.createDataFrame(
        [(r.tolist(), w.tolist()) for r, w in zip(rows, weights)], "terms array<int>, weights array<double>"
    ).repartition(max(1, len(rows) // ROWS_PER_TASK))
    wide = min(len(rows) + OVERSAMPLE, size)

    def product(m: np.ndarray) -> np.ndarray:
        @tidied
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros_like(m)
            for batch in batches:
                own = [np.array(t) for t in batch.column("terms").to_pylist()]
                weight = [np.array(w) for w in batch.column("weights").to_pylist()]
                for t, w, y in zip(own, weight, _rows(own, weight, m)):
                    np.add.at(out, t, w[:, None] * y)
            touched = np.flatnonzero(out.any(axis=1))
            for lo in range(0, len(touched), 256):
                some = touched[lo : lo + 256]
                yield pa.RecordBatch.from_pydict({
                    "part": some // 256, "term": some, "values": pa.array([out[t].tobytes() for t in some], pa.binary())
                })

        def add(table: pa.Table) -> pa.Table:
            kinds, which = np.unique(table["term"].to_numpy(), return_inverse=True)
            sums = np.zeros((len(kinds), wide))
            np.add.at(sums, which, np.frombuffer(b"".join(table["values"].to_pylist())).reshape(-1, wide))
            return pa.table({"term": kinds, "values": pa.array([row.tobytes() for row in sums], pa.binary())})

        parts = frame.mapInArrow(run, "part long, term long, values binary")
        sums = parts.groupBy("part").applyInArrow(add, "term long, values binary").toArrow()
        out = np.zeros_like(m)
        out[sums["term"].to_numpy()] = np.frombuffer(b"".join(sums["values"].to_pylist())).reshape(-1, wide)
        return out

    basis = np.linalg.qr(product(np.random.default_rng(7).standard_normal((size, wide))))[0]
    for _ in range(POWER_ROUNDS):
        basis = np.linalg.qr(product(basis))[0]
    values, vectors = np.linalg.eigh(basis.T @ product(basis))
    values, vectors = values[::-1].clip(0), vectors[:, ::-1]
    total = sum(float(w @ w) for w in weights)
    rank = int(np.searchsorted(np.cumsum(values), kept * total)) + 1
    return basis @ vectors[:, :rank]


def block(spark: SparkSession, items: list[Item], idf: np.ndarray) -> Block:
    """Items with the latent spaces of their passages."""
    passages = [p for item in items for p in item.passages]
    known = np.unique(np.concatenate([p.terms for p in passages]))
    by_width: dict[int, list[int]] = {}
    anchored: dict[int, list[int]] = {}
    for number, passage in enumerate(passages):
        width = min([w for w in WIDTHS if w >= len(passage.terms)], default=WINDOW)
        by_width.setdefault(width, []).append(number)
        for term in {int(t): None for t in passage.terms[np.argsort(-passage.weights, kind="stable")[:ANCHORS]]}:
            anchored.setdefault(term, []).append(number)
    spaces = [
        _space(spark, width, [(n, passages[n]) for n in alike[lo : lo + LATENT]], known)
        for width, alike in sorted(by_width.items()) for lo in range(0, len(alike), LATENT)
    ]
    anchors = np.array(sorted(anchored), np.uint64)
    return Block(idf, [i.number for i in items], passages, known, spaces, anchors, [anchored[a] for a in anchors.tolist()])


def _space(spark: SparkSession, width: int, passages: list[tuple[int, Passage]], known: np.ndarray) -> Space:
    """The space of numbered passages."""
    rows, weights = [], []
    own = np.unique(np.concatenate([np.searchsorted(known, p.terms) for _, p in passages]))
    for _, passage in passages:
        term, first, n = np.unique(passage.terms, return_index=True, return_counts=True)
        weight = n * passage.weights[first].astype(np.float64)
        rows.append(np.searchsorted(own, np.searchsorted(known, term)))
        weights.append(weight / np.linalg.norm(weight))
    basis = randomised_svd(spark, rows, weights, len(own), KEPT).astype(np.float32)
    folded = _rows(rows, weights, basis).astype(np.float32)
    folded /= np.maximum(np.linalg.norm(folded, axis=1, keepdims=True), 1e-9)
    peak = np.concatenate([(basis[lo : lo + 1024] @ folded.T).max(axis=1) for lo in range(0, len(own), 1024)])
    row = np.full(len(known) + 1, len(own), np.int32)
    row[own] = np.arange(len(own))
    basis = np.vstack([basis, np.zeros((1, basis.shape[1]), np.float32)])
    return Space(width, row, basis, np.append(peak.clip(0), 0), folded, np.array([n for n, _ in passages]))


def _windows(owner: np.ndarray, n: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the windows over the terms of each text; the last of a text ends with it."""
    per = T.counts(owner, n)
    begin = np.concatenate(([0], np.cumsum(per)))[:-1]
    step = max(1, width // 4)
    many = np.where(per > 0, np.maximum(0, -(-(per - width) // step)) + 1, 0)
    whose = np.repeat(np.arange(n), many)
    rank = np.arange(len(whose)) - np.repeat(np.cumsum(many) - many, many)
    start = np.minimum(rank * step, np.maximum(per[whose] - width, 0))
    return begin[whose] + start, begin[whose] + np.minimum(start + width, per[whose])


def subsequence_share(passage: Passage, words: np.ndarray) -> float:
    """Weight of the heaviest common subsequence of a passage's terms and some words, as a share of the passage's weight."""
    row = np.zeros(len(words) + 1)
    for term, weight in zip(passage.terms, passage.weights):
        step = row.copy()
        step[1:] = np.maximum(row[1:], np.where(words == term, row[:-1] + weight, 0))
        row = np.maximum.accumulate(step)
    return float(row[-1] / passage.weights.sum())


# Best cosine and its window by text, passage and neighbourhood.
Candidates = dict[tuple[int, int, int], tuple[float, int]]


def _latent(hashes: np.ndarray, owner: np.ndarray, n: int, where: Block) -> Candidates:
    """Windows and passages whose cosine in a latent space reaches the limit."""
    weight = where.rarity[slot(hashes)]
    at = np.minimum(np.searchsorted(where.known, hashes), len(where.known) - 1)
    at = np.where(where.known[at] == hashes, at, len(where.known))
    mass = np.concatenate(([0.0], np.cumsum(weight.astype(np.float64) ** 2)))
    windows = {w: _windows(owner, n, w) for w in {WINDOW, *(s.width for s in where.spaces)}}
    best: Candidates = {}
    for space in where.spaces:
        row = space.row[at]
        held = np.where(row < len(space.peak) - 1, weight, 0).astype(np.float64)
        shared = np.concatenate(([0.0], np.cumsum(held**2)))
        most = np.concatenate(([0.0], np.cumsum(held * space.peak[row])))
        for width in sorted({space.width, WINDOW}):
            first, last = windows[width]
            whole = mass[last] - mass[first]
            # a folded window is no longer than its known part, and no product with a passage larger than that of the peaks
            able = shared[last] - shared[first] >= IN_SPACE**2 * whole
            able &= most[last] - most[first] >= COSINE * IN_SPACE * np.sqrt(whole) - 1e-3
            able = np.flatnonzero(able)
            for lo in range(0, len(able), 128):
                part = able[lo : lo + 128]
                spots = first[part][:, None] + np.arange(width)
                inside = spots < last[part][:, None]
                spots = np.minimum(spots, len(hashes) - 1)
                factors = np.where(inside, weight[spots], 0)[:, None, :]
                folded = (factors @ space.basis[np.where(inside, row[spots], -1)])[:, 0]
                length = np.linalg.norm(folded, axis=1)
                cosine = folded @ space.passages.T / np.maximum(length, 1e-9)[:, None]
                cosine[length < IN_SPACE * np.sqrt(whole[part])] = 0
                for i, j in zip(*np.nonzero(cosine >= COSINE)):
                    window = int(first[part[i]])
                    # Neighbouring windows of one match are checked once, at the best of them.
                    key = (int(owner[window]), int(space.number[j]), window // space.width)
                    if cosine[i, j] > best.get(key, (0.0, 0))[0]:
                        best[key] = (float(cosine[i, j]), window)
    return best


def _around(hashes: np.ndarray, begin: np.ndarray, text: int, at: int, reach: int) -> np.ndarray:
    return hashes[max(begin[text], at - reach) : min(begin[text + 1], at + reach)]


def _overlapping(hashes: np.ndarray, owner: np.ndarray, begin: np.ndarray, where: Block) -> Candidates:
    """Places around the rarest terms of a passage that hold enough of the passage's weight."""
    best: Candidates = {}
    place = np.minimum(np.searchsorted(where.anchors, hashes), len(where.anchors) - 1)
    for at in np.flatnonzero(where.anchors[place] == hashes).tolist():
        text = int(owner[at])
        for number in where.anchored[place[at]]:
            passage = where.passages[number]
            found = np.isin(passage.terms, _around(hashes, begin, text, at, len(passage.terms)))
            if passage.weights[found].sum() >= OVERLAP * passage.weights.sum():
                best[text, number, -at - 1] = (0.0, at)
    return best


def find(hashes: np.ndarray, owner: np.ndarray, n: int, where: Block) -> list[tuple[int, int, float, float, int]]:
    """Matches in one piece: text number, item position, cosine, share of the subsequence, first term of the place.

    The cosine is that of the latent space, or 0 for a place that only the overlap of terms has found.
    """
    if len(hashes) == 0:
        return []
    begin = np.searchsorted(owner, np.arange(n + 1))
    found: dict[tuple[int, int], tuple[float, float, int]] = {}
    candidates = _overlapping(hashes, owner, begin, where) | _latent(hashes, owner, n, where)
    for (text, number, _), (cosine, at) in candidates.items():
        passage = where.passages[number]
        words = _around(hashes, begin, text, at, passage.reach)
        if len(passage.answer & set(words.tolist())) < ANSWER_SHARE * len(passage.answer):
            continue
        share = subsequence_share(passage, words)
        key = text, passage.item
        if share >= LCS_SHARE and (share, cosine) > found.get(key, (0.0, 0.0, 0))[1::-1]:
            found[key] = (cosine, share, int(at - begin[text]))
    return [(text, number, *rest) for (text, number), rest in sorted(found.items())]


def _prepared(documents: DataFrame, benchmark: DataFrame) -> Iterator[Block]:
    spark = documents.sparkSession
    prepare(spark)
    if not benchmark.take(1):
        return
    idf = rarity(documents)
    for items in _blocks(benchmark, idf):
        yield block(spark, items, idf)


MATCH = "doc_id long, item_id long, cosine double, lcs_share double, first_term long, digest long"


def _matcher(where: Block) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, hashes, owner in _pieces(batches):
            if found := find(hashes, owner, piece.num_rows, where):
                t, number, cosine, share, window = zip(*found)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": piece.column("doc_id").take(pa.array(t)),
                    "item_id": pa.array([where.items[k] for k in number], pa.int64()),
                    "cosine": cosine, "lcs_share": share, "first_term": pa.array(window, pa.int64()),
                    "digest": piece.column("digest").take(pa.array(t)),
                })

    return run


def _found(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The matches, with a digest of the text."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("digest"))
    found = documents.sparkSession.createDataFrame([], MATCH)
    for where in _prepared(documents, benchmark):
        found = found.unionByName(rows.mapInArrow(_matcher(where), MATCH))
    return found


def matches(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each document and benchmark item that it contains, whole, in part or paraphrased."""
    return _found(documents, benchmark).drop("digest")


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that contain no benchmark item, with all their columns.

    The rows that match, few against the documents, are written out, so that Spark knows their size when it joins.
    """
    leaks = spool(
        _found(documents, benchmark).select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest")).distinct(), "leaks"
    )
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__digest"))
    return documents.join(leaks, same, "left_anti")
