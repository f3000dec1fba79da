"""Quality rules: a few counts with fixed limits, then a hashed n-gram log-likelihood ratio per document.

The ratio compares two multinomials over hashed byte n-grams: a trusted target, learned from documents labelled
good, and the raw corpus, learned from every document. The score of a document is the mean over its n-grams of
log(p_target / p_raw). The limit is a low quantile of the scores of trusted documents.

All trusted labels are used: in the order of the hashes of their ids, every second one serves the target and the others
the limit, since documents that made the target score higher than equally good ones that did not. The raw corpus and the
scores cover every n-gram of every document. Trusted documents are found by a join and written out once, the limit is an
exact quantile of a distributed sort. Everything is a function of the data only.

Defined cases: a null text is empty and fails the base rules; without trusted documents there is no ratio, every
score is 0 and the base rules decide alone; a repeated label counts once; labels without an id or for unknown
documents are ignored; where no trusted document serves the limit, those that serve the target set it too, and where none
of them passes the base rules it is 0; very long texts are counted whole; equal scores are treated alike; no rows give no
rows; extra columns are ignored by ``judge`` and kept by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pingloom.llm import text as T
from pingloom.llm.frames import hashed_sums, numbered, prepare, quantiles, tidied
from pingloom.session import spool

SLOTS = 1 << 16
WIDTH = 4
# The limit lies below this quantile of trusted scores by a share of its distance from the median.
QUANTILE = 0.0005
MARGIN = 0.25
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
VERDICT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, score double, kept boolean"
)


@dataclass(frozen=True)
class Model:
    """Log ratio of each slot, and the least score of a document that is kept."""

    ratios: np.ndarray
    limit: float


def _grams(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slot and text number of every run of ``WIDTH`` bytes inside a text."""
    slots = (T.window_hashes(T.prefix_hashes(raw), WIDTH) >> np.uint64(48)).astype(np.int64)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))[: len(slots)]
    inside = np.arange(len(slots)) + WIDTH <= at[1:][owner]
    return slots[inside], owner[inside]


def base_counts(raw: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of the fixed rules for each text."""
    n = len(at) - 1
    first, last, owner = T.words(raw, at)
    n_words = T.counts(owner, n)
    points = T.points(raw)
    marks = np.concatenate(([0], np.cumsum(_SYMBOL[raw])))

    window, whose = T.shingles(T.span_hashes(raw, first, last), owner, n, 3)
    full = n_words[whose] >= 3
    window, whose = window[full], whose[full]
    order = np.lexsort((window, whose))
    same = (window[order][1:] == window[order][:-1]) & (whose[order][1:] == whose[order][:-1])
    again = np.zeros(len(order), dtype=bool)
    again[order] = np.concatenate((same, [False]))[: len(order)] | np.concatenate(([False], same))[: len(order)]
    begins = np.concatenate(([0], np.cumsum(n_words)))[:-1]
    # Windows stand in the order of their first words; a text of m words has m - 2 of them.
    per = np.maximum(n_words - 2, 0)
    at_word = np.arange(len(window)) - np.concatenate(([0], np.cumsum(per)))[:-1][whose] + begins[whose]
    covered = np.zeros(len(first) + 3, dtype=bool)
    for k in range(3):
        covered[at_word[again] + k] = True

    breaks = np.flatnonzero(raw == 10)
    line_first = np.sort(np.concatenate((at[:-1], breaks + 1)))
    line_last = np.sort(np.concatenate((breaks, at[1:])))
    line_owner = np.searchsorted(at[1:], line_last, "left")
    # Empty texts give lines without a word, which do not count, so their owner does not matter.
    spoken = np.searchsorted(first, line_last, "left") > np.searchsorted(first, line_first, "left")
    lines, line_owner = T.span_hashes(raw, line_first[spoken], line_last[spoken]), line_owner[spoken]
    _, kinds = T.distinct(lines, line_owner)
    return {
        "n_words": n_words,
        "word_chars": T.counts(owner, n, points[last] - points[first]),
        "n_symbols": marks[at[1:]] - marks[at[:-1]],
        "n_dup_lines": T.counts(line_owner, n) - T.counts(kinds, n),
        "n_repeat_words": T.counts(owner, n, covered[: len(first)]),
    }


def base_failed(found: dict[str, np.ndarray]) -> np.ndarray:
    return (found["n_words"] < MIN_WORDS) | (100 * found["n_repeat_words"] > MAX_REPEATED_PERCENT * found["n_words"])


def scores(raw: np.ndarray, at: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """Mean log ratio of the n-grams of each text; 0 for a text without one."""
    slots, owner = _grams(raw, at)
    n = T.counts(owner, len(at) - 1)
    return np.bincount(owner, ratios[slots], len(at) - 1) / np.maximum(n, 1)


def _trusted(labels: DataFrame) -> DataFrame:
    """Every trusted id once, and whether it serves the limit and not the target."""
    ids = (
        labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull())
        .select(F.col("doc_id").cast("long").alias("doc_id")).distinct().withColumn("hash", F.xxhash64("doc_id"))
    )
    return numbered(ids, "hash", "doc_id").select("doc_id", (F.col("place") % 2 == 1).alias("held_out"))


def _sample(labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The ids for the target and those for the limit, to look at where labels are few; fitting leaves them where they are."""
    ids = _trusted(labels).toArrow()
    held_out = ids["held_out"].to_numpy()
    return np.sort(ids["doc_id"].to_numpy()[~held_out]), np.sort(ids["doc_id"].to_numpy()[held_out])


def _gram_counts(texts: DataFrame) -> np.ndarray:
    """How often each slot occurs in all texts."""

    @tidied
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for piece in T.pieces(batch):
                found += np.bincount(_grams(*T.view(piece.column("text")))[0], minlength=SLOTS)
        seen = np.flatnonzero(found)
        yield pa.RecordBatch.from_pydict({"slot": seen, "n": found[seen]})

    return hashed_sums(texts.select("text").mapInArrow(count, "slot long, n long"), SLOTS, "n")["n"]


def fit(documents: DataFrame, labels: DataFrame) -> Model:
    """Learn both multinomials and the limit; two reads of the documents, the first for the trusted ones."""
    prepare(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    trusted = spool(rows.join(_trusted(labels), "doc_id").select("text", "held_out"), "trusted")
    target = _gram_counts(trusted.filter(~F.col("held_out")))
    if target.sum() == 0:
        return Model(np.zeros(SLOTS), 0.0)

    def log_share(n: np.ndarray) -> np.ndarray:
        return np.log((n + 0.5) / (n.sum() + 0.5 * SLOTS))

    ratios = log_share(target) - log_share(_gram_counts(rows))

    @tidied
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.pieces(batch):
                raw, at = T.view(piece.column("text"))
                good = ~base_failed(base_counts(raw, at))
                yield pa.RecordBatch.from_pydict({"score": scores(raw, at, ratios)[good]})

    for role in (F.col("held_out"), ~F.col("held_out")):
        found = quantiles(trusted.filter(role).select("text").mapInArrow(score, "score double"), "score", QUANTILE, 0.5)
        if found:
            low, middle = found
            return Model(ratios, low - MARGIN * (middle - low))
    return Model(ratios, 0.0)


def _verdict(piece: pa.RecordBatch, model: Model) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    raw, at = T.view(piece.column("text"))
    found = base_counts(raw, at)
    failed, score = base_failed(found), scores(raw, at, model.ratios)
    return found, failed, score, ~failed & (score >= model.limit)


def judge(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document with its counts, its score and the verdict ``kept``."""
    model = fit(documents, labels)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.pieces(batch):
                found, failed, score, kept = _verdict(piece, model)
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": piece.column("doc_id"), **found, "base_failed": failed, "score": score, "kept": kept}
                )

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, VERDICT)


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    model = fit(documents, labels)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.pieces(batch):
                yield piece.filter(pa.array(_verdict(piece, model)[3]))

    return documents.mapInArrow(run, documents.schema)
