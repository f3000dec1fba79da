"""Spelling variants grouped with PartEnum signatures.

Words are counted over the whole corpus; those long and frequent enough are the vocabulary. Two of them are near if one
inserted, deleted or replaced code point makes one the other. A word is taken as a binary vector: the members of its letter
multiset, that is (letter, 1), (letter, 2) and so on up to how often it has the letter. A replaced letter changes two members, a
letter more or less changes one, so near words have vectors of Hamming distance at most two, and more exactly two at equal
length and one at lengths that differ by one.

PartEnum signatures find all such pairs by equi-joins. The members are dealt to ``PARTS`` parts by a hash; a signature is a
set of all but ``CHANGED`` parts together with what the word has in them. Whatever members differ, some set leaves
out their parts, so near words share a signature. The length is part of the signature. Pairs that meet are verified by
their edit distance inside the join, which gives near words only.

A signature that more than ``CROWDED`` words share, as where words are made of few letters, is left out and its words are
joined by what is left of them without one code point: a string is left by at most (length + 1) * (size of the alphabet)
words, a bound that does not grow with the vocabulary. No pair is lost: it meets in a signature that is not crowded or
both its words are in that second join.

A word's form is its most frequent near word, if that is ``FACTOR`` times as frequent or more; counts grow by that factor from
form to form, so following forms ends, and doubling the steps takes a handful of joins whatever the corpus.

Defined cases: a null or empty text has no words; very long texts and words are handled whole; repeated rows and rows of
equal id count every time; a null ``doc_id`` counts as an empty id in the hash; of equally frequent near words the smallest
in code-point order is the form; extra columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pingloom.llm import text as T
from pingloom.llm.frames import prepare, tidied
from pingloom.session import spool

LETTERS = "[A-Za-zÀ-ÿ]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DROPPED_EVERY = 199
LEAST_LENGTH, LEAST_COUNT = 6, 5
FACTOR = 5
# Members that differ between near words, and parts of the signatures, for words of one length and of two.
EQUAL, SHORTER, LONGER = 0, 1, 2
CHANGED = {EQUAL: 2, SHORTER: 1}
PARTS = {EQUAL: 6, SHORTER: 3}
CROWDED = 256
BATCH_WORDS = 20_000


def vocabulary(documents: DataFrame) -> DataFrame:
    """``word`` and ``n``: what the runs of letters give, by the rule that deletes a code point, and how often."""
    low = F.translate("text", CAPITALS, SMALL)
    runs = documents.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
        F.explode(F.regexp_extract_all(low, F.lit(LETTERS), F.lit(0))).alias("run"),
    )
    hashed = runs.select("run", F.crc32(F.concat_ws(":", "doc", "run").cast("binary")).alias("h"))
    place = F.pmod("h", F.length("run")).cast("int")
    without = F.concat(F.col("run").substr(F.lit(1), place), F.col("run").substr(place + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % DROPPED_EVERY == 0, without).otherwise(F.col("run")).alias("word"))
    counted = words.filter(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= LEAST_COUNT)


def _codes(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all words in a row, the word number of each, and the length of each word."""
    raw, at = T.view(words)
    codes = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.uint64)
    cuts = T.points(raw)[at]
    return codes, np.repeat(np.arange(len(words)), np.diff(cuts)), np.diff(cuts)


def _members(codes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The members of every word's multiset, as a hash of letter and occurrence, and the word number of each."""
    order = np.lexsort((codes, owner))
    codes, owner = codes[order], owner[order]
    new = np.ones(len(codes), dtype=bool)
    new[1:] = (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(new)
    times = np.arange(len(codes)) - np.repeat(starts, np.diff(np.append(starts, len(codes))))
    return T.mix(codes * np.uint64(1 << 32) + times.astype(np.uint64)), owner


def signatures(words: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Pairs of role and one key per word. Words of one length meet as ``EQUAL``, others as ``SHORTER`` and ``LONGER``."""
    codes, owner, length = _codes(words)
    members, whose = _members(codes, owner)
    for kind in (EQUAL, SHORTER):
        parts = PARTS[kind]
        part = (T.mix(members + np.uint64(kind + 1)) % np.uint64(parts)).astype(np.int64)
        held = np.zeros((len(words), parts), np.uint64)
        np.add.at(held, (whose, part), members)
        for number, chosen in enumerate(combinations(range(parts), parts - CHANGED[kind])):
            key = np.full(len(words), (kind << 8) + number + 1, np.uint64)
            for p in chosen:
                key = T.mix(key * np.uint64(T.BASE) + held[:, p])
            for role, size in ((EQUAL, length),) if kind == EQUAL else ((SHORTER, length), (LONGER, length - 1)):
                yield role, T.mix(key + size.astype(np.uint64))


def left_overs(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word without one of its code points, once each, and its word number."""
    codes, owner, length = _codes(words)
    begin = np.cumsum(length) - length
    place = np.arange(len(codes)) - begin[owner]
    number = T.multipliers(int(length.max(initial=0)) + 1)
    # Code points before the deleted one count at their place, those behind it at the place before.
    before, behind = np.zeros((2, len(codes) + 1), np.uint64)
    np.cumsum((codes + np.uint64(1)) * number[place], out=before[1:])
    np.cumsum((codes + np.uint64(1)) * number[np.maximum(place - 1, 0)], out=behind[1:])
    at, end = np.arange(len(codes)), (begin + length)[owner]
    left = before[at] - before[begin[owner]] + behind[end] - behind[at + 1]
    return T.distinct(T.mix(left + (length[owner] - 1).astype(np.uint64)), owner)


def _whole(words: pa.Array) -> np.ndarray:
    """Hash of each word, comparable with those of ``left_overs``."""
    codes, owner, length = _codes(words)
    place = np.arange(len(codes)) - (np.cumsum(length) - length)[owner]
    sums = np.zeros(len(words), np.uint64)
    np.add.at(sums, owner, (codes + np.uint64(1)) * T.multipliers(int(length.max(initial=0)) + 1)[place])
    return T.mix(sums + length.astype(np.uint64))


KEYED = "word string, n bigint, role int, key bigint"


def _keyed(words: DataFrame, keys) -> DataFrame:
    """Rows of word, count, role and key; ``keys`` gives role, key and word number of some words."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH_WORDS):
                for part in T.pieces(batch.slice(lo, BATCH_WORDS), "word"):
                    for role, key, whose in keys(part.column("word")):
                        own = part.take(pa.array(whose))
                        yield pa.RecordBatch.from_pydict({
                            "word": own.column("word"), "n": own.column("n"),
                            "role": np.full(len(key), role, np.int32), "key": key.view(np.int64),
                        })

    return words.select("word", "n").mapInArrow(run, KEYED)


def _by_signature(words: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for role, key in signatures(words):
        yield role, key, np.arange(len(words))


def _by_left_over(words: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    key, whose = left_overs(words)
    yield EQUAL, key, whose
    yield LONGER, key, whose
    yield SHORTER, _whole(words), np.arange(len(words))


def _met(keyed: DataFrame) -> DataFrame:
    """Verified pairs of words with a key in common, as ``word_a, n_a, word_b, n_b``; some come more than once."""
    a = keyed.filter(F.col("role") != LONGER).select(F.col("word").alias("word_a"), F.col("n").alias("n_a"), "key", F.col("role").alias("role_a"))
    b = keyed.filter(F.col("role") != SHORTER).select(F.col("word").alias("word_b"), F.col("n").alias("n_b"), "key", F.col("role").alias("role_b"))
    equal = (F.col("role_a") == EQUAL) & (F.col("role_b") == EQUAL) & (F.col("word_a") < F.col("word_b"))
    other = (F.col("role_a") == SHORTER) & (F.col("role_b") == LONGER)
    near = F.levenshtein("word_a", "word_b", 1) == 1
    return a.join(b, "key").filter((equal | other) & near).select("word_a", "n_a", "word_b", "n_b")


def near_pairs(words: DataFrame) -> DataFrame:
    """All pairs of near words of a vocabulary (``word``, ``n``), each once."""
    keyed = spool(_keyed(words, _by_signature), "signatures")
    crowded = spool(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("words")).filter(F.col("words") > CROWDED), "crowded")
    many = keyed.join(crowded.select("key"), "key", "left_semi").select("word", "n").distinct()
    pairs = _met(keyed.join(crowded.select("key"), "key", "left_anti")).unionByName(_met(_keyed(many, _by_left_over)))
    return pairs.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` from ``word`` and ``form``: each step doubles how far a word has followed its forms."""
    now = spool(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("step"), F.col("root").alias("next"))
        done = spool(
            now.join(further, now["root"] == further["step"], "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "roots",
        )
        now = done.drop("moved")
        if not done.filter("moved").take(1):
            return now


def group(documents: DataFrame) -> DataFrame:
    """Every word of the vocabulary with its form, root, counts and number of near words."""
    prepare(documents.sparkSession)
    words = spool(vocabulary(documents), "words")
    pairs = spool(near_pairs(words), "near")
    swapped = pairs.select(
        F.col("word_b").alias("word_a"), F.col("n_b").alias("n_a"), F.col("word_a").alias("word_b"), F.col("n_a").alias("n_b")
    )
    best = F.min(F.struct((-F.col("n_b")).alias("minus"), F.col("word_b").alias("word")))
    near = pairs.unionByName(swapped).groupBy(F.col("word_a").alias("word"), F.col("n_a").alias("n")).agg(
        F.count(F.lit(1)).alias("n_near"), best.alias("best")
    )
    enough = -F.col("best.minus") >= FACTOR * F.col("n")
    near = spool(
        near.select(
            "word", "n_near", F.when(enough, F.col("best.word")).alias("form"), F.when(enough, -F.col("best.minus")).alias("form_n")
        ),
        "forms",
    )
    last = roots(near.filter(F.col("form").isNotNull()))
    return words.join(near, "word", "left").join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n",
    )
