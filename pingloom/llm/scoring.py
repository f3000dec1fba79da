"""Language-model scores by a weighted backoff automaton.

The model is an n-gram model of the training documents (those whose crc32 of the id, modulo ``FOLDS``, is not
``HELD_OUT``), smoothed order by order: P(w | c) = (n(c w) + mass * P(w | c without its first token)) / (n(c) + mass), down to
single tokens with (n(w) + 0.5) / (N + 0.5 * (V + 1)). As an automaton, an n-gram shorter than ``order`` that occurs in
training is a state, the start of a text is one, and the empty context is the root. Every n-gram is an arc from the state of
its first tokens, labelled with its last and weighted with its smoothed log10 probability; it leads to the state of the
longest context it ends with. A token without an arc takes the failure arc to the state without the first token, weighted
with log10(mass / (n(c) + mass)), until an arc is found; the root has one for every token, known or not. One traversal from
left to right carries the state of each text and adds up the weights.

Documents stand in blocks, and a block builds the part of the automaton that its own texts can reach, so no task holds
the whole. Blocks send their distinct n-grams with their counts to buckets of hashes, which add them up and tell each
block the sums that differ from its own. An n-gram of three tokens or more is only sent if both n-grams of one token less
in it are known to occur elsewhere, since it cannot occur elsewhere otherwise; this is exact. The model grows with
the corpus, as does the number of blocks and buckets.

Tokens are compared by 64-bit hashes, longer n-grams by their ``GRAM_BITS`` upper bits.

Defined cases: a null or empty text is its end alone; a null ``doc_id`` is in training; very long texts are handled whole, in
segments that each start with the state the one before ends with; repeated rows count as often as they stand; extra columns
are ignored; without training documents every token is unknown; no rows give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pingloom.llm import text as T
from pingloom.llm.exchange import bucket_runs, is_among, pack, pack_sorted, unpack, unpack_sorted
from pingloom.llm.frames import block_count, block_of, dealt, prepare, release

ORDER = 3
MASS = 100.0
FOLDS, HELD_OUT = 5, 1
BLOCK_BYTES = 8 << 20
GRAM_BITS = 52
# Tokens of a segment; the segments of a block are walked side by side.
SEGMENT = 512
_LOW_BITS = np.uint64((1 << (64 - GRAM_BITS)) - 1)
_START, _END = T.mix(np.array([1, 2], np.uint64))
SCORE = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


class Grams:
    """The n-grams of the texts of a block.

    The tokens of all texts stand in a row, ``rank`` counts them within a text. ``kinds[k]`` are the distinct keys of the
    (k + 1)-grams, ``which[k]`` is for each token the place there of the one that ends with it, or of any key where the text
    has too few tokens before: an n-gram goes back to the start of the text at most, which counts as one token.
    """

    def __init__(self, texts: pa.Array, training: np.ndarray, order: int):
        self.n = len(texts)
        hashes, owner = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        done = 0
        for piece in T.pieces(pa.RecordBatch.from_arrays([texts], ["text"])):
            raw, at = T.view(piece.column("text"))
            raw = T.LOWER[raw]
            first, last, own = T.words(raw, at)
            hashes.append(T.span_hashes(raw, first, last))
            owner.append(own + done)
            done += piece.num_rows
        word, per = np.concatenate(hashes), T.counts(np.concatenate(owner), self.n)
        self.size = per + 1
        self.begin = np.cumsum(self.size) - self.size
        self.owner = np.repeat(np.arange(self.n, dtype=np.int32), self.size)
        tokens = np.empty(len(self.owner), np.uint64)
        inner = np.ones(len(tokens), dtype=bool)
        inner[self.begin + per] = False
        tokens[inner], tokens[self.begin + per] = word, _END
        self.rank = (np.arange(len(tokens)) - self.begin[self.owner]).astype(np.int32)
        trains = training[self.owner]
        self.kinds, self.which, self.example, self.counts = [], [], [], []
        key = tokens
        for k in range(order):
            if k:
                before = np.empty_like(key)
                before[1:] = key[:-1]
                before[self.rank == 0] = _START
                key = T.mix(before * np.uint64(T.BASE) + tokens + np.uint64(k)) & ~_LOW_BITS
            kinds, which = np.unique(key, return_inverse=True)
            example = np.empty(len(kinds), np.int32)
            example[which] = np.arange(len(which), dtype=np.int32)
            self.kinds.append(kinds)
            self.which.append(which.astype(np.int32))
            self.example.append(example)
            counted = trains & (self.rank >= k - 1)
            self.counts.append(np.bincount(which[counted], minlength=len(kinds)).astype(np.int64))

    def before(self, k: int) -> np.ndarray:
        """For each distinct (k + 1)-gram the place of its context, the k-gram before its last token; -1 for the start."""
        at = self.example[k]
        return np.where(self.rank[at] == 0, -1, self.which[k - 1][np.maximum(at - 1, 0)])

    def whole(self, k: int) -> np.ndarray:
        """Which of the distinct (k + 1)-grams have all their tokens, the start of the text counting as one."""
        return self.rank[self.example[k]] >= k - 1


SENT = pa.schema([
    ("bucket", pa.int32()), ("block", pa.int32()), ("gram", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()),
    ("n_train", pa.int64()), ("n_kinds", pa.int64()),
])
SENT_SQL = "bucket int, block int, gram int, keys binary, counts binary, n_train long, n_kinds long"


def _rows() -> dict[str, list]:
    return {name: [] for name in SENT.names}


def _put(rows: dict[str, list], *values) -> None:
    for name, value in zip(rows, values):
        rows[name].append(value)


def _send_gram(rows: dict[str, list], block: int, gram: int, keys: np.ndarray, counts: np.ndarray, n_buckets: int) -> None:
    for bucket, own in bucket_runs(keys, n_buckets):
        _put(rows, bucket, block, gram, pack_sorted(keys[own]), pack(counts[own].astype(np.uint32)), None, None)


def _grams(table: pa.Table, order: int) -> Grams:
    return Grams(table["text"].combine_chunks(), table["training"].to_numpy(), order)


def _send_first(order: int, n_buckets: int):
    """Single tokens and pairs of a block."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        grams, rows = _grams(table, min(order, 2)), _rows()
        for k in range(min(order, 2)):
            some = grams.whole(k)
            _send_gram(rows, key[0].as_py(), k, grams.kinds[k][some], grams.counts[k][some], n_buckets)
        return pa.table(rows, SENT)

    return run


def _told_counts(grams: Grams, told: pa.Table) -> list[np.ndarray]:
    """Fill in the sums a block was told, and say for each order which n-grams were among them."""
    elsewhere = [np.zeros(len(kinds), dtype=bool) for kinds in grams.kinds]
    for gram, stored, counted in zip(told["gram"].to_pylist(), told["keys"], told["counts"]):
        if gram < len(grams.kinds):
            at = np.searchsorted(grams.kinds[gram], unpack_sorted(stored.as_py()))
            grams.counts[gram][at] = unpack(counted.as_py(), np.int64)
            elsewhere[gram][at] = True
    return elsewhere


def _send_longer(order: int, n_buckets: int):
    """The n-grams of three tokens and more that may occur elsewhere, from the pairs that do."""

    def run(key: tuple, documents: pa.Table, told: pa.Table) -> pa.Table:
        rows = _rows()
        if documents.num_rows == 0:
            return pa.table(rows, SENT)
        grams = _grams(documents, order)
        may = _told_counts(grams, told)[1]
        for k in range(2, order):
            context = grams.before(k)
            ending = grams.which[k - 1][grams.example[k]]
            may = grams.whole(k) & (context >= 0) & may[np.maximum(context, 0)] & may[ending]
            _send_gram(rows, key[0].as_py(), k, grams.kinds[k][may], grams.counts[k][may], n_buckets)
        return pa.table(rows, SENT)

    return run


def _add(table: pa.Table) -> pa.Table:
    """Add up the counts of each key, and tell every block the sums that differ from its own; and the totals of tokens.

    Of pairs, all that another block has too are told, which says what longer n-grams may occur elsewhere.
    """
    rows = _rows()
    gram_of, block_of_row = table["gram"].to_numpy(), table["block"].to_numpy()
    stored, counted = table["keys"], table["counts"]
    for gram in np.unique(gram_of):
        at = np.flatnonzero(gram_of == gram)
        keys = [unpack_sorted(stored[int(i)].as_py()) for i in at]
        counts = [unpack(counted[int(i)].as_py(), np.uint32).astype(np.int64) for i in at]
        kinds, which, holders = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        sums = np.bincount(which, np.concatenate(counts), len(kinds)).astype(np.int64)
        if gram == 0:
            _put(rows, None, None, None, None, None, int(sums.sum()), int((sums > 0).sum()))
        begin = 0
        for i, own, known in zip(at, keys, counts):
            place = which[begin : begin + len(own)]
            begin += len(own)
            new = holders[place] > 1 if gram == 1 else sums[place] != known
            if new.any():
                _put(rows, None, int(block_of_row[i]), int(gram), pack_sorted(own[new]), pack(sums[place[new]]), None, None)
    return pa.table(rows, SENT)


class Automaton:
    """States and arcs that the texts of a block can reach.

    State 0 is the root, 1 the start of a text; then come the n-grams shorter than the order, those of one length in a row
    from ``offset[length]`` on. ``arc`` and ``target`` of a length are weight and state of its n-grams; an n-gram that does not
    occur in training has no arc, marked with a target of -1.
    """

    def __init__(self, grams: Grams, n_train: int, kinds: int, mass: float):
        order = len(grams.kinds)
        self.offset = [0, 2, *(2 + np.cumsum([len(k) for k in grams.kinds[: order - 1]])).tolist()]
        n_states = self.offset[order]
        self.length = np.ones(n_states, np.int8)
        self.failure = np.zeros(n_states, np.int32)
        seen = np.zeros(n_states, np.int64)
        self.length[0] = 0
        # As many contexts share the start as there are training documents, that is, ends.
        end = np.searchsorted(grams.kinds[0], _END)
        seen[1] = grams.counts[0][end] if end < len(grams.kinds[0]) and grams.kinds[0][end] == _END else 0
        for k in range(order - 1):
            own = slice(self.offset[k + 1], self.offset[k + 1] + len(grams.kinds[k]))
            self.length[own], seen[own] = k + 1, grams.counts[k]
            if k:
                self.failure[own] = self._state(k, grams.which[k - 1][grams.example[k]])
        self.failure_weight = np.log10(mass / (seen + mass))
        chance = (grams.counts[0] + 0.5) / (n_train + 0.5 * (kinds + 1))
        self.arc, self.target = [np.log10(chance)], [np.where(grams.counts[0] > 0, self._state(1, np.arange(len(chance))), 0)]
        if order == 1:
            self.target = [np.zeros(len(chance), np.int64)]
        for k in range(1, order):
            ending = grams.which[k - 1][grams.example[k]]
            context = grams.before(k)
            state = np.where(context < 0, 1, self._state(k, np.maximum(context, 0)))
            chance = (grams.counts[k] + mass * chance[ending]) / (seen[state] + mass)
            self.arc.append(np.log10(chance))
            reached = self._state(k + 1, np.arange(len(chance))) if k + 1 < order else self._state(k, ending)
            self.target.append(np.where(grams.counts[k] > 0, reached, -1))

    def _state(self, length: int, place: np.ndarray) -> np.ndarray:
        return self.offset[length] + place

    def walk(self, grams: Grams) -> np.ndarray:
        """Log10 weight of all steps of each text."""
        order = len(grams.kinds)
        # Long texts are cut; a segment first repeats the last steps of the one before, which end in its state.
        cuts = -(-grams.size // SEGMENT)
        text = np.repeat(np.arange(grams.n), cuts)
        number = np.arange(len(text)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        count_from = number * SEGMENT
        rank = np.maximum(count_from - (order - 1), 0)
        stop = np.minimum(count_from + SEGMENT, grams.size[text])
        # The longest first, so that those still under way stand in front.
        by_length = np.argsort(rank - stop, kind="stable")
        text, count_from, rank, stop = text[by_length], count_from[by_length], rank[by_length], stop[by_length]
        position, skipped, left = grams.begin[text] + rank, count_from - rank, stop - rank
        state = np.where(rank == 0, 1, 0) if order > 1 else np.zeros(len(text), np.int64)
        total = np.zeros(len(text))
        active = np.searchsorted(-left, -np.arange(1, int(left.max(initial=0)) + 1), "right")
        for step, n in enumerate(active.tolist()):
            at, now = position[:n] + step, state[:n]
            weight = np.zeros(n)
            arrived = np.zeros(n, dtype=bool)
            for k in range(order - 1, -1, -1):
                trying = np.flatnonzero(~arrived & (self.length[now] == k))
                gram = grams.which[k][at[trying]]
                target = self.target[k][gram]
                found = target >= 0
                took, failed = trying[found], trying[~found]
                weight[took] += self.arc[k][gram[found]]
                now[took] = target[found]
                arrived[took] = True
                weight[failed] += self.failure_weight[now[failed]]
                now[failed] = self.failure[now[failed]]
            total[:n] += np.where(step >= skipped[:n], weight, 0)
        return np.bincount(text, total, grams.n)


SCORED = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
    ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
])


def _score(order: int, mass: float):
    def run(documents: pa.Table, told: pa.Table) -> pa.Table:
        if documents.num_rows == 0:
            return pa.table({f.name: pa.array([], f.type) for f in SCORED}, SCORED)
        grams = _grams(documents, order)
        _told_counts(grams, told)
        n_train, kinds = (documents[c][0].as_py() or 0 for c in ("n_train", "n_kinds"))
        model = Automaton(grams, n_train, kinds, mass)
        known = grams.counts[0] > 0
        done = pa.table({
            "doc_id": documents["doc_id"],
            "held_out": pa.array(~documents["training"].to_numpy()),
            "n_tokens": grams.size,
            "n_known": T.counts(grams.owner, grams.n, known[grams.which[0]]),
            "train_tokens": np.full(grams.n, n_train),
            "base_score": np.bincount(grams.owner, model.arc[0][grams.which[0]], grams.n),
            "score": model.walk(grams),
        }, SCORED)
        del grams, model
        release()
        return done

    return run


def score(documents: DataFrame, order: int = ORDER, mass: float = MASS) -> DataFrame:
    """Log10 probability of every document's text under the model of the training documents."""
    prepare(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = block_count(rows, BLOCK_BYTES)
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))
    # By id and text, so that a hot id is spread; all uses below share this one shuffle.
    blocks = dealt(
        rows.select(
            block_of(n, "doc_id", "text").alias("block"), "doc_id", "text",
            F.coalesce(remainder != HELD_OUT, F.lit(True)).alias("training"),
        ),
        "block", n,
    )

    def added(sent: DataFrame) -> DataFrame:
        return dealt(sent, "bucket", n).groupBy("bucket").applyInArrow(_add, SENT_SQL).drop("bucket")

    first = added(blocks.groupBy("block").applyInArrow(_send_first(order, n), SENT_SQL))
    totals = first.filter("block IS NULL")
    told = dealt(first.filter("block IS NOT NULL").drop("n_train", "n_kinds"), "block", n)
    if order > 2:
        longer = blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_send_longer(order, n), SENT_SQL)
        told = told.unionByName(dealt(added(longer).filter("block IS NOT NULL").drop("n_train", "n_kinds"), "block", n))
    both = totals.agg(F.struct(F.sum("n_train").alias("n_train"), F.sum("n_kinds").alias("n_kinds"))).scalar()
    known = blocks.withColumn("totals", both).select("block", "doc_id", "text", "training", "totals.*")
    return known.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_score(order, mass), SCORE)
