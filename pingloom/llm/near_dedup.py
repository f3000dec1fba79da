"""Near-duplicates by MinHash, with odd sketches to verify what the bands propose.

A document's set is that of its hashed word shingles; equal sets form a class and are handled once, by the smallest id.
Minima of the set under many hash functions are its samples. The first of them are cut into ``BANDS`` bands: sets that
agree in a band share a bucket. With 32 bands of 4, a pair of similarity 0.8 misses every bucket with probability 5e-8.
All ``SAMPLES`` are folded into an odd sketch, a bitmap of parities, whose XOR estimates the similarity of a pair from
192 bytes a side; pairs estimated below ``SURE``, more than four standard deviations under the limit, are dropped, all
others are confirmed on the full sets.

Buckets are never expanded into all pairs. Of the documents in any bucket it is counted how many of their shingles
another such document has at all, which bounds what they can share with anyone. First every member of a bucket is compared
with one leader, the member with the largest share of such shingles, and then with another from outside of the largest
component, which gathers groups of copies. Pairs inside a component are never looked at again; what is left are the members
outside of a bucket's largest component, against those of other components:

* in a bucket of at most ``SMALL`` members, pair by pair, as far as sizes, bound and sketches allow a link, each pair in the
  first bucket it shares;
* in a larger one, blocks of whole sets against blocks: all intersections of two blocks are counted at once, in one task of
  bounded size, and only links come out. So a group of thousands of copies that are similar to each other, but not enough,
  makes no rows of pairs; a member is sent to as many tasks as its bucket has blocks of ``BLOCK_SHINGLES``. The counting itself
  is quadratic in what two leaders have left of a bucket; for that part there is no exact way around it.

Every link is confirmed on full sets.

Defined cases: a null or empty text, or one without words, has no shingles and no links; very long texts are handled whole; a text with fewer words than a
shingle is one shingle; a null ``doc_id`` has no links, a null component and is kept; rows of equal id count as linked to
each other's classes; extra columns are ignored by ``groups`` and kept by ``keep_first``; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pingloom.llm import text as T
from pingloom.llm.components import components
from pingloom.llm.exchange import KEYS_SQL, is_among, key_rows, read_keys, shared_keys
from pingloom.llm.frames import block_count, block_of, dealt, prepare, tidied
from pingloom.session import spool

BANDS, ROWS = 32, 4
SAMPLES = 384
SKETCH_BITS = 1536
SURE = 0.69
# Members of a bucket that is expanded into pairs; shingles in a block of a larger one.
SMALL, BLOCK_SHINGLES = 64, 1 << 18
_RANDOM = np.random.default_rng(20240811)
_FACTORS = _RANDOM.integers(1, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RANDOM.integers(1, 1 << 63, SAMPLES, dtype=np.uint64)
SET = "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>, sketch array<long>"


def sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes and text numbers, sorted by text; ASCII capitals count as small letters."""
    raw, at = T.view(texts)
    raw = T.LOWER[raw]
    first, last, owner = T.words(raw, at)
    return T.distinct(*T.shingles(T.span_hashes(raw, first, last), owner, len(at) - 1, width))


def minima(hashes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """``SAMPLES`` minima of each set; the sets begin at ``begins`` and none is empty."""
    out = np.empty((len(begins), SAMPLES), np.uint64)
    for k in range(SAMPLES):
        out[:, k] = np.minimum.reduceat(hashes * _FACTORS[k] + _SHIFTS[k], begins)
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    keys = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(samples), 1))
    for k in range(ROWS):
        keys = T.mix(keys * np.uint64(T.BASE) + samples[:, k : BANDS * ROWS : ROWS])
    return keys


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps of the samples, as rows of 64-bit words."""
    bit = (T.mix(samples + _SHIFTS) % np.uint64(SKETCH_BITS)).astype(np.int64)
    cell = np.bincount((np.arange(len(samples))[:, None] * SKETCH_BITS + bit).ravel(), minlength=len(samples) * SKETCH_BITS)
    return np.packbits(cell.reshape(len(samples), SKETCH_BITS) & 1, axis=1).view(np.int64)


def describe(documents: DataFrame, width: int) -> DataFrame:
    """Size, digest, band keys and sketch of each document's set."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.pieces(batch):
                hashes, owner = sets(piece.column("text"), width)
                n = piece.num_rows
                size = T.counts(owner, n)
                full = np.flatnonzero(size)
                begins = np.searchsorted(owner, full)
                digests = np.zeros((2, n), np.uint64)
                bands, sketches = np.zeros((n, BANDS), np.int64), np.zeros((n, SKETCH_BITS // 64), np.int64)
                if len(full):
                    for k in range(2):
                        digests[k, full] = np.add.reduceat(T.mix(hashes ^ _SHIFTS[k]), begins)
                    samples = minima(hashes, begins)
                    bands[full], sketches[full] = band_keys(samples).view(np.int64), odd_sketches(samples)

                def lists(values: np.ndarray) -> pa.Array:
                    return pa.ListArray.from_arrays(
                        np.arange(0, values.size + 1, values.shape[1], dtype=np.int32), values.ravel()
                    )

                yield pa.RecordBatch.from_pydict({
                    "doc_id": piece.column("doc_id"), "n_shingles": size, "d1": digests[0].view(np.int64),
                    "d2": digests[1].view(np.int64), "bands": lists(bands), "sketch": lists(sketches),
                })

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SET)


def _may_link(percent: int) -> Column:
    """Whether the sizes, the shingles found elsewhere and the sketches of a pair allow a similarity of the limit."""
    sizes = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    bound = (100 + percent) * F.least("common_a", "common_b") >= percent * (F.col("n_a") + F.col("n_b"))
    differing = F.aggregate(
        F.zip_with("sketch_a", "sketch_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x
    )
    # With n bits of which c differ, the sample sets differ in about -n/2 ln(1 - 2c/n) members.
    free = 1 - 2 * differing / F.lit(float(SKETCH_BITS))
    members = -SKETCH_BITS / 2 * F.log(F.greatest(free, F.lit(1e-9)))
    return sizes & bound & (1 - members / (2 * SAMPLES) >= SURE)


def _sided(nodes: DataFrame, side: str, *more: str) -> DataFrame:
    return nodes.select(*[F.col(c).alias(f"{c}_{side}") for c in ("rep", "n", "common", "sketch", *more)])


def packed_sets(texts: DataFrame, width: int) -> DataFrame:
    """``doc_id`` and its sorted distinct shingle hashes as bytes."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.pieces(batch):
                hashes, owner = sets(piece.column("text"), width)
                at = 8 * np.searchsorted(owner, np.arange(piece.num_rows + 1))
                packed = pa.Array.from_buffers(
                    pa.binary(), piece.num_rows, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(hashes.tobytes())]
                )
                yield pa.RecordBatch.from_pydict({"doc_id": piece.column("doc_id"), "hashes": packed})

    return texts.mapInArrow(run, "doc_id long, hashes binary")


def unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all sets in a row, and the row number of each."""
    raw, at = T.view(column)
    return np.frombuffer(raw.tobytes(), np.uint64), np.repeat(np.arange(len(at) - 1), np.diff(at) // 8)


def _common(held: DataFrame) -> DataFrame:
    """``rep`` and ``common``: how many shingles of each document some other document of the table has."""
    n = block_count(held, column="hashes")
    blocks = dealt(held.select(block_of(n, "doc_id").alias("block"), "doc_id", "hashes"), "block", n).groupBy("block")

    def send(key: tuple, table: pa.Table) -> pa.Table:
        hashes, _ = unpacked(table["hashes"])
        kinds, times = np.unique(hashes, return_counts=True)
        return key_rows(key[0].as_py(), kinds, times > 1, n)

    def count(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        if table.num_rows == 0:
            return pa.table({"rep": pa.array([], pa.int64()), "common": pa.array([], pa.int64())})
        hashes, owner = unpacked(table["hashes"])
        return pa.table({"rep": table["doc_id"], "common": T.counts(owner, table.num_rows, is_among(hashes, read_keys(told)))})

    told = shared_keys(blocks.applyInArrow(send, KEYS_SQL), n)
    return blocks.cogroup(told.groupBy("block")).applyInArrow(count, "rep long, common long")


def _confirmed(held: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (``u``, ``v``) of documents whose full sets are similar enough."""
    both = (
        pairs.join(held.select(F.col("doc_id").alias("u"), F.col("hashes").alias("set_u")), "u")
        .join(held.select(F.col("doc_id").alias("v"), F.col("hashes").alias("set_v")), "v")
    )

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                h, t = unpacked(part.column("set_u"))
                g, s = unpacked(part.column("set_v"))
                n, m = T.counts(t, part.num_rows), T.counts(s, part.num_rows)
                hashes, owner = np.concatenate((h, g)), np.concatenate((t, s))
                order = np.lexsort((hashes, owner))
                twice = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
                shared = T.counts(owner[order][1:][twice], part.num_rows)
                linked = pa.array(100 * shared >= percent * (n + m - shared))
                yield pa.RecordBatch.from_pydict({"u": part.column("u").filter(linked), "v": part.column("v").filter(linked)})

    return both.select("u", "v", "set_u", "set_v").mapInArrow(run, LINKS)


LINKS = "u long, v long"


def intersections(a: tuple[np.ndarray, np.ndarray, int], b: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
    """Sizes of the intersections of the sets of two blocks, each given as hashes, set numbers and number of sets.

    A hash that few sets have is counted by the pairs of sets that have it, one that most sets have by the pairs that both
    lack it, and those in between by a product of matrices.
    """
    (h, t, n), (g, s, m) = a, b
    kinds = np.intersect1d(h, g)
    sides = []
    for hashes, owner in ((h, t), (g, s)):
        own = is_among(hashes, kinds)
        which, owner = np.searchsorted(kinds, hashes[own]), owner[own]
        order = np.argsort(which, kind="stable")
        sides.append((which[order], owner[order], np.bincount(which, minlength=len(kinds))))
    (_, _, times), (_, _, others) = sides
    having, lacking = times * others, (n - times) * (m - others)
    dense = np.minimum(having, lacking) * 50 > n * m
    flipped = ~dense & (lacking < having)
    out = np.zeros((n, m), np.float32)
    for lo in range(0, int(dense.sum()), 1024):
        left, right = (_matrix(*side[:2], np.flatnonzero(dense)[lo : lo + 1024], size) for side, size in zip(sides, (n, m)))
        out += left.astype(np.float32) @ right.astype(np.float32).T
    _count_pairs(out, *[_of(which, owner, ~dense & ~flipped) for which, owner, _ in sides])
    # |a and b| = all - those a lacks - those b lacks + those both lack
    for lo in range(0, int(flipped.sum()), 1024):
        chosen = np.flatnonzero(flipped)[lo : lo + 1024]
        missing = [~_matrix(*side[:2], chosen, size) for side, size in zip(sides, (n, m))]
        out += len(chosen) - missing[0].sum(axis=1, dtype=np.float32)[:, None] - missing[1].sum(axis=1, dtype=np.float32)[None]
        _count_pairs(out, *[np.nonzero(x.T) for x in missing])
    return out


def _of(which: np.ndarray, owner: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own = chosen[which]
    return which[own], owner[own]


def _matrix(which: np.ndarray, owner: np.ndarray, chosen: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` sets have each of some hashes."""
    place = np.full(max(int(which.max(initial=0)), int(chosen.max(initial=0))) + 1, -1)
    place[chosen] = np.arange(len(chosen))
    inside = place[which] >= 0
    out = np.zeros((n, len(chosen)), dtype=bool)
    out[owner[inside], place[which[inside]]] = True
    return out


def _count_pairs(out: np.ndarray, left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> None:
    """Add one for every pair of a left and a right set with the same hash; both sides are sorted by hash."""
    (x, t), (y, s) = left, right
    low, high = np.searchsorted(y, x, "left"), np.searchsorted(y, x, "right")
    many = high - low
    ends, lo, flat = np.cumsum(many), 0, out.reshape(-1)
    while lo < len(x):
        done = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + (1 << 20), "right")))
        size = many[lo:hi]
        partner = np.arange(int(ends[hi - 1]) - done) + np.repeat(low[lo:hi] - (ends[lo:hi] - size - done), size)
        np.add.at(flat, np.repeat(t[lo:hi] * out.shape[1], size) + s[partner], np.float32(1))
        lo = hi


def _linked_blocks(percent: int):
    def run(table: pa.Table) -> pa.Table:
        """Links of the members of one block that are outside of the main component with the members of another."""
        left, right = table.filter(table["left"]), table.filter(pc.invert(table["left"]))
        rep_a, rep_b = left["rep"].to_numpy(), right["rep"].to_numpy()
        if left.num_rows == 0 or right.num_rows == 0:
            return pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64())})
        h, t = unpacked(left["hashes"])
        g, s = unpacked(right["hashes"])
        n, m = T.counts(t, len(rep_a)), T.counts(s, len(rep_b))
        shared = intersections((h, t, len(rep_a)), (g, s, len(rep_b)))
        linked = 100 * shared >= percent * (n[:, None] + m[None] - shared)
        linked &= left["component"].to_numpy()[:, None] != right["component"].to_numpy()[None]
        a, b = np.nonzero(linked)
        return pa.table({"u": np.maximum(rep_a[a], rep_b[b]), "v": np.minimum(rep_a[a], rep_b[b])})

    return run


def _links_in_blocks(open_buckets: DataFrame, held: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Links between members outside of the main component of a bucket and members of other components."""
    members = open_buckets.join(nodes.select("rep", "n"), "rep")
    sized = members.groupBy("key").agg(F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES)).cast("int").alias("blocks"))
    members = members.join(sized, "key").withColumn("cell", block_of(F.col("blocks"), "rep"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    outside = members.filter("component != main").select("key", F.col("cell").alias("i"), other.alias("j"), "rep", "component", F.lit(True).alias("left"))
    everyone = members.select("key", other.alias("i"), F.col("cell").alias("j"), "rep", "component", F.lit(False).alias("left"))
    sent = outside.unionByName(everyone).join(held.withColumnRenamed("doc_id", "rep"), "rep")
    return sent.groupBy("key", "i", "j").applyInArrow(_linked_blocks(percent), LINKS).distinct()


def _in_buckets(buckets: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Bucket members with their component so far, of buckets that still hold more than one."""
    if labels is None:
        return buckets.withColumn("component", F.col("rep"))
    known = buckets.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    known = known.withColumn("component", F.coalesce("component", "rep"))
    still = known.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
    return known.join(still.select("key"), "key", "left_semi")


def groups(documents: DataFrame, width: int = 4, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (smallest id that links lead to) and ``kept`` (it is that id)."""
    prepare(documents.sparkSession)
    described = spool(describe(documents, width), "sets")
    linkable = described.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    keys = ["n_shingles", "d1", "d2"]
    classes = spool(linkable.groupBy(keys).agg(F.min("doc_id").alias("rep")), "classes")
    first = linkable.join(classes.select("rep", *keys), keys).filter("doc_id = rep")
    members = first.select("rep", F.explode("bands").alias("key")).distinct()
    crowded = members.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    buckets = spool(members.join(crowded.select("key"), "key", "left_semi"), "buckets")
    wanted = spool(buckets.select(F.col("rep").alias("doc_id")).distinct(), "wanted")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    held_sets = spool(packed_sets(rows.join(wanted, "doc_id", "left_semi"), width), "shingles")
    sizes = first.select("rep", F.col("n_shingles").alias("n"), "sketch", "bands").dropDuplicates(["rep", "n"])
    nodes = spool(sizes.join(_common(held_sets), "rep"), "nodes")
    # The larger the share of a member's shingles that others have, the nearer it is to the middle of a group.
    buckets = spool(
        buckets.join(nodes.select("rep", (F.col("common") * 1_000_000 / F.col("n")).cast("long").alias("middle")), "rep"), "buckets"
    )

    def worth_testing(pairs: DataFrame, tested: DataFrame | None) -> DataFrame:
        new = pairs.select(F.greatest("rep_a", "rep_b").alias("u"), F.least("rep_a", "rep_b").alias("v")).distinct()
        sides = new.join(_sided(nodes, "a"), F.col("u") == F.col("rep_a")).join(_sided(nodes, "b"), F.col("v") == F.col("rep_b"))
        able = sides.filter(_may_link(percent)).select("u", "v").distinct()
        return able if tested is None else able.join(tested, ["u", "v"], "left_anti")

    tested: DataFrame | None = None
    links: DataFrame | None = None
    labels: DataFrame | None = None
    lead = F.max(F.struct("middle", (-F.col("rep")).alias("minus"), "component")).alias("lead")
    for stage in ("first leader", "second leader", "rest"):
        held = _in_buckets(buckets, labels)
        others = held
        if labels is not None:
            most = held.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
            most = most.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("main"))
            held = spool(held.join(most, "key"), "held")
            others = held.filter("component != main")
        if stage != "rest":
            pairs = held.join(others.groupBy("key").agg(lead), "key").filter("component != lead.component")
            pairs = pairs.select(F.col("rep").alias("rep_a"), (-F.col("lead.minus")).alias("rep_b"))
        else:
            sized = spool(held.groupBy("key").agg(F.count(F.lit(1)).alias("members")), "sizes")
            large = held.join(sized.filter(F.col("members") > SMALL).select("key"), "key", "left_semi")
            held = held.join(sized.filter(F.col("members") <= SMALL).select("key"), "key", "left_semi")
            left = held.filter("component != main").select("key", F.col("component").alias("c_a"), "rep")
            right = held.select("key", F.col("component").alias("c_b"), "main", "rep")
            left = left.join(_sided(nodes, "a", "bands"), F.col("rep") == F.col("rep_a")).drop("rep")
            right = right.join(_sided(nodes, "b", "bands"), F.col("rep") == F.col("rep_b")).drop("rep")
            apart = (F.col("c_a") != F.col("c_b")) & ((F.col("c_b") == F.col("main")) | (F.col("rep_a") < F.col("rep_b")))
            first_shared = F.array_min(F.array_intersect("bands_a", "bands_b")) == F.col("key")
            pairs = left.join(right, "key").filter(apart & _may_link(percent) & first_shared)
        chosen = spool(worth_testing(pairs, tested), "pairs")
        tested = chosen if tested is None else tested.unionByName(chosen)
        found = _confirmed(held_sets, chosen, percent)
        if stage == "rest":
            found = found.unionByName(_links_in_blocks(large, held_sets, nodes, percent))
        found = spool(found, "links")
        if links is None or found.take(1):
            links = found if links is None else links.unionByName(found)
            labels = components(links)

    named = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        *keys, F.coalesce("component", "rep").alias("named")
    )
    found = described.select("doc_id", *keys).join(named, keys, "left")
    own = F.when(F.col("doc_id").isNull() | (F.col("n_shingles") == 0), F.col("doc_id")).otherwise(F.col("named"))
    return found.select(
        "doc_id", "n_shingles", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept")
    )


def keep_first(documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents with the smallest id of their group, with all their columns."""
    extra = groups(documents, width, percent).filter(~F.col("kept")).select(F.col("doc_id").alias("__extra")).distinct()
    return documents.join(extra, F.col("doc_id") == F.col("__extra"), "left_anti")
