"""Exact substring de-duplication with a run-length index over the segments that documents share.

Every byte covered by a string of ``WIDTH`` bytes that also starts in a document with a smaller id is removed. Texts are
bytes of UTF-8, and strings never cross documents.

Each window of ``WIDTH`` bytes has an anchor, the leftmost of its ``ANCHOR``-byte strings with the smallest hash, which
depends on its bytes alone; equal windows have equal anchors, and neighbouring windows mostly share theirs, so a text
falls into segments of windows with one anchor. Documents stand in blocks. Blocks send their distinct anchors to buckets
of hashes, and are told which occur in several documents; for these they send the segments, each once per block with the
smallest id that has it. A bucket builds the run-length index of its segments, streams the shared lengths, groups the
windows that match over their whole width and tells each block the smallest id that has a window, where it does not know
that itself. The block marks the bytes. A frequent passage is one entry per block, however many documents hold it.

Defined cases: a null or empty text has no bytes; a null ``doc_id`` is neither smaller nor greater than any other, so
nothing is removed from it or because of it; rows of equal id do not remove each other's bytes; texts shorter than
``WIDTH`` stay whole; extra columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pingloom.llm import text as T
from pingloom.llm.exchange import KEYS_SQL, bucket_runs, is_among, key_rows, pack, read_keys, shared_keys, unpack
from pingloom.llm.frames import block_count, block_of, prepare
from pingloom.llm.run_index import build, window_classes

# Shorter anchors would be fewer, but more of them would recur by chance and bring segments that match nothing.
WIDTH, ANCHOR = 50, 24
REACH = WIDTH - ANCHOR + 1
BLOCK_BYTES = 8 << 20
# A bucket sorts all suffixes of its segments, which takes about a hundred times their size. It does so by parts of its
# range of anchors, since segments of different anchors share no window and sorting is fast while a part fits the cache.
BUCKETS_PER_BLOCK = 4
PARTS = 32
_CHUNK_BITS = 19
_LOW = np.uint64((1 << (_CHUNK_BITS + 1)) - 1)
_NONE, _LEAST = np.iinfo(np.int64).max, np.iinfo(np.int64).min


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[: len(values) - size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (width - size)], values[width - size :]) if size < width else values


class Segments:
    """The segments of a block: anchor hash, first window, number of windows, and text number of each."""

    def __init__(self, raw: np.ndarray, at: np.ndarray):
        size = 1 << _CHUNK_BITS
        anchors, firsts, many = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for lo in range(0, max(0, len(raw) - WIDTH + 1), size):
            part = raw[lo : lo + size + WIDTH - 1]
            hashes = T.window_hashes(T.prefix_hashes(part), ANCHOR)
            place = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
            spot = (_sliding_minimum(place, REACH) & _LOW).astype(np.int64)
            n = len(spot)
            new = np.ones(n + 1, dtype=bool)
            new[1:n] = spot[1:] != spot[:-1]
            # Windows that begin less than WIDTH before the end of a text are none.
            usable = np.ones(n, dtype=bool)
            ends = at[1:][(at[1:] > lo) & (at[1:] < lo + n + WIDTH)] - lo
            for back in range(1, WIDTH):
                out = ends - back
                usable[out[(out >= 0) & (out < n)]] = False
            new[1:n] |= usable[1:] != usable[:-1]
            begins = ends[ends < n]
            new[begins] = True
            first = np.flatnonzero(new[:n])
            length = np.diff(np.append(first, n))
            keep = usable[first]
            # Hashes of anchors are small, since each is the smallest of many; mixed again, they fall evenly into buckets.
            anchors.append(T.mix(hashes[spot[first[keep]]] + np.uint64(1)))
            firsts.append(first[keep] + lo)
            many.append(length[keep])
        self.anchor, self.first, self.many = np.concatenate(anchors), np.concatenate(firsts), np.concatenate(many)
        self.owner = T.owners(self.first, at)
        self.raw = raw

    def digests(self, chosen: np.ndarray) -> np.ndarray:
        """Hash of the bytes of some segments."""
        out = np.empty(len(chosen), np.uint64)
        size = 1 << _CHUNK_BITS
        group = self.first[chosen] // size
        for g in np.unique(group):
            rows = np.flatnonzero(group == g)
            lo = int(g) * size
            sums = T.prefix_hashes(self.raw[lo : lo + size + 2 * WIDTH + REACH])
            first = self.first[chosen[rows]] - lo
            out[rows] = T.short_hashes(sums, first, first + self.many[chosen[rows]] + WIDTH - 1)
        return out


def _block(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, offsets, and of each text the id as a source of windows and the id under which bytes are removed."""
    raw, at = T.view(table["text"])
    ids = table["doc_id"].combine_chunks()
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    numbers = ids.fill_null(0).to_numpy(zero_copy_only=False)
    return raw, at, np.where(known, numbers, _NONE), np.where(known, numbers, _LEAST)


SEGMENTS = pa.schema([
    ("bucket", pa.int32()), ("block", pa.int32()), ("digests", pa.binary()), ("many", pa.binary()), ("least", pa.binary()),
    ("parts", pa.binary()), ("bytes", pa.binary()),
])
TOLD = pa.schema([("block", pa.int32()), ("digests", pa.binary()), ("starts", pa.binary()), ("least", pa.binary())])
KEPT = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()),
    ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary()),
])


def _table(rows: dict[str, list], schema: pa.Schema) -> pa.Table:
    return pa.table(rows, schema)


def _empty(schema: pa.Schema) -> dict[str, list]:
    return {name: [] for name in schema.names}


def _put(rows: dict[str, list], *values) -> None:
    for name, value in zip(rows, values):
        rows[name].append(value)


def _send_anchors(n_buckets: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        raw, at, source, _ = _block(table)
        found = Segments(raw, at)
        kinds, which = np.unique(found.anchor, return_inverse=True)
        low, high = np.full(len(kinds), _NONE), np.full(len(kinds), _LEAST)
        np.minimum.at(low, which, source[found.owner])
        np.maximum.at(high, which, source[found.owner])
        return key_rows(key[0].as_py(), kinds, low < high, n_buckets)

    return run


def _distinct(digests: np.ndarray, source: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct digests, an example of each, the number of the digest of each segment, and the smallest id of each."""
    kinds, example, which = np.unique(digests, return_index=True, return_inverse=True)
    least = np.full(len(kinds), _NONE)
    np.minimum.at(least, which, source)
    return kinds, example, which, least


def _slices(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Positions of many spans in a row."""
    ends = np.cumsum(length)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - (ends - length), length)


def _send_segments(n_buckets: int):
    def run(key: tuple, documents: pa.Table, shared: pa.Table) -> pa.Table:
        rows = _empty(SEGMENTS)
        if documents.num_rows == 0 or shared.num_rows == 0:
            return _table(rows, SEGMENTS)
        raw, at, source, _ = _block(documents)
        found = Segments(raw, at)
        chosen = np.flatnonzero(is_among(found.anchor, read_keys(shared)))
        digests, example, _, least = _distinct(found.digests(chosen), source[found.owner[chosen]])
        one = chosen[example]
        order = np.argsort(found.anchor[one], kind="stable")
        one, digests, least = one[order], digests[order], least[order]
        part = (((found.anchor[one] >> np.uint64(32)) * np.uint64(n_buckets * PARTS)) >> np.uint64(32)) % np.uint64(PARTS)
        for b, own in bucket_runs(found.anchor[one], n_buckets):
            many = found.many[one[own]]
            _put(
                rows, b, key[0].as_py(), pack(digests[own]), pack(many.astype(np.uint8)), pack(least[own]),
                pack(part[own].astype(np.uint8)), pack(raw[_slices(found.first[one[own]], many + WIDTH - 1)]),
            )
        return _table(rows, SEGMENTS)

    return run


def _window_least(text: np.ndarray, length: np.ndarray, many: np.ndarray, least: np.ndarray) -> np.ndarray:
    """For each window of some segments, in a row, the smallest id of all segments that have it."""
    begins = np.cumsum(length) - length
    index = build(text, begins)
    segment = np.repeat(np.arange(len(many)), length)[index.order]
    starts_window = index.order - begins[segment] < many[segment]
    group = window_classes(index, WIDTH)
    lowest = np.full(int(group[-1]) + 1, _NONE)
    np.minimum.at(lowest, group[starts_window], least[segment[starts_window]])
    at_position = np.full(len(text), _NONE)
    at_position[index.order] = lowest[group]
    return at_position[_slices(begins, many)]


def _match(table: pa.Table) -> pa.Table:
    """Index the distinct segments of a bucket and tell each block the smallest id that has each window."""
    digests = [unpack(d.as_py(), np.uint64) for d in table["digests"]]
    sizes = [len(d) for d in digests]
    many = np.concatenate([unpack(m.as_py(), np.uint8) for m in table["many"]]).astype(np.int64)
    own_least = np.concatenate([unpack(x.as_py(), np.int64) for x in table["least"]])
    part = np.concatenate([unpack(p.as_py(), np.uint8) for p in table["parts"]])
    text = np.concatenate([unpack(b.as_py(), np.uint8) for b in table["bytes"]])
    length = many + WIDTH - 1
    first = np.cumsum(length) - length
    kinds, example, which, least = _distinct(np.concatenate(digests), own_least)
    # the distinct segments, part by part
    order = np.argsort(part[example], kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    example, which, kinds, least = example[order], place[which], kinds[order], least[order]
    many, length, first, part = many[example], length[example], first[example], part[example]
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    value = np.concatenate([
        _window_least(text[_slices(first[x:y], length[x:y])], length[x:y], many[x:y], least[x:y]) for x, y in zip(cuts[:-1], cuts[1:])
    ])

    # Per segment the windows in a row, cut where the smallest id changes.
    owner = np.repeat(np.arange(len(kinds)), many)
    window = _slices(np.zeros(len(kinds), np.int64), many)
    cut = np.ones(len(value), dtype=bool)
    cut[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    owner, window, value = owner[cut], window[cut], value[cut]
    per = np.bincount(owner, minlength=len(kinds))
    at = np.cumsum(per) - per

    rows, begin = _empty(TOLD), 0
    for block, n in zip(table["block"].to_pylist(), sizes):
        mine = which[begin : begin + n]
        known = own_least[begin : begin + n]
        begin += n
        lines = _slices(at[mine], per[mine])
        line_of = np.repeat(np.arange(n), per[mine])
        news = np.zeros(n, dtype=bool)
        news[line_of[value[lines] != known[line_of]]] = True
        lines = lines[news[line_of]]
        if len(lines):
            _put(rows, block, pack(kinds[owner[lines]]), pack(window[lines].astype(np.uint8)), pack(value[lines]))
    return _table(rows, TOLD)


def _mark(key: tuple, documents: pa.Table, told: pa.Table) -> pa.Table:
    if documents.num_rows == 0:
        return _table(_empty(KEPT), KEPT)
    raw, at, source, target = _block(documents)
    found = Segments(raw, at)
    covered = np.zeros(len(raw) + 1, np.int32)

    def remove(first: np.ndarray, last: np.ndarray) -> None:
        """Cover the windows that start from ``first`` to before ``last``."""
        np.add.at(covered, first, 1)
        np.add.at(covered, last + WIDTH - 1, -1)

    if len(found.anchor):
        digests, _, which, least = _distinct(found.digests(np.arange(len(found.anchor))), source[found.owner])
        stop = found.first + found.many
        settled = np.zeros(len(digests), dtype=bool)
        if told.num_rows:
            # Lines of one segment stand together, by their first window.
            key_of = np.concatenate([unpack(d.as_py(), np.uint64) for d in told["digests"]])
            start = np.concatenate([unpack(s.as_py(), np.uint8) for s in told["starts"]]).astype(np.int64)
            value = np.concatenate([unpack(v.as_py(), np.int64) for v in told["least"]])
            order = np.lexsort((start, key_of))
            key_of, start, value = key_of[order], start[order], value[order]
            low, high = np.searchsorted(key_of, digests, "left"), np.searchsorted(key_of, digests, "right")
            settled = high > low
            rows = np.flatnonzero(settled[which])
            per = (high - low)[which[rows]]
            line = _slices(low[which[rows]], per)
            row = np.repeat(rows, per)
            first = found.first[row] + start[line]
            last = np.append(first[1:], 0)
            ends = np.cumsum(per) - 1
            last[ends] = stop[rows]
            gone = value[line] < target[found.owner[row]]
            remove(first[gone], last[gone])
        gone = ~settled[which] & (least[which] < target[found.owner])
        remove(found.first[gone], stop[gone])
    out = np.cumsum(covered[:-1], dtype=np.int32) > 0
    del covered
    first, last, owner = T.runs(out, at)
    spans = pa.StructArray.from_arrays([pa.array(first - at[owner]), pa.array(last - at[owner])], ["start", "end"])
    cuts = np.searchsorted(owner, np.arange(documents.num_rows + 1)).astype(np.int32)
    left = (at - np.concatenate(([0], np.cumsum(last - first)))[np.searchsorted(first, at)]).astype(np.int64)
    kept = pa.Array.from_buffers(pa.large_binary(), documents.num_rows, [None, pa.py_buffer(left), pa.py_buffer(raw[~out].copy())])
    return pa.table({
        "doc_id": documents["doc_id"], "n_bytes": np.diff(at), "removed": pa.ListArray.from_arrays(cuts, spans),
        "kept": kept.cast(pa.binary()),
    }, KEPT)


def _sql(schema: pa.Schema) -> str:
    kinds = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {kinds.get(f.type, 'array<struct<start: long, end: long>>')}" for f in schema)


def deduplicate(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``n_bytes``, the removed byte spans and the bytes that are kept, for every document."""
    prepare(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = block_count(rows, BLOCK_BYTES)
    blocks = rows.select(block_of(n, "doc_id", "text").alias("block"), "doc_id", "text")
    by_block = blocks.groupBy("block")
    shared = shared_keys(by_block.applyInArrow(_send_anchors(n), KEYS_SQL), n)
    segments = by_block.cogroup(shared.groupBy("block")).applyInArrow(_send_segments(n * BUCKETS_PER_BLOCK), _sql(SEGMENTS))
    told = segments.groupBy("bucket").applyInArrow(_match, _sql(TOLD))
    return by_block.cogroup(told.groupBy("block")).applyInArrow(_mark, _sql(KEPT))
