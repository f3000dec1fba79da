"""Sorted 64-bit keys sent from blocks of documents to buckets of keys and back, as packed arrays.

A block sends a bucket one row with all its keys there instead of a row per key. Keys are sorted, so their differences
are small; they are stored by byte planes, which leaves the leading planes nearly empty for the compressor.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from pingloom.llm.frames import dealt


def bucket_runs(keys: np.ndarray, n: int) -> list[tuple[int, slice]]:
    """The buckets that sorted keys fall into, of ``n`` equal ranges of the key space, and which keys each gets."""
    if len(keys) == 0:
        return []
    bucket = ((keys >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1, [len(keys)]))
    return [(int(bucket[x]), slice(x, y)) for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def pack(values: np.ndarray) -> bytes:
    """Whole numbers of one width, by byte planes."""
    wide = np.ascontiguousarray(values)
    planes = wide.view(np.uint8).reshape(-1, wide.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(stored: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(stored), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(kind).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(stored: bytes) -> np.ndarray:
    return np.cumsum(unpack(stored, np.uint64), dtype=np.uint64)


KEYS = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("several", pa.binary())])
TOLD = pa.schema([("block", pa.int32()), ("keys", pa.binary())])
KEYS_SQL = "bucket int, block int, keys binary, several binary"
TOLD_SQL = "block int, keys binary"


def key_rows(block: int, keys: np.ndarray, several: np.ndarray, n_buckets: int) -> pa.Table:
    """A block's distinct sorted keys, dealt to buckets, with a mark on those that several of its documents have."""
    full = bucket_runs(keys, n_buckets)
    return pa.table({
        "bucket": [b for b, _ in full], "block": np.full(len(full), block), "keys": [pack_sorted(keys[s]) for _, s in full],
        "several": [np.packbits(several[s]).tobytes() for _, s in full],
    }, KEYS)


def _tell_shared(table: pa.Table) -> pa.Table:
    keys = [unpack_sorted(k.as_py()) for k in table["keys"]]
    several = [np.unpackbits(np.frombuffer(s.as_py(), np.uint8), count=len(k)) for s, k in zip(table["several"], keys)]
    kinds, which = np.unique(np.concatenate(keys), return_inverse=True)
    shared = np.bincount(which, 1.0 + np.concatenate(several), len(kinds)) > 1
    rows, begin = [], 0
    for block, own in zip(table["block"].to_pylist(), keys):
        told = own[shared[which[begin : begin + len(own)]]]
        begin += len(own)
        if len(told):
            rows.append((block, pack_sorted(told)))
    return pa.table({"block": [b for b, _ in rows], "keys": [k for _, k in rows]}, TOLD)


def shared_keys(sent: DataFrame, n_buckets: int) -> DataFrame:
    """Tell each block which of the keys it sent occur in several documents of the corpus."""
    return dealt(sent, "bucket", n_buckets).groupBy("bucket").applyInArrow(_tell_shared, TOLD_SQL)


def read_keys(told: pa.Table) -> np.ndarray:
    """The sorted keys a block was told."""
    return np.sort(np.concatenate([np.empty(0, np.uint64), *[unpack_sorted(k.as_py()) for k in told["keys"]]]))


def is_among(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each value is one of some sorted keys."""
    if len(keys) == 0:
        return np.zeros(len(values), dtype=bool)
    return keys[np.minimum(np.searchsorted(keys, values), len(keys) - 1)] == values
