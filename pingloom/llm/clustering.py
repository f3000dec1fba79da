"""Centroid clustering of whole-number vectors, exact, with subvector dictionaries.

The kept vectors (``DIMENSIONS`` components, none null or not finite) become whole numbers, floor(``SCALE`` * x), and are
cut into blocks of ``BLOCK`` components. Every chunk of at most ``CHUNK`` vectors is encoded once and without loss: a block
has a dictionary of the distinct subvectors found in the chunk, and a vector is one code per block. The encoded chunks are
written to the shared folder. In a round, the squared distances of all dictionary entries to the centroids are computed
once per entry, and the distance of a vector is the sum of its codes' entries; sums over a cluster are the dictionary
weighted by how often the cluster has each code. All of it is integer arithmetic, so results do not depend on the order
of rows or on how they are spread.

A task holds one chunk. What leaves it in a round is one row per cluster, and the driver gets the sums per cluster,
whatever the number of vectors; a third of all rows in one cluster, or all of them equal, is no heavier than any other.

The first centroids are the ``k`` kept vectors with the smallest SHA-256 of ``1:<vec_id>``. A vector goes to the nearest
centroid, ties to the smaller number; a centroid becomes floor(sum / count) of its vectors, one without vectors stays.

Defined cases: a null vector, or one of another length, is left out; components beyond +-2**26 after scaling count as
+-2**26, so that a squared distance fits a long, and an inertia that does not fit is null; a null ``vec_id`` is kept and
hashed as ``1:``; rows of equal id are vectors of their own, and where they compete for a place among the first
centroids, the smaller vector comes first; with fewer than ``k`` kept vectors there are as many clusters; extra columns
are ignored; no rows, or none kept, give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pingloom.llm.frames import prepare, tidied
from pingloom.session import spool

DIMENSIONS, SCALE = 64, 64
BLOCK = 2
CHUNK = 1 << 15
K, ROUNDS = 16, 3
LARGEST = 1 << 26

ENCODED = "ids array<bigint>, sizes array<int>, entries binary, codes binary"


def whole(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``v``, the whole-number vector, of the vectors that are kept."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    number = lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, F.lit(-1.0 * LARGEST)), F.lit(1.0 * LARGEST)))
    return vectors.filter((F.size("embedding") == dimensions) & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", number).alias("v")
    )


def first_centroids(rows: DataFrame, k: int) -> np.ndarray:
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    chosen = rows.select("v", digest.alias("digest")).orderBy("digest", "v").limit(k).collect()
    return np.array([r["v"] for r in chosen], np.int64)


@dataclass(frozen=True)
class Chunk:
    """Vectors as codes: ``entries`` holds the dictionaries of all blocks in a row, block b from ``bounds[b]`` on."""

    entries: np.ndarray
    bounds: np.ndarray
    codes: np.ndarray

    @staticmethod
    def of(vectors: np.ndarray) -> Chunk:
        n_blocks = vectors.shape[1] // BLOCK
        # the components of a block as one number, which sorts and compares faster than a row
        span = vectors.max() - (low := vectors.min()) + 1
        entries, codes, sizes = [], np.empty((len(vectors), n_blocks), np.int32), []
        for b in range(n_blocks):
            part = vectors[:, b * BLOCK : (b + 1) * BLOCK]
            key = np.zeros(len(vectors), np.int64)
            for column in part.T:
                key = key * span + (column - low)
            _, example, which = np.unique(key, return_index=True, return_inverse=True)
            codes[:, b] = which
            entries.append(part[example])
            sizes.append(len(example))
        return Chunk(np.concatenate(entries), np.cumsum([0, *sizes]), codes)

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid, the smaller of equally near ones, and squared distance of every vector."""
        out = np.zeros((len(self.codes), len(centroids)), np.int64)
        for b in range(len(self.bounds) - 1):
            own = slice(self.bounds[b], self.bounds[b + 1])
            apart = self.entries[own][:, None] - centroids[:, b * BLOCK : (b + 1) * BLOCK]
            out += (apart * apart).sum(axis=2)[self.codes[:, b]]
        cluster = out.argmin(axis=1)
        return cluster, out[np.arange(len(out)), cluster]

    def sums(self, cluster: np.ndarray, k: int) -> np.ndarray:
        """Sum of the vectors of each cluster."""
        out = np.zeros((k, (len(self.bounds) - 1) * BLOCK), np.int64)
        for b in range(len(self.bounds) - 1):
            own = slice(self.bounds[b], self.bounds[b + 1])
            n = own.stop - own.start
            times = np.bincount(cluster * n + self.codes[:, b], minlength=k * n).reshape(k, n)
            out[:, b * BLOCK : (b + 1) * BLOCK] = times @ self.entries[own]
        return out

    def pack(self) -> tuple[list[int], bytes, bytes]:
        return np.diff(self.bounds).tolist(), self.entries.astype(np.int32).tobytes(), self.codes.astype(np.uint16).tobytes()

    @staticmethod
    def unpack(sizes: list[int], entries: bytes, codes: bytes) -> Chunk:
        places = np.frombuffer(codes, np.uint16).reshape(-1, len(sizes))
        return Chunk(np.frombuffer(entries, np.int32).reshape(-1, BLOCK).astype(np.int64), np.cumsum([0, *sizes]), places)


def encode(rows: DataFrame) -> DataFrame:
    """Chunks of vectors as dictionaries and codes, with the ids."""

    def chunk(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches).combine_chunks()
        lists = table["v"].combine_chunks()
        vectors = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(lists), -1)
        sizes, entries, codes = Chunk.of(vectors).pack()
        return pa.RecordBatch.from_pydict({
            "ids": pa.ListArray.from_arrays(np.array([0, len(lists)], np.int32), table["vec_id"].combine_chunks()), "sizes": pa.array([sizes], pa.list_(pa.int32())),
            "entries": pa.array([entries], pa.binary()), "codes": pa.array([codes], pa.binary()),
        })

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, CHUNK - n)
                held.append(part)
                n += part.num_rows
                batch = batch.slice(part.num_rows)
                if n == CHUNK:
                    yield chunk(held)
                    held, n = [], 0
        if held:
            yield chunk(held)

    return rows.mapInArrow(run, ENCODED)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, Chunk]]:
    for batch in batches:
        for i in range(batch.num_rows):
            sizes, entries, codes = (batch.column(c)[i].as_py() for c in ("sizes", "entries", "codes"))
            yield batch.column("ids")[i].values, Chunk.unpack(sizes, entries, codes)


def totals(encoded: DataFrame, centroids: np.ndarray) -> tuple[list[int], list[int], list[list[int]]]:
    """Number of vectors, summed distances and component sums of each cluster, as exact numbers."""
    k, width = centroids.shape

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, chunk in _chunks(batches):
            cluster, apart = chunk.nearest(centroids)
            rows = []
            for c, sums in enumerate(chunk.sums(cluster, k).tolist()):
                own = apart[cluster == c]
                # in two halves, which cannot overflow
                spent = (int((own >> 32).sum()) << 32) + int((own & 0xFFFFFFFF).sum())
                rows.append([str(x) for x in (len(own), spent, *sums)])
            yield pa.RecordBatch.from_pydict({"cluster": np.arange(k, dtype=np.int32), "sums": pa.array(rows, pa.list_(pa.string()))})

    parts = encoded.mapInArrow(run, "cluster int, sums array<string>").select("cluster", F.posexplode("sums").alias("at", "part"))
    added = parts.groupBy("cluster", "at").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
    found = [[0] * (width + 2) for _ in range(k)]
    for r in added.collect():
        found[r["cluster"]][r["at"]] = int(r["total"])
    return [f[0] for f in found], [f[1] for f in found], [f[2:] for f in found]


def assign(encoded: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id``, ``cluster`` and squared ``distance`` of every vector."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, chunk in _chunks(batches):
            cluster, apart = chunk.nearest(centroids)
            yield pa.RecordBatch.from_pydict({"vec_id": ids, "cluster": cluster.astype(np.int32), "distance": apart})

    return encoded.mapInArrow(run, "vec_id long, cluster int, distance long")


@dataclass(frozen=True)
class Clustering:
    """Final centroids, and what their clusters hold."""

    centroids: np.ndarray
    sizes: list[int]
    inertia: list[int]
    vectors: DataFrame


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE) -> Clustering:
    """The centroids after some rounds, and the vectors with their cluster and distance."""
    if dimensions % BLOCK:
        raise ValueError(f"the number of components must be a multiple of {BLOCK}")
    prepare(vectors.sparkSession)
    rows = whole(vectors, dimensions, scale)
    centroids = first_centroids(rows, k)
    if not len(centroids):
        return Clustering(centroids, [], [], rows.selectExpr("vec_id", "0 AS cluster", "0L AS distance"))
    encoded = spool(encode(rows), "codes")
    for _ in range(rounds):
        n, _, sums = totals(encoded, centroids)
        centroids = np.array([[x // n[c] for x in sums[c]] if n[c] else row for c, row in enumerate(centroids)], np.int64)
    n, inertia, _ = totals(encoded, centroids)
    return Clustering(centroids, n, inertia, assign(encoded, centroids))


def described(found: Clustering) -> DataFrame:
    """The vectors with the inertia of their cluster and of all, and the digest of their centroid."""
    per_cluster = [
        (c, spent, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest())
        for c, (row, spent) in enumerate(zip(found.centroids.tolist(), found.inertia))
    ]
    fits = lambda x: x if x < 1 << 63 else None
    spark = found.vectors.sparkSession
    named = spark.createDataFrame(
        [(c, fits(spent), digest) for c, spent, digest in per_cluster], "cluster int, cluster_inertia long, centroid_sha256 string"
    )
    total = fits(sum(found.inertia))
    return found.vectors.join(F.broadcast(named), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", F.lit(total).cast("long").alias("inertia"), "centroid_sha256"
    )
