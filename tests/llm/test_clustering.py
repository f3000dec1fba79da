import hashlib
import math
import random

import numpy as np
from llm_helpers import CLASHES, read
from pyspark.sql import functions as F

from pingloom.llm import clustering


def expected(rows, k=16, rounds=3, dimensions=64, scale=64):
    kept = [
        (i, [math.floor(scale * float(x)) for x in v]) for i, v in rows
        if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)
    ]
    first = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    centroids = [v for _, v in first[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        whose = [nearest(v)[1] for _, v in kept]
        for n in range(len(centroids)):
            own = [v for (_, v), w in zip(kept, whose) if w == n]
            if own:
                centroids[n] = [sum(x) // len(own) for x in zip(*own)]
    done = [(i, *nearest(v)[::-1]) for i, v in kept]
    spent = {n: sum(d for _, c, d in done if c == n) for n in range(len(centroids))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, n, d, spent[n], sum(spent.values()), digest[n]) for i, n, d in done), key=str)


def found(vectors, **how):
    return sorted((tuple(r) for r in clustering.described(clustering.cluster(vectors, **how)).collect()), key=str)


def test_rounds_match_brute_force(spark, monkeypatch):
    vectors = read(spark, "/root/testdata/sf0.01", "embeddings")
    wanted = expected([(r["vec_id"], r["embedding"]) for r in vectors.collect()])
    assert found(vectors) == wanted
    # several chunks a task, and rows dealt otherwise
    monkeypatch.setattr(clustering, "CHUNK", 37)
    pieces = clustering.encode(clustering.whole(vectors.coalesce(1)))
    assert pieces.count() == math.ceil(vectors.count() / 37)
    assert found(vectors.repartition(5)) == wanted


def test_odd_vectors(spark):
    pick = random.Random(2)
    whole = [[pick.uniform(-2, 2) for _ in range(64)] for _ in range(30)]
    nan, endless = [*whole[0][:63], float("nan")], [*whole[0][:63], float("-inf")]
    rows = [(i, v) for i, v in enumerate(whole)] + [(i, whole[0]) for i in range(30)] + [(None, whole[1]), (None, whole[2])]
    rows += [(100, None), (101, []), (102, whole[0][:63]), (103, [*whole[0][:63], None]), (104, nan), (105, endless)]
    rows += [(200 + i, [0.0] * 64) for i in range(40)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit("x") for c in CLASHES})
    assert found(frame) == expected([(r["vec_id"], r["embedding"]) for r in frame.collect()])
    few = frame.filter("vec_id < 3")
    assert found(few) == expected([(r["vec_id"], r["embedding"]) for r in few.collect()])
    assert found(frame.limit(0)) == [] and found(frame.filter("vec_id BETWEEN 100 AND 105")) == []


def test_other_sizes(spark):
    pick = random.Random(3)
    rows = [(i, [pick.gauss(0, 1) for _ in range(6)]) for i in range(300)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    how = {"k": 5, "rounds": 6, "dimensions": 6, "scale": 1000}
    assert found(frame, **how) == expected(rows, **how)


def test_huge_components_are_bounded(spark):
    rows = [(i, [3e38 if (i >> (k % 8)) & 1 else -3e38 for k in range(64)]) for i in range(40)]
    result = found(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert len(result) == 40 and all(0 <= r[2] < 1 << 62 for r in result)


def test_dictionaries_lose_nothing():
    pick = np.random.default_rng(4)
    vectors = pick.integers(-9, 9, (500, 8))
    chunk = clustering.Chunk.unpack(*clustering.Chunk.of(vectors).pack())
    blocks = [chunk.entries[chunk.bounds[b] : chunk.bounds[b + 1]][chunk.codes[:, b]] for b in range(4)]
    assert np.array_equal(np.concatenate(blocks, axis=1), vectors)
    assert all(len(np.unique(chunk.entries[a:b], axis=0)) == b - a for a, b in zip(chunk.bounds, chunk.bounds[1:]))
