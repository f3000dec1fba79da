import random
from collections import Counter

import numpy as np
import pytest
from llm_helpers import read

from pingloom.llm import exchange, run_index, substrings


@pytest.mark.parametrize("seed", range(60))
def test_index_orders_suffixes_and_streams_shared_lengths(seed):
    pick = random.Random(seed)
    segments = [bytes(pick.choice(b"ab\0\xff") for _ in range(pick.randint(1, 40))) for _ in range(pick.randint(1, 12))]
    begins = np.cumsum([0] + [len(s) for s in segments[:-1]])
    index = run_index.build(np.frombuffer(b"".join(segments), np.uint8), begins)
    suffixes = sorted((s[o:], b + o) for s, b in zip(segments, begins) for o in range(len(s)))
    assert index.order.tolist() == [p for _, p in suffixes]
    shared = index.shared()
    for (x, _), (y, p) in zip(suffixes, suffixes[1:]):
        n = next((k for k, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))
        assert shared[p] == n


def test_repetitive_text_has_few_runs():
    segments = [b"the same passage again and again " * 3] * 50
    begins = np.arange(50) * len(segments[0])
    index = run_index.build(np.frombuffer(b"".join(segments), np.uint8), begins)
    assert len(index.run_row) < len(index.order) / 10


def test_packed_keys_come_back():
    keys = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 1000, dtype=np.uint64) * np.uint64(2))
    assert (exchange.unpack_sorted(exchange.pack_sorted(keys)) == keys).all()
    parts = exchange.bucket_runs(keys, 7)
    assert [b for b, _ in parts] == list(range(7)) and np.concatenate([keys[own] for _, own in parts]).tolist() == keys.tolist()
    assert all(int(k) * 7 >> 64 == b for b, own in parts for k in keys[own])
    empty = np.empty(0, np.uint64)
    assert exchange.bucket_runs(empty, 7) == []
    assert len(exchange.unpack_sorted(exchange.pack_sorted(empty))) == 0


def expected(rows, width=substrings.WIDTH):
    texts = [(i, (t or "").encode()) for i, t in rows]
    least = {}
    for i, x in texts:
        for k in range(len(x) - width + 1) if i is not None else ():
            least[x[k : k + width]] = min(i, least.get(x[k : k + width], i))
    out = []
    for i, x in texts:
        gone = bytearray(len(x))
        for k in range(len(x) - width + 1) if i is not None else ():
            if least[x[k : k + width]] < i:
                gone[k : k + width] = b"\1" * width
        edges = np.flatnonzero(np.diff(np.concatenate(([0], np.frombuffer(gone, np.uint8), [0]))))
        out.append((i, len(x), tuple(map(tuple, edges.reshape(-1, 2).tolist())), bytes(c for c, g in zip(x, gone) if not g)))
    return Counter(out)


def found(documents):
    return Counter(
        (r["doc_id"], r["n_bytes"], tuple((s["start"], s["end"]) for s in r["removed"]), bytes(r["kept"]))
        for r in substrings.deduplicate(documents).collect()
    )


def test_matches_brute_force(spark, sf_dir, odd_documents):
    pick = random.Random(9)
    line = "".join(pick.choice("abcdefgh ") for _ in range(300))
    extra = [
        (None, line), (None, line), (7000, line), (6999, "é" + line[:49] + "x" + line[100:150] + "é"), (7001, line[50:99] + line[50:101]),
        (7002, "a" * 300), (7003, "b" + "a" * 51), (7002, "a" * 300), (7004, "a" * 50), (7005, "a" * 49), (7006, "ab" * 100),
        (7007, "ba" * 40 + "é" * 30), (7008, line[::-1]), (7009, line[120:] + line[::-1][100:]),
    ]
    documents = read(spark, sf_dir, "documents").select("doc_id", "text").unionByName(odd_documents.select("doc_id", "text"))
    documents = documents.unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    assert found(documents) == expected([tuple(r) for r in documents.collect()])


def test_texts_longer_than_a_chunk(spark, monkeypatch):
    """Windows that lie across the border of two chunks of a text are matched like all others."""
    pick = random.Random(10)
    line = "".join(pick.choice("abcdefghijklmnop") for _ in range(400))
    far = "".join(pick.choice("qrstuvwxyz") for _ in range((1 << 19) - 200))
    rows = [(1, line), (2, far + line + far[:100]), (3, far[-300:] + line)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"]: [(s["start"], s["end"]) for s in r["removed"]] for r in substrings.deduplicate(documents).collect()}
    size = len(far)
    assert kept[1] == [] and kept[2] == [(size, size + 400)] and kept[3] == [(0, 700)]


def test_no_rows(empty_documents):
    assert substrings.deduplicate(empty_documents).count() == 0


def test_a_bucket_is_sorted_by_parts(monkeypatch):
    """Segments of different anchors share no window, so a bucket's suffixes are never sorted in one piece."""
    pick, pa = random.Random(7), substrings.pa
    texts = ["".join(pick.choice("abcdefghij ") for _ in range(5000)) for _ in range(20)]
    documents = pa.table({"doc_id": pa.array(range(40), pa.int64()), "text": texts * 2})
    raw, at, _, _ = substrings._block(documents)
    anchors = np.unique(substrings.Segments(raw, at).anchor)
    shared = pa.table({"keys": pa.array([exchange.pack_sorted(anchors)], pa.binary())})
    sent = substrings._send_segments(1)((pa.scalar(0),), documents, shared)
    sizes, build = [], substrings.build
    monkeypatch.setattr(substrings, "build", lambda text, begins: sizes.append(len(text)) or build(text, begins))
    # every window is known to the block already: the smallest id that has it is one of its own
    assert substrings._match(sent).num_rows == 0
    assert sent.num_rows == 1 and len(sizes) > substrings.PARTS // 2 and max(sizes) < sum(sizes) / 8
