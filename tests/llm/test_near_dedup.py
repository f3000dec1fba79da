import random
from collections import defaultdict

import numpy as np
import pytest
from llm_helpers import TWINS, near_groups, read, smallest

from pingloom.llm import near_dedup
from pingloom.llm.components import components


@pytest.mark.parametrize("width", [4, 5])
def test_groups_match_brute_force(spark, width):
    extra = [
        (5000, "a b c d e"), (5001, "A B c D e"), (5004, " \n "), (5005, "one two"), (5006, "One  TWO"), (5007, "one"),
        (5008, "x " * 40), (5009, "x " * 50), (5010, "É b c d e f"), (5011, "é b c d e f"),
    ]
    extra += [(6000 + k, t) for k, t in enumerate(TWINS)] + [(6100 + k, f"one {t} two {t} three") for k, t in enumerate(TWINS)]
    documents = read(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    documents = documents.union(spark.createDataFrame(extra, "doc_id long, text string"))
    sets, first = near_groups([tuple(r) for r in documents.collect()], width)
    for r in near_dedup.groups(documents, width).collect():
        i = r["doc_id"]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[i]), first[i], first[i] == i)


def test_chains_through_a_group_of_copies(spark):
    """Copies of copies: neighbours are similar, the ends are not, and all are one group beside a strange one."""
    pick = random.Random(4)
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        words = list(words)
        words[pick.randrange(120)] = f"new{i}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, " ".join(f"v{(i * 7 + k) % 40}" for k in range(60))) for i in range(40)]
    _, first = near_groups(rows, 4)
    found = {r["doc_id"]: r["component_id"] for r in near_dedup.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == first


def test_groups_of_copies_in_several_components(spark, monkeypatch):
    """Three hundred copies of a text without some of its words: most are similar, few enough to link."""
    monkeypatch.setattr(near_dedup, "SMALL", 20)
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 2000)
    pick = random.Random(4)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(300):
        dropped = set(pick.sample(range(150), pick.randint(0, 10)))
        rows.append((i, " ".join(w for k, w in enumerate(base) if k not in dropped)))
    _, first = near_groups(rows, 4)
    assert len(set(first.values())) > 100
    found = {r["doc_id"]: r["component_id"] for r in near_dedup.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == first


def test_intersections_of_blocks():
    pick = np.random.default_rng(3)
    for n, m, kinds in ((5, 7, 20), (300, 200, 60), (40, 1, 400)):
        a = [np.unique(pick.integers(0, kinds, 40)) for _ in range(n)] + [np.empty(0, np.int64)]
        b = [np.unique(np.concatenate((pick.integers(0, kinds, 30), pick.integers(1000, 3000, 30)))) for _ in range(m)]
        sides = [(np.concatenate(x).astype(np.uint64), np.repeat(np.arange(len(x)), [len(y) for y in x]), len(x)) for x in (a, b)]
        assert near_dedup.intersections(*sides).tolist() == [[len(np.intersect1d(x, y)) for y in b] for x in a]


def test_components(spark):
    pick = random.Random(6)
    edges = [(pick.randrange(80), pick.randrange(80)) for _ in range(60)] + [(200 + i, 201 + i) for i in range(40)] + [(300, 300)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert found == smallest(nodes, [e for e in edges if e[0] != e[1]])


def test_sketches_estimate_similarity():
    pick = np.random.default_rng(3)
    common = pick.integers(0, 1 << 63, 900, dtype=np.uint64)
    for own in (25, 100, 225):
        both = [np.concatenate((common, pick.integers(0, 1 << 63, own, dtype=np.uint64))) for _ in range(2)]
        sketch = near_dedup.odd_sketches(near_dedup.minima(np.concatenate(both), np.array([0, len(both[0])])))
        differing = sum(bin(int(x) & (2**64 - 1)).count("1") for x in sketch[0] ^ sketch[1])
        bits = near_dedup.SKETCH_BITS
        estimate = 1 + bits / 2 * np.log(1 - 2 * differing / bits) / (2 * near_dedup.SAMPLES)
        assert abs(estimate - 900 / (900 + 2 * own)) < 0.15


def test_keeping_the_first(spark, sf_dir):
    documents = read(spark, sf_dir, "documents")
    kept = near_dedup.keep_first(documents)
    _, first = near_groups([(r["doc_id"], r["text"]) for r in documents.collect()], 5)
    assert kept.columns == documents.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, c in first.items() if i == c)


def test_odd_rows(odd_documents, empty_documents):
    found = near_dedup.groups(odd_documents).collect()
    assert len(found) == odd_documents.count()
    by_id = defaultdict(list)
    for r in found:
        by_id[r["doc_id"]].append(r)
    assert all(r["component_id"] is None and r["kept"] for r in by_id[None])
    assert [(r["component_id"], r["n_shingles"]) for r in by_id[5]] == [(4, 1)] * 2
    assert (by_id[1][0]["component_id"], by_id[2][0]["component_id"], by_id[3][0]["n_shingles"]) == (1, 2, 0)
    assert near_dedup.groups(empty_documents).count() == 0
    assert near_dedup.keep_first(odd_documents).columns == odd_documents.columns
