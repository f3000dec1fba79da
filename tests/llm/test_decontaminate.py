import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_helpers import read

from pingloom.llm import decontaminate


def plain(text):
    return " ".join(re.findall(r"[a-z0-9\u0080-\U0010ffff]+", text.lower()))


@pytest.fixture(scope="module")
def planted(spark):
    """The documents with rewritten items put into some, and the pairs that must be found."""
    sf = "/root/testdata/sf0.01"
    documents, benchmark = read(spark, sf, "documents").select("doc_id", "text"), read(spark, sf, "benchmark")
    items = {r["item_id"]: r["text"] for r in benchmark.collect()}
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    hosts = [t for t in texts.values() if len(t) > 1500]
    pick, rows = random.Random(5), []
    for k, (number, text) in enumerate(items.items()):
        words = text.split()
        if k % 3 == 0:
            words = [w if pick.random() > 0.2 else pick.choice(hosts[0].split()) for w in words]
        elif k % 3 == 1:
            words = [w if "ß" in w else w.upper() for w in words if pick.random() > 0.2]
        else:
            words = [x for w in words for x in ([w] if pick.random() > 0.15 else [w, pick.choice(hosts[1].split())])]
        host = hosts[k].split()
        at = pick.randint(0, len(host))
        rows.append((10_000 + number, " ".join(host[:at] + words + host[at:])))
    expected = {(d, n) for n, item in items.items() for d, t in texts.items() if plain(item) in plain(t)}
    expected |= {(10_000 + n, n) for n in items}
    return documents.union(spark.createDataFrame(rows, "doc_id long, text string")), benchmark, expected


def test_leaks_and_paraphrases_are_found_and_nothing_else(planted):
    documents, benchmark, expected = planted
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(documents, benchmark).collect()}
    assert expected <= found
    # Hosts of rewritten items may hold an item of their own.
    assert {d for d, _ in found - expected} <= {d for d, _ in expected if d >= 10_000}


def test_cleaning_drops_exactly_the_matched(planted, monkeypatch):
    documents, benchmark, _ = planted
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 25)
    dirty = {r["doc_id"] for r in decontaminate.matches(documents, benchmark).collect()}
    kept = {r["doc_id"] for r in decontaminate.clean(documents, benchmark).collect()}
    assert kept == {r["doc_id"] for r in documents.collect()} - dirty


def test_decomposition_matches_numpy(spark):
    pick = np.random.default_rng(1)
    dense = pick.random((40, 3)) @ pick.random((3, 60)) + 0.001 * pick.random((40, 60))
    rows = [np.arange(60)] * 40
    basis = decontaminate.randomised_svd(spark, rows, list(dense), 60, 0.999)
    assert basis.shape == (60, 3)
    exact = np.linalg.svd(dense)[2][:3].T
    assert np.allclose(basis.T @ basis, np.eye(3), atol=1e-8)
    assert np.linalg.norm(basis @ basis.T - exact @ exact.T) < 1e-2


def test_weighted_subsequence():
    words = np.arange(1, 9, dtype=np.uint64)
    passage = decontaminate.Passage(0, words[:4], np.array([1.0, 2.0, 3.0, 4.0]), frozenset(), 40)
    assert decontaminate.subsequence_share(passage, words[[7, 0, 6, 1, 3, 2]]) == pytest.approx(0.7)
    assert decontaminate.subsequence_share(passage, words[[7]]) == 0


def test_space_is_smaller_than_its_passages_and_keeps_their_variance(spark):
    """Passages of few subjects: a space of few dimensions, in which words that occur together fall together."""
    pick = random.Random(8)
    subjects = [[f"{c}{i}" for i in range(40)] for c in "abcde"]
    texts = [" ".join(pick.sample(subjects[k % 5], 25)) for k in range(60)]
    items = [decontaminate.Item(k, decontaminate._passages(k, hashed(t), np.empty(0, np.uint64), np.ones(decontaminate.SLOTS))) for k, t in enumerate(texts)]
    space = decontaminate.block(spark, items, np.ones(decontaminate.SLOTS)).spaces[0]
    assert space.passages.shape[1] < 30
    alike = space.passages @ space.passages.T
    same = np.equal.outer(np.arange(60) % 5, np.arange(60) % 5)
    assert alike[same].min() > 0.4 and alike[~same].max() < 0.2


def test_latin_capitals_count_as_small():
    from pingloom.llm import text as T
    import pyarrow as pa

    low, high = (decontaminate.terms(*T.view(pa.array([t])))[0].tolist() for t in ("été straße-NEU", "ÉTÉ STRAßE neu"))
    assert low == high


def test_given_answer(spark):
    body = " ".join(f"w{i}" for i in range(30))
    benchmark = spark.createDataFrame([(1, body, "w3 w4"), (2, body, "missing words")], "item_id long, text string, answer string")
    documents = spark.createDataFrame([(1, body), (2, "nothing here")], "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(documents, benchmark).collect()}
    assert found == {(1, 1)}


def test_odd_rows(spark, odd_documents, empty_documents):
    rows = [(None, "one two three four five six"), (1, None), (2, ""), (3, "!!"), (4, "one two three four five six"), (4, "one two three four five six")]
    benchmark = spark.createDataFrame(rows, "item_id long, text string")
    found = decontaminate.matches(odd_documents, benchmark).collect()
    assert {r["doc_id"] for r in found} == {None, -3}
    assert decontaminate.clean(odd_documents, benchmark).columns == odd_documents.columns
    assert decontaminate.matches(empty_documents, benchmark).count() == 0
    assert decontaminate.matches(odd_documents, benchmark.limit(0)).count() == 0
    assert decontaminate.clean(odd_documents, benchmark.limit(0)).count() == odd_documents.count()


KINDS = ("verbatim", "dropped", "synonyms", "part")


def copied(spark, sizes, seed):
    """Texts that hold one item each, copied in the ways of ``KINDS``, and the items, cut from other texts."""
    texts = [r["text"] for r in read(spark, "/root/testdata/sf0.01", "documents").select("text").collect()]
    texts = [t.split() for t in texts if len(t) > 1500]
    pick, items, rows = random.Random(seed), [], []
    for k, size in enumerate(sizes):
        words = pick.choice(texts)
        at = pick.randrange(len(words) - size)
        words = words[at : at + size]
        items.append((k, " ".join(words)))
        kind = KINDS[k // 4 % 4]
        if k % 4 == 0:
            host = pick.choice(texts)
            kept = {
                "verbatim": words, "dropped": [w for w in words if pick.random() > 0.2],
                "synonyms": [w if pick.random() > 0.2 else f"syn{w}" for w in words],
                "part": words[: max(decontaminate.WINDOW + 8, size // 2)],
            }[kind]
            at = pick.randint(0, len(host))
            rows.append((k, " ".join(host[:at] + kept + host[at:]), " ".join(kept), kind))
    return spark.createDataFrame(rows, "doc_id long, text string, kept string, kind string"), spark.createDataFrame(items, "item_id long, text string")


def split(text):
    """Terms of a text without the module's help; the given texts have no capitals beyond Latin-1."""
    return [w.lower() for w in re.findall(r"[A-Za-z0-9\u0080-\U0010ffff]+", text or "")]


def stands(passage, words, rarity):
    """Whether the checks let some place of a text stand: heaviest common subsequence and rarest words, by plain loops."""
    weights = [rarity[w] for w in passage]
    rarest = {passage[i] for i in sorted(range(len(passage)), key=lambda i: -weights[i])[:5]}
    for lo in range(0, max(1, len(words) - 40), 24):
        part = words[lo : lo + 96]
        if len(rarest & set(part)) < 0.6 * len(rarest):
            continue
        row = [0.0] * (len(part) + 1)
        for w, weight in zip(passage, weights):
            new = [0.0]
            for j, x in enumerate(part):
                new.append(max(row[j + 1], new[-1], row[j] + weight if w == x else 0.0))
            row = new
        if row[-1] >= 0.6 * sum(weights):
            return True
    return False


def rarities(documents):
    texts = [r["text"] for r in documents.collect()]
    seen = Counter(w for t in texts for w in set(split(t)))
    return defaultdict(lambda: math.log((len(texts) + 1) / 0.5), {w: max(0.01, math.log((len(texts) + 1) / (n + 0.5))) for w, n in seen.items()})


def cut(words):
    return [words[a : a + 32] for a in decontaminate._cut(len(words))]


def recall(documents, benchmark):
    """By kind the planted copies that the checks let stand, and those of them that are found."""
    rarity = rarities(documents)
    items = {r["item_id"]: cut(split(r["text"])) for r in benchmark.collect()}
    must = {
        (r["doc_id"], r["kind"]) for r in documents.collect() if any(stands(p, split(r["kept"]), rarity) for p in items[r["doc_id"]])
    }
    rows = decontaminate.matches(documents.drop("kept", "kind"), benchmark).collect()
    found = {(r["doc_id"], r["item_id"]) for r in rows}
    return {kind: (sum(k == kind for _, k in must), sum(k == kind and (d, d) in found for d, k in must)) for kind in KINDS}


def test_matches_against_brute_force(spark):
    """All documents against all items: nothing that the checks refuse, and nearly all that they let stand."""
    documents, benchmark = copied(spark, [24 + k * 7 % 70 for k in range(120)], 9)
    documents = documents.select("doc_id", "text")
    rarity = rarities(documents)
    items = {r["item_id"]: cut(split(r["text"])) for r in benchmark.collect()}
    wanted = {
        (r["doc_id"], n) for r in documents.collect() for n, passages in items.items()
        if any(stands(p, split(r["text"]), rarity) for p in passages)
    }
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(documents, benchmark).collect()}
    # Places are looked at with other borders here and there.
    assert len(found - wanted) <= 0.02 * len(wanted) and len(found & wanted) >= 0.9 * len(wanted) and len(wanted) >= 30


def hashed(text):
    import pyarrow as pa

    from pingloom.llm import text as T

    return decontaminate.terms(*T.view(pa.array([text])))[0]


@pytest.mark.parametrize(("n_items", "shortest"), [(200, 24), (1000, 24), (600, 5)])
def test_recall_by_size_of_the_benchmark_and_kind_of_copy(spark, n_items, shortest):
    sizes = [shortest + k * 7 % (60 if shortest > 20 else 19) for k in range(n_items)]
    counted = recall(*copied(spark, sizes, 3))
    print(n_items, shortest, counted)
    assert counted["verbatim"][0] >= n_items // 20 and counted["verbatim"][0] == counted["verbatim"][1]
    assert all(found >= 0.9 * must for must, found in counted.values())
