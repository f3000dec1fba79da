import random

import pytest
from llm_helpers import CLASHES

from pingloom.llm import mixing


@pytest.mark.parametrize("seed", range(40))
def test_deviation_is_less_than_a_block(seed):
    pick = random.Random(seed)
    n = pick.randint(1, 12)
    size = pick.randint(2 * n, 90)
    shares = mixing.whole_shares({s: pick.random() + 0.01 for s in range(n)}, size)
    assert sum(shares.values()) == size and min(shares.values()) >= 1
    order = {t: s for s, slots in mixing.period(shares).items() for t in slots}
    given = dict.fromkeys(shares, 0)
    for t in range(size):
        given[order[t]] += 1
        assert all(abs(given[s] - e * (t + 1) / size) < 1 for s, e in shares.items())


@pytest.mark.parametrize("seed", range(20))
def test_phases_use_every_slot_once(seed):
    pick = random.Random(seed)
    blocks = {s: pick.randint(1, 80) for s in range(pick.randint(1, 9))}
    parts = mixing.plan(blocks, {s: pick.random() + 0.01 for s in blocks}, length=20)
    slots = []
    for s, n in blocks.items():
        for j in range(n):
            part = [p for p in parts[s] if p.first <= j][-1]
            turn = j - part.first
            slots.append(part.slot + turn // part.share * part.length + part.offsets[turn % part.share])
    assert sorted(slots) == list(range(sum(blocks.values())))


def test_every_document_once_and_on_time(some_documents):
    found = mixing.mix(some_documents, block_chars=2048).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(r["doc_id"] for r in some_documents.collect())
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in found)
    owner = {}
    for r in found:
        assert owner.setdefault(r["slot"], (r["source"], r["block"])) == (r["source"], r["block"])


def test_places_are_running_sums(some_documents):
    by_source = {}
    for r in mixing.mix(some_documents, block_chars=2048).collect():
        by_source.setdefault(r["source"], []).append((r["place"], len(r["text"]), r["block"]))
    for rows in by_source.values():
        at = 0
        for place, size, block in sorted(rows):
            assert place == at and block == place // 2048
            at += size


def test_repeating_holds_the_weights_to_the_end(some_documents):
    weights = {"src0": 5.0, "src1": 1.0}
    found = mixing.mix(some_documents, weights, block_chars=2048, exhausted="repeat").collect()
    assert {r["doc_id"] for r in found} == {r["doc_id"] for r in some_documents.collect()}
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in found)
    chars = {s: sum(len(r["text"]) for r in found if r["source"] == s) for s in weights}
    assert 3 < chars["src0"] / chars["src1"] < 8


def test_order_is_kept_in_partitions(some_documents):
    laid = mixing.mix(some_documents, block_chars=2048)
    expected = [r["doc_id"] for r in sorted(laid.collect(), key=lambda r: (r["slot"], r["place"], r["doc_id"]))]
    ordered = mixing.in_order(laid, 3)
    assert ordered.columns == some_documents.columns
    assert [r["doc_id"] for r in ordered.collect()] == expected


def test_weights_and_sources_are_checked(some_documents, monkeypatch):
    with pytest.raises(ValueError):
        mixing.mix(some_documents, {"src0": 0.0})
    monkeypatch.setattr(mixing, "MAX_SOURCES", 3)
    with pytest.raises(ValueError):
        mixing.mix(some_documents)


def test_odd_rows(odd_documents, empty_documents):
    found = mixing.mix(odd_documents, block_chars=1000)
    assert found.count() == odd_documents.count()
    assert set(found.columns) == {*odd_documents.columns, *mixing.ADDED}
    assert mixing.mix(empty_documents).count() == 0
    assert set(mixing.in_order(found, 2).columns) == {*odd_documents.columns} - {*mixing.ADDED} and "kept" in CLASHES
