import random
import re
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from llm_helpers import lowered, read

from pingloom.llm import variants


def words(rows):
    counted = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = lowered(run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            counted[low[: h % len(low)] + low[h % len(low) + 1 :] if h % 199 == 0 else low] += 1
    return {w: n for w, n in counted.items() if len(w) >= 6 and n >= 5}


def pairs(known):
    """Near words: ``a + b`` and ``a + x + b`` for an inserted one, ``a + x + b`` and ``a + y + b`` for a replaced one."""
    gaps = defaultdict(set)
    for w in known:
        for k in range(len(w)):
            gaps[w[:k], w[k + 1 :]].add(w)
    found = set()
    for (a, b), filled in gaps.items():
        found |= {frozenset((x, y)) for x in filled for y in filled if x != y}
        if a + b in known:
            found |= {frozenset((a + b, x)) for x in filled}
    return found


def expected(rows):
    known = words(rows)
    near = defaultdict(set)
    for a, b in map(tuple, pairs(known)):
        near[a].add(b)
        near[b].add(a)
    form = {}
    for w, n in known.items():
        best = min(near[w], key=lambda x: (-known[x], x), default=None)
        form[w] = best if best and known[best] >= 5 * n else None
    out = {}
    for w, n in known.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), known[form[w]] if form[w] else None)
    return out


def found(documents):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in variants.group(documents).collect()}


@pytest.mark.parametrize("crowded", [variants.CROWDED, 3])
def test_groups_match_brute_force(spark, monkeypatch, crowded):
    monkeypatch.setattr(variants, "CROWDED", crowded)
    documents = read(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    assert found(documents) == expected([tuple(r) for r in documents.collect()])


def _strings(pick, letters, n):
    """Strings and strings one or two edits away from them."""
    out = set()
    while len(out) < n:
        w = [pick.choice(letters) for _ in range(pick.randint(6, 11))]
        for _ in range(4):
            out.add("".join(w))
            k = pick.randrange(len(w))
            w[k : k + pick.randint(0, 1)] = pick.choice([[pick.choice(letters)], [], [pick.choice(letters)]])
    return sorted(w for w in out if len(w) >= 6)


@pytest.mark.parametrize("letters", ["ab", "abcdefghéß", "aÿ"])
def test_all_near_pairs_are_found(spark, monkeypatch, letters):
    monkeypatch.setattr(variants, "CROWDED", 8)
    known = _strings(random.Random(5), letters, 500) + ["x" * 5000, "x" * 4999 + "y", "x" * 4999]
    variants.prepare(spark)
    frame = spark.createDataFrame([(w, 5) for w in known], "word string, n long")
    rows = variants.near_pairs(frame).collect()
    got = [frozenset((r["word_a"], r["word_b"])) for r in rows]
    assert len(got) == len(set(got)) and set(got) == pairs(set(known))


def test_near_words_share_a_signature():
    known = _strings(random.Random(6), "abcdeé", 200)
    keys = list(variants.signatures(pa.array(known)))
    number = {w: i for i, w in enumerate(known)}
    for a, b in map(sorted, pairs(set(known))):
        a, b = sorted((a, b), key=len)
        sides = (variants.EQUAL, variants.EQUAL) if len(a) == len(b) else (variants.SHORTER, variants.LONGER)
        ours = {int(k[number[a]]) for role, k in keys if role == sides[0]}
        theirs = {int(k[number[b]]) for role, k in keys if role == sides[1]}
        assert ours & theirs, (a, b)


def test_forms_are_followed_to_the_last(spark):
    chain = ["lantern", "lanterns", "lanternss", "lanternsss", "lanternssss", "lanternsssss"]
    rows = [(k, f"{w} ") for k, w in enumerate(chain)]
    documents = spark.createDataFrame([(i, w * 5 * 5 ** (5 - i)) for i, w in rows], "doc_id long, text string")
    wanted = expected([tuple(r) for r in documents.collect()])
    assert {r[1] for r in wanted.values()} == {"lantern"} and found(documents) == wanted


def test_odd_rows(spark, odd_documents, empty_documents):
    assert found(empty_documents) == {}
    text = "Éclair éclair ÉCLAIR×naïveté÷naïvetés " * 6
    rows = [(None, text), (1, text), (1, text), (2, None), (3, "")]
    extra = spark.createDataFrame(rows, "doc_id long, text string")
    documents = odd_documents.select("doc_id", "text").unionByName(extra)
    assert found(documents) == expected([tuple(r) for r in documents.collect()])
