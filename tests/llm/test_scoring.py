import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import TWINS, WORD, lowered, read

from pingloom.llm import scoring


def expected(rows, order, mass):
    """Scores by dictionaries, one token after another."""
    counts = [Counter() for _ in range(order + 1)]
    starts, texts = 0, []
    for doc_id, text in rows:
        words = ["<s>", *WORD.findall(lowered(text)), "</s>"]
        held_out = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1
        texts.append((doc_id, words, held_out))
        if not held_out:
            starts += 1
            for i in range(1, len(words)):
                for k in range(1, min(order, i + 1) + 1):
                    counts[k][tuple(words[i - k + 1 : i + 1])] += 1
    total, kinds = sum(counts[1].values()), len(counts[1])
    out = []
    for doc_id, words, held_out in texts:
        base = score = 0.0
        for i in range(1, len(words)):
            p = (counts[1][(words[i],)] + 0.5) / (total + 0.5 * (kinds + 1))
            base += math.log10(p)
            for k in range(2, min(order, i + 1) + 1):
                context = tuple(words[i - k + 1 : i])
                seen = starts if context == ("<s>",) else counts[k - 1][context]
                p = (counts[k][(*context, words[i])] + mass * p) / (seen + mass)
            score += math.log10(p)
        known = sum(counts[1][(w,)] > 0 for w in words[1:])
        out.append((doc_id, held_out, len(words) - 1, known, total, round(base, 6), round(score, 6)))
    return sorted(out, key=str)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_scores_match_brute_force(spark, sf_dir, odd_documents, order):
    documents = read(spark, sf_dir, "documents").select("doc_id", "text").unionByName(odd_documents.select("doc_id", "text"))
    crafted = [(7000 + k, f"{t} and {t}") for k, t in enumerate(TWINS)]
    documents = documents.unionByName(spark.createDataFrame(crafted, "doc_id long, text string"))
    rows = scoring.score(documents, order=order, mass=20.0).collect()
    found = sorted([(*r[:5], round(r["base_score"], 6), round(r["score"], 6)) for r in rows], key=str)
    wanted = expected([tuple(r) for r in documents.collect()], order, 20.0)
    assert [f[:5] for f in found] == [w[:5] for w in wanted]
    for f, w in zip(found, wanted):
        assert f[5:] == pytest.approx(w[5:], abs=1e-4)


def test_held_out_texts_score_better_than_single_tokens(spark):
    rows = scoring.score(read(spark, "/root/testdata/sf0.01", "documents")).filter("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows) + 0.2 * sum(r["n_tokens"] for r in rows)


def test_probabilities_sum_to_one(spark):
    """Over all that may follow a word of the vocabulary, and one unknown word with the share left for it."""
    train = [(i, "a b a c") for i in range(4, 12) if zlib.crc32(str(i).encode()) % 5 != 1]
    ids = iter(i for i in range(100, 1000) if zlib.crc32(str(i).encode()) % 5 == 1)
    probes = [(next(ids), f"a {w}") for w in ("a", "b", "c", "zz")] + [(next(ids), "a")]
    rows = scoring.score(spark.createDataFrame(train + probes, "doc_id long, text string"), order=2, mass=3.0).collect()
    found = {r["doc_id"]: r for r in rows}
    # The step after "a": the text "a w" less its last step is not given, so take the model's own arithmetic.
    n, kinds, contexts = found[probes[0][0]]["train_tokens"], 4, 2 * len(train)
    counts = {"a": 2, "b": 1, "c": 1, "zz": 0, "</s>": 1}
    after = {"b": len(train), "c": len(train)}
    p1 = {w: (c * len(train) + 0.5) / (n + 0.5 * (kinds + 1)) for w, c in counts.items()}
    p2 = {w: (after.get(w, 0) + 3 * p1[w]) / (contexts + 3) for w in counts}
    assert sum(p1.values()) == pytest.approx(1) and sum(p2.values()) == pytest.approx(1)
    first = (len(train) + 3 * p1["a"]) / (len(train) + 3)
    assert found[probes[4][0]]["score"] == pytest.approx(math.log10(first * p2["</s>"]))


def test_failure_arcs_are_followed_and_states_carried():
    """The states of a walk: what is seen in training after the longest context, else after a shorter one."""
    texts = pa.array(["a b c a b d", "a b c", "b c x a"])
    grams = scoring.Grams(texts, np.array([True, True, False]), 3)
    for k, counts in enumerate(grams.counts):
        assert counts.sum() == {0: 11, 1: 11, 2: 9}[k]
    model = scoring.Automaton(grams, 11, 5, 2.0)
    reached = {s for targets in model.target for s in targets.tolist()}
    assert all(model.length[model.failure[s]] == max(0, model.length[s] - 1) for s in reached if s >= 0)
    # b after the start was not seen: root; c after b was seen, but not after start and b
    third = model.walk(grams)[2]
    p1 = {w: (n + 0.5) / (11 + 3) for w, n in {"a": 3, "b": 3, "c": 2, "d": 1, "x": 0, "</s>": 2}.items()}
    steps = [2 / 4 * p1["b"], (2 + 2 * p1["c"]) / 5, 2 / 4 * 2 / 4 * p1["x"], p1["a"], 2 / 5 * p1["</s>"]]
    assert third == pytest.approx(sum(math.log10(p) for p in steps))


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_long_texts_are_walked_in_segments(monkeypatch, order):
    texts = pa.array([" ".join(f"w{(i * j * j) % 23}" for j in range(700 * i)) for i in range(4)] + ["", "w1"])
    grams = scoring.Grams(texts, np.array([True, True, False, True, True, False]), order)
    model = scoring.Automaton(grams, 2809, 24, 3.0)
    whole = model.walk(grams)
    monkeypatch.setattr(scoring, "SEGMENT", 7)
    assert model.walk(grams) == pytest.approx(whole)


def test_empty_and_untrained(spark, odd_documents, empty_documents):
    assert scoring.score(empty_documents).count() == 0
    assert scoring.score(odd_documents).count() == odd_documents.count()
    alone = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    row = scoring.score(spark.createDataFrame([(alone, "a b")], "doc_id long, text string")).first()
    assert (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"], row["score"]) == (True, 3, 0, 0, 0.0, 0.0)
