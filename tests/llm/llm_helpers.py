"""What the tests of the training-data operators share."""

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    """ASCII capitals as small letters."""
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Names that operators use for what they add or for themselves.
CLASHES = [
    "kept", "block", "slot", "place", "n_words", "score", "component_id", "rep", "key", "n", "u", "v", "bucket", "training",
    "start", "ids", "file", "record", "removed", "epoch", "text_u", "cosine", "item", "turns",
]



def twins(doublings):
    """Two words of letters a and b whose polynomial hashes modulo 2**64 agree for every base from ten doublings on."""
    word = "ab"
    for _ in range(doublings - 1):
        word += word.translate({97: 98, 98: 97})
    return word, word.translate({97: 98, 98: 97})


# One text per twin, for words, and one for runs of letters behind a blank.
TWINS = [text for n in (10, 11, 12) for text in twins(n)]


def smallest(nodes, edges):
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def shingles(text, width):
    words = WORD.findall(lowered(text))
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))) if words else frozenset()


def near_groups(rows, width):
    sets = {i: shingles(t, width) for i, t in rows}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    links = []
    for i, s in sets.items():
        shared = Counter(j for x in s for j in holders[x] if j < i)
        links += [(i, j) for j, n in shared.items() if 100 * n >= 80 * (len(s) + len(sets[j]) - n)]
    return sets, smallest(sets, links)
