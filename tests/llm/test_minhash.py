"""Near-duplicate components against all pairs of sets."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.llm import minhash
from lotwise.llm.substrings import word_hashes


def shingles(text):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").split()  # the tests' texts hold no other blanks
    return frozenset([tuple(w)] if 0 < len(w) < 3 else zip(w, w[1:], w[2:]))


def plain(rows):
    """doc_id -> smallest id reachable over links of all pairs."""
    sets = {}
    for i, t in rows:
        sets.setdefault(shingles(t), set()).add(i)
    nodes = [s for s in sets if s]
    parent = {s: s for s in nodes}

    def top(s):
        while parent[s] != s:
            s = parent[s]
        return s

    for a, b in itertools.combinations(nodes, 2):
        if 100 * len(a & b) >= 85 * len(a | b):
            parent[top(a)] = top(b)
    low = {}
    for s in nodes:
        low[top(s)] = min(sets[s] | {low.get(top(s), 1 << 60)})
    return {i: low[top(s)] if s else i for s, ids in sets.items() for i in ids}


def edited(rng, words, changes, vocabulary):
    out = list(words)
    for _ in range(changes):
        out[rng.randrange(len(out))] = rng.choice(vocabulary)
    return out


@pytest.fixture(scope="module")
def copies():
    """Groups around a base and chains of edits, with similarities on both sides of the threshold, and copies."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(900)]
    texts = []
    for size, changes in ((40, 3), (60, 5), (30, 8), (2, 2), (2, 4)):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(60, 160))]
        texts += [" ".join(edited(rng, base, rng.randint(0, changes), vocabulary)) for _ in range(size)]
    chain = [rng.choice(vocabulary) for _ in range(100)]
    for _ in range(25):
        chain = edited(rng, chain, 2, vocabulary)
        texts.append(" ".join(chain))
    texts += ["one", "ONE", "one two", "One  two\n", "one two three", "", "  ", texts[0].upper(), texts[50]]
    texts += [" ".join(rng.choice(vocabulary) for _ in range(80)) for _ in range(40)]
    rng.shuffle(texts)
    return list(enumerate(texts))


def components_of(spark, rows):
    return {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}


def test_components_against_all_pairs(spark, copies):
    assert components_of(spark, copies) == plain(copies)


def test_blocks_of_a_bucket_find_the_same(spark, copies, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    assert components_of(spark, copies) == plain(copies)


def test_odd_rows(spark):
    a, b = "the quick brown fox jumps over the lazy dog again", "quite another text that nobody has written before now"
    rows = [(5, a, "x"), (3, a, "x"), (3, a, "x"), (None, a, None), (None, b, None), (None, b, "x"), (7, None, "x"), (8, "", "x"), (9, " \n", "x"), (3, b + " z", "x"), (4, "Hi", "x"), (6, "hi ", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string").withColumn("sig", F.lit(1))
    found = minhash.near_duplicates(docs).collect()
    got = sorted((r.doc_id is None, r.doc_id, r.n_shingles, r.component_id) for r in found if r.doc_id is not None)
    n = len(shingles(a))
    assert got == sorted([(False, 5, n, 3), (False, 3, n, 3), (False, 3, n, 3), (False, 7, 0, 7), (False, 8, 0, 8), (False, 9, 0, 9),
                          (False, 3, len(shingles(b + " z")), 3), (False, 4, 1, 4), (False, 6, 1, 4)])
    nameless = sorted((r.n_shingles, r.component_id) for r in found if r.doc_id is None)
    assert nameless[-1] == (n, 3) and all(c is None or c == 3 for _, c in nameless) and len(nameless) == 3
    assert minhash.near_duplicates(docs.where("false")).count() == 0


def test_a_large_group_is_merged_by_its_hub(spark):
    """A thousand variants of a text: the hub links them, so no unit is left with pairs to compare."""
    rng = random.Random(2)
    base = [f"w{rng.randrange(3000)}" for _ in range(200)]
    rows = [(i, " ".join([*base[:100], f"new{i}", *base[101:]])) for i in range(1000)]
    assert set(components_of(spark, rows).values()) == {0}


def test_posterior_bound():
    """The bound is the smallest count whose posterior tail reaches the chosen miss probability."""
    rng = np.random.default_rng(0)
    for n, least in minhash.LEAST_EQUAL:
        t = 0.85 + 0.15 / 256
        tail = lambda m: (rng.beta(m + 1, n - m + 1, 200_000) >= t).mean()
        assert tail(min(least + n // 8, n)) > 1e-5 and (least == 0 or tail(least - 1) < 1e-4)
    assert minhash.least_equal(256) > minhash.least_equal(128) > minhash.least_equal(32) > 0


def test_signatures_estimate_similarity():
    rng = random.Random(1)
    words = [f"w{rng.randrange(10**6)}" for _ in range(2000)]
    a, b = (" ".join(w).encode() for w in (words, words[:1900] + [f"v{i}" for i in range(100)]))
    sets = [minhash.shingle_set(word_hashes([t])[0]) for t in (a, b)]
    same = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
    sigs = np.array([np.frombuffer(minhash.signature(s), np.uint8) for s in sets])
    assert abs((sigs[0] == sigs[1]).mean() - same) < 0.08
    assert minhash.plausible(sigs[:1], sigs[1:])[0] and not minhash.plausible(sigs[:1], np.roll(sigs[1:], 1, axis=1))[0]
    assert len(sets[0]) == len(shingles(a.decode()))
