"""Phrases against a plain count of all of them, the trie against a dictionary."""

import collections
import random
import re

import numpy as np
import pytest

from lotwise.llm import phrases


def plain(rows, least, longest=5):
    """lang, text -> {(lang, phrase): (a, l, r, n, score)} by counting every phrase of every piece."""
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = lang or "und"
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, *w[i:i + k]) for i in range(len(w) - k + 1))
    f = {p: c for p, c in f.items() if c >= least}
    out = {}
    for (lang, *w), a in f.items():
        longer = any(g >= a and q[0] == lang and len(q) - 1 > len(w) and any(list(q[i:i + len(w)]) == w for i in range(1, len(q) - len(w) + 1)) for q, g in f.items())
        if len(w) > 1 and not longer:
            cuts = [(1000 * a * n[lang] // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            out[lang, " ".join(w)] = (a, f[(lang, *w[:k])], f[(lang, *w[k:])], n[lang], score)
    return out


def texts(seed, size=120):
    rng = random.Random(seed)
    vocabulary = [rng.choice(["a", "Bé", "c\x00", "de", "É"]) + str(i % 17) for i in range(40)]
    fixed = [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (2, 3, 4, 5, 6, 7)]
    rows = []
    for _ in range(size):
        parts = [rng.choice(fixed) if rng.random() < 0.4 else rng.choice(vocabulary) for _ in range(rng.randint(0, 30))]
        rows.append((rng.choice(["en", "de", None, "und"]), "".join(p + rng.choice([" ", " ", " ", "\t ", ". ", ",", "\n"]) for p in parts)))
    return rows + [("en", None), (None, ""), ("fr", "x " * 40), ("fr", "..,\n"), ("en", rows[0][1]), ("en", rows[0][1])]


def found(spark, rows, least):
    docs = spark.createDataFrame([(lang, t, i, "x") for i, (lang, t) in enumerate(rows)], "lang string, text string, p int, word string")
    return {(r.lang, r.phrase): (r.a, r.l, r.r, r.n, r.score) for r in phrases.collocations(docs, least).collect()}


def test_against_a_plain_count(spark):
    rows = texts(1)
    want = plain(rows, 8)
    assert found(spark, rows, 8) == want and {len(p.split(" ")) for _, p in want} == {2, 3, 4, 5}


def test_blocks_and_bitmaps_change_nothing(spark, monkeypatch):
    """Dictionary and candidates in several blocks, small blobs, and a bitmap that lets much through."""
    for name, value in (("WORDS", 13), ("CANDIDATES", 20), ("BLOB", 50), ("MOST_BITS", 1 << 16), ("HELD", 10)):
        monkeypatch.setattr(phrases, name, value)
    rows = texts(2, 60)
    assert found(spark, rows, 5) == plain(rows, 5)


def test_nothing_to_find(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert phrases.strongest(phrases.collocations(empty)).count() == 0
    assert found(spark, [("en", "a b c"), (None, None)], 2) == {}


def test_rank_is_by_score_count_and_bytes(spark):
    rows = [("en", "b", 5, 9), ("en", "é", 5, 9), ("en", "z", 6, 9), ("en", "q", 1, 10), ("de", "x", 1, 1)]
    out = phrases.strongest(spark.createDataFrame(rows, "lang string, phrase string, a long, score long"), 3).collect()
    assert sorted((r.lang, r["rank"], r.phrase) for r in out) == [("de", 1, "x"), ("en", 1, "q"), ("en", 2, "z"), ("en", 3, "b")]


@pytest.mark.parametrize("count,vocabulary,k", [(1, 1, 2), (5, 3, 2), (2000, 50, 3), (20_000, 5000, 2), (20_000, 2000, 5)])
def test_double_array_against_a_dictionary(count, vocabulary, k):
    rng = np.random.default_rng(count)
    rows = np.unique((rng.zipf(1.3, size=(count, k)) % vocabulary + 1).astype(np.int32) * 7, axis=0)
    trie = phrases.DoubleArray(rows)
    words = np.concatenate([(rng.zipf(1.3, size=20_000) % vocabulary + 1).astype(np.int32) * 7, rows[:2000].ravel(), [0, 5, 1 << 30]]).astype(np.int32)
    known = {tuple(p): i for i, p in enumerate(rows.tolist())}
    at = np.arange(len(words) - k)
    want = [(i, known[p]) for i in at.tolist() if (p := tuple(words[i:i + k].tolist())) in known]
    assert list(zip(*(x.tolist() for x in trie.accepted(words, at)))) == want and want


def test_products_beyond_64_bits(spark):
    """Counts so large that 1000 a n passes 64 and l r 63 bits: the scores are those of whole numbers."""
    a, n, l, r = 3_000_000_007, 9_000_000_000_011, 4_000_000_009, 5_000_000_021
    got = phrases.scored(spark.createDataFrame([(a, n, l, r), (100, 10**15 - 1, 100, 101), (10**10, 10**14, 3 * 10**10 + 1, 10**10)], "a long, n long, l long, r long")).collect()
    assert [x.score for x in got] == [1000 * x.a * x.n // (x.l * x.r) for x in got]
