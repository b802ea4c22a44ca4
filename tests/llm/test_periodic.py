"""Periodic runs against a scan of every stretch, the query against a plain version of its contract."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lotwise.llm import periodic

SF = "/root/testdata/sf0.001"


def plain_runs(w):
    """Every stretch that stays equal at some lag, kept if long enough and of no smaller period."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            if length >= max(6, 4 * q) and not any(all(w[x] == w[x + p] for x in range(i, i + length - p)) for p in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    w = re.findall("[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2], sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**9))
def test_runs_against_every_stretch(seed):
    rng = random.Random(seed)
    n, k = rng.randint(0, 120), rng.choice([1, 2, 3, 6, 40])
    w = [rng.randrange(k) for _ in range(n)]
    for _ in range(rng.randint(0, 5) if n else 0):
        a, p = rng.randrange(n), rng.randint(1, 12)
        for i in range(a + p, min(n, a + p + rng.randint(1, 60))):
            w[i] = w[i - p]
    assert periodic.runs_of(w) == plain_runs(w)


def test_query_against_the_plain_contract(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = periodic.op13_periodic_runs(spark, SF)
    assert got.columns == names and all(t in ("bigint", "string") for _, t in got.dtypes)
    got = {r.doc_id: tuple(r) for r in got.collect()}
    short = {i: t for i, t in docs.items() if len(t or "") < 6000}
    assert len(got) == len(docs) and len(short) > 150
    assert {i: got[i] for i in short} == {i: plain_row(i, t) for i, t in short.items()}
    assert any(r[1] for r in got.values())


def test_odd_rows(spark):
    rows = [(1, None, 5, "x"), (2, "", None, "x"), (3, " \n\t ", 1, "x"), (None, "a b " * 9, 1, "x"), (4, "a " * 6, 1, None), (4, "a " * 6, 1, None),
            (5, "é   é " * 8, 1, "x"), (6, "a a a a a", 1, "x"), (7, "a b a b a b a b", 1, "x"), (8, "q\x00 " * 7, 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, runs string")
    got = periodic.collapse(docs)
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"]
    by = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()), key=str)
    assert by == sorted([(1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (None, 18, [(0, 18, 2)], "a b"), (4, 6, [(0, 6, 1)], "a"), (4, 6, [(0, 6, 1)], "a"),
                         (5, 16, [(0, 16, 2)], "é   é"), (6, 5, [], "a a a a a"), (7, 8, [(0, 8, 2)], "a b"), (8, 7, [(0, 7, 1)], "q\x00")], key=str)
    assert periodic.collapse(docs.where("false")).count() == 0


def test_a_caller_with_clashing_columns_keeps_the_others(spark):
    docs = spark.createDataFrame([(1, "a " * 8, 7, 8, "s")], "doc_id long, text string, collapsed int, `a column` int, source string")
    assert periodic.collapse(docs).collect() == [(1, 8, "s", 8, [(0, 8, 1)], "a")]


def test_long_texts_cost_little_more_than_their_words():
    rng = random.Random(3)
    layers = [x for d in range(40_000) for x in (d + 1, d, d, d)] + [40_000] * 3  # every cut makes the next word rare
    for w in ([0] * 300_000, [rng.randrange(2) for _ in range(100_000)], [i % 40_000 for i in range(200_000)], layers):
        began = time.time()
        periodic.runs_of(w)
        assert time.time() - began < 20
    assert periodic.runs_of([i % 40_000 for i in range(200_000)]) == [(0, 200_000, 40_000)]


def test_pieces_of_a_long_text_join_whole_words(monkeypatch):
    text = " ".join(random.Random(5).choice(["alpha", "be", "γάμμα"]) for _ in range(500)).encode()
    whole = periodic.words_of(text)
    monkeypatch.setattr(periodic, "PIECE", 7)
    assert periodic.words_of(text) == whole and [whole[1][c] for c in whole[0]] == text.split()


@pytest.mark.parametrize("n", [0, 1, 5, 63, 64, 65, 300])
def test_equal_ahead(n):
    w = np.array([1, 2] * 200 + [3])
    w[2 + n:] = 9 if n < 300 else w[2 + n:]
    assert periodic._equal_ahead(w, 0, 2) == next(i for i in range(len(w)) if i + 2 >= len(w) or w[i] != w[i + 2])
