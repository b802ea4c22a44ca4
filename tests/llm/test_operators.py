"""Each operator against a brute-force version on small tables, with the odd cases its docstring names."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lotwise.llm import chat, decontamination, edit_prints, language_model, licenses, mixing, quality, sharding, simhash, substrings

SF = "/root/testdata/sf0.001"
SPACED = re.compile("[^\x20\x09-\x0D]+")
LETTERS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard int, _row int, size string, words int"


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, wordless and long texts, ties, repeated rows, clashing extra columns."""
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    prose = [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (40, 60, 80, 30, 25)]
    long = " ".join(rng.choice(vocabulary) for _ in range(30_000))
    texts = [None, "", " \n\t ", "...", "One", "one TWO", prose[0], prose[0], prose[0] + " tail", prose[1] + "\n" + prose[2], prose[2], prose[3] + " " + prose[1],
             "é" * 50, "The MIT License, version x.\n" + prose[4], long, "x " * 5000, prose[4][:60], "Ünï " + prose[3]]
    rows = [(i, t, "en", ["a", "b", None, "é"][i % 4], len(t or ""), 1, 2, "s", 3) for i, t in enumerate(texts)]
    rows += [rows[6], rows[6], (None, prose[0], None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None),
             (3, prose[1], "en", "a", 1, 1, 1, "s", 1)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


def docs_of(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet")


# --- sharding

def test_shards_are_balanced_and_gapless(spark, odd, none):
    for df, shards in ((odd, 4), (docs_of(spark), 7), (none, 3)):
        out = sharding.shard(df.drop("shard"), ["doc_id"], shards, vnodes=8).collect()
        assert len(out) == df.count()
        by = collections.defaultdict(list)
        for r in out:
            by[r.shard].append(r.slot)
        sizes = [len(by[s]) for s in range(shards)]
        assert max(sizes) - min(sizes) <= 1
        assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_a_clashing_column_is_replaced_and_others_stay(odd):
    out = sharding.shard(odd, ["doc_id", "text"], 3, vnodes=4)
    assert sorted(out.columns) == sorted(odd.columns + ["slot"])
    assert sorted(map(str, out.drop("shard", "slot").collect())) == sorted(map(str, odd.drop("shard").collect()))


def test_a_new_shard_moves_few_rows(spark):
    rows = spark.range(5000).withColumnRenamed("id", "doc_id")
    old, new = ({r.doc_id: r.shard for r in sharding.shard(rows, ["doc_id"], n, slack=0.25).collect()} for n in (20, 21))
    assert sum(old[i] != new[i] for i in old) < 0.2 * len(old)
    assert max(collections.Counter(new.values()).values()) <= math.ceil(1.25 * 5000 / 21) + 1


def test_walk_against_one_row_at_a_time(spark):
    """The same rule played row by row: own rows by ring order up to the room, the rest clockwise."""
    shards, vnodes, n = 3, 4, 200
    ring = [(r.cell, r.stop, r.shard) for r in sharding._ring(spark, shards, vnodes).collect() if r.cell is not None]
    stop_of, shard_of = {c: s for c, s, _ in ring}, {s: h for _, s, h in ring}
    rows = spark.range(n).withColumnRenamed("id", "doc_id").withColumn("c", sharding.cell_of(F.col("doc_id"))).collect()
    room = {s: n // shards + (s < n % shards) for s in range(shards)}
    order = sorted(rows, key=lambda r: (stop_of[r.c], r.c, r.doc_id))
    load, place, over = collections.Counter(), {}, []
    for r in order:
        home = shard_of[stop_of[r.c]]
        if load[home] < room[home]:
            place[r.doc_id] = home
            load[home] += 1
        else:
            over.append(r)
    stops = sorted(set(stop_of.values()) | set(range(shards * vnodes)))
    shard_at = {r.stop: r.shard for r in sharding._ring(spark, shards, vnodes).select("stop", "shard").distinct().collect()}
    waiting = collections.deque()
    for lap in range(2):
        for s in stops:
            if lap == 0:
                waiting.extend(r for r in over if stop_of[r.c] == s)
            while waiting and load[shard_at[s]] < room[shard_at[s]]:
                place[waiting.popleft().doc_id] = shard_at[s]
                load[shard_at[s]] += 1
    got = {r.doc_id: r.shard for r in sharding.shard(spark.range(n).withColumnRenamed("id", "doc_id"), ["doc_id"], shards, vnodes).collect()}
    assert got == place


# --- language model

def test_scores_counts_and_normalises(spark, odd, none):
    docs = odd.select("doc_id", "text", language_model.held_out(F.col("doc_id")).alias("held_out"))
    got = language_model.score(docs).collect()
    rows = [(r.doc_id, low(r.text)) for r in odd.collect()]
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    counts = collections.Counter()
    for i, t in rows:
        if not held[i]:
            counts.update(SPACED.findall(t) + [None])
    n, v = sum(counts.values()), len(counts)
    want = sorted((i is None, i, len(SPACED.findall(t)) + 1, sum(counts[w] > 0 for w in SPACED.findall(t) + [None]),
                   round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in SPACED.findall(t) + [None]), 6)) for i, t in rows if i is not None)
    have = sorted((r.doc_id is None, r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got if r.doc_id is not None)
    assert have == want and all(r.train_tokens == n and r.held_out == held[r.doc_id] for r in got)
    assert len(got) == len(rows) and all(r.score < 0 for r in got)
    assert language_model.score(none.select("doc_id", "text", F.lit(False).alias("held_out"))).count() == 0
    nothing_learned = language_model.score(odd.select("doc_id", "text", F.lit(True).alias("held_out"))).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in nothing_learned)


def test_probabilities_sum_to_one():
    m = language_model.LogBilinear(shares=np.full(language_model.UNITS, 1 / language_model.UNITS))
    contexts = np.array([[5, 7], [0, 9], [3, 3]])
    each = [m.log10(contexts, np.full(2, u)) for u in range(language_model.UNITS)]
    assert np.allclose((10.0 ** np.array(each)).sum(axis=0), 1, atol=1e-4)


def test_noise_contrastive_training_learns_a_bigram():
    rng = np.random.default_rng(1)
    shares = np.full(language_model.UNITS, 1e-6)
    shares[1:5] = 0.25
    shares /= shares.sum()
    m = language_model.LogBilinear(shares=shares)
    for _ in range(200):
        previous = rng.integers(1, 5, 512)
        m.learn(np.stack([previous, np.zeros_like(previous), np.zeros_like(previous)]), previous % 4 + 1, shares, rng)
    assert m.log10(np.array([[1], [0], [0]]), np.array([2]))[0] > math.log10(0.9)


def test_held_out_text_is_better_than_by_counts_alone(spark):
    got = language_model.op2_language_model(spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def test_the_model_grows_with_the_distinct_words():
    assert language_model.UNITS >= 512 and language_model.NOISE >= 64
    sizes = [1 + sum(language_model.unit_counts(n)) for n in (0, 10**5, 10**6, 10**8)]
    assert sizes == [512, 512, 1000, 10_000]
    shares = np.random.default_rng(3).random(1000)
    shares /= shares.sum()
    m = language_model.LogBilinear(shares=shares)
    contexts = np.array([[5, 907], [0, 999], [3, 3]])
    each = np.array([m.log10(contexts, np.full(2, u)) for u in range(1000)])
    assert np.allclose((10.0 ** each).sum(axis=0), 1, atol=1e-4)
    # the next of two units that the small model would give no vector of their own
    for _ in range(200):
        previous = np.random.default_rng(2).integers(700, 702, 512)
        m.learn(np.stack([previous, np.zeros_like(previous), np.zeros_like(previous)]), 1401 - previous, shares)
    assert m.log10(np.array([[700], [0], [0]]), np.array([701]))[0] > math.log10(0.9)


# --- simhash

def brute_prints(texts):
    import xxhash

    out = []
    for t in texts:
        w = SPACED.findall(low(t))
        shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        out.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    return out


def test_fingerprints_and_components(spark, odd, none):
    rows = odd.select("doc_id", "text").collect()
    got = simhash.labelled(simhash.fingerprints(odd)).collect()
    want = brute_prints([r.text for r in rows])
    assert sorted((str(r.doc_id), r.fingerprint & 2**64 - 1) for r in got) == sorted((str(r.doc_id), p) for r, p in zip(rows, want))
    assert simhash.labelled(simhash.fingerprints(none)).count() == 0


def test_links_and_chains_against_all_pairs(spark):
    rng = random.Random(8)
    prints = []
    for _ in range(60):
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 8)):
            prints.append(x)
            for b in rng.sample(range(64), rng.randint(1, 4)):
                x ^= 1 << b
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    df = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fingerprint long")
    distinct = sorted(set(signed))
    pairs = {(a, b) for a in distinct for b in distinct if a < b and ((a ^ b) & 2**64 - 1).bit_count() <= 3}
    assert {tuple(r) for r in simhash.pairs(df.select(F.col("fingerprint").alias("fp")).distinct()).collect()} == pairs
    parent = {x: x for x in distinct}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in pairs:
        parent[find(a)] = find(b)
    least = {}
    for i, x in enumerate(signed):
        least[find(x)] = min(least.get(find(x), i), i)
    assert {r.doc_id: r.component_id for r in simhash.labelled(df).collect()} == {i: least[find(x)] for i, x in enumerate(signed)}


def test_one_of_each_group_stays(spark, odd, none):
    kept = simhash.near_duplicates(odd.withColumn("fingerprint", F.lit(1)).drop("fingerprint"))
    assert kept.columns == odd.columns
    prints = brute_prints([r.text for r in kept.collect()])
    assert all((a ^ b).bit_count() > 3 for i, a in enumerate(prints) for b in prints[:i])
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert 0 in ids and 6 in ids and 7 not in ids
    assert simhash.near_duplicates(none).count() == 0


# --- mixing

def test_targets_and_taken(spark, odd, none):
    rows = odd.select("source", "doc_id", mixing.words_of(F.col("text")).alias("size"))
    for df in (rows, rows.limit(1), none.select("source", "doc_id", F.lit(0).cast("long").alias("size")),
               docs_of(spark).select("source", "doc_id", mixing.words_of(F.col("text")).alias("size"))):
        got = mixing.taken(df).collect()
        assert len(got) == df.count()
        sizes = collections.Counter()
        for r in df.collect():
            sizes[r.source] += r["size"]
        total = sum(sizes.values())
        names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
        weight = {s: i % 3 + 1 for i, s in enumerate(names)}
        target, left = {}, dict(weight)
        while left:
            level = (total - sum(target.values())) / sum(left.values())
            over = [s for s in left if level * weight[s] >= 3 * sizes[s]]
            for s in over:
                target[s] = 3.0 * sizes[s]
                del left[s]
            if not over:
                target |= {s: level * weight[s] for s in left}
                break
        took = collections.Counter()
        for r in got:
            took[r.source] += r.taken
            assert 0 <= r.taken <= 3 * r["size"] and r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6
        assert all(abs(took[s] - target[s]) <= 1 for s in names)
        assert sorted(map(str, got)) == sorted(map(str, mixing.taken(df).collect()))


def test_pieces_cover_what_is_taken(spark):
    rows = docs_of(spark).select("source", "doc_id", mixing.words_of(F.col("text")).alias("size"))
    placed, pieces = mixing.mix(rows)
    size = {(r.nth, r["at"]): r["size"] for r in placed.where("size > 0").collect()}
    times = collections.Counter()
    for r in pieces.collect():
        assert 0 <= r.from_word < r.to_word <= size[r.nth, r["at"]]
        times.update((r.nth, r["at"], w) for w in range(r.from_word, r.to_word))
    assert max(times.values()) <= 3


def test_slots_of_a_source_are_spread_evenly(spark):
    rows = docs_of(spark).select("source", "doc_id", mixing.words_of(F.col("text")).alias("size"))
    goal = mixing.targets(rows)
    turns = sorted((r.slot, r.nth) for r in mixing.schedule(goal).collect())
    share = {r.nth: r.target / r.all_words for r in goal.collect()}
    seen = collections.Counter()
    for i, (_, nth) in enumerate(turns, 1):
        seen[nth] += 1
        assert abs(seen[nth] - share[nth] * i) < 6


def test_whole_documents_by_the_mix(odd, none):
    out = mixing.mixed(odd)
    assert out.columns == odd.columns
    counts = collections.Counter((r.doc_id, r.text) for r in out.collect())
    there = collections.Counter((r.doc_id, r.text) for r in odd.collect())
    assert set(counts) <= set(there) and all(n <= 3 * there[k] for k, n in counts.items())
    assert mixing.mixed(none).count() == 0


# --- decontamination

def test_fm_index_finds_every_place():
    rng = random.Random(3)
    for _ in range(150):
        sequence = np.array([rng.randint(0, 3) for _ in range(rng.randint(1, 60))])
        phrases = [[rng.randint(1, 4) for _ in range(rng.randint(1, 4))] for _ in range(10)]
        codes = np.zeros((10, 4), dtype=np.int64)
        for row, p in zip(codes, phrases):
            row[4 - len(p):] = p
        index = decontamination.FMIndex(sequence, sampled=4)
        who, lows, highs = index.search(codes, np.array(list(map(len, phrases))))
        got = {w: sorted(index.locate(np.arange(a, z)).tolist()) for w, a, z in zip(who, lows, highs)}
        for i, p in enumerate(phrases):
            assert got.get(i, []) == [j for j in range(len(sequence) - len(p) + 1) if sequence[j:j + len(p)].tolist() == p]


def brute_hits(docs, items):
    windows = collections.defaultdict(set)
    for item, text in items:
        w = LETTERS.findall(low(text))
        for k in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[k:k + 13])] |= {str(item)} if item is not None else set()
    sizes = {len(k) for k in windows}
    out = []
    for doc_id, text in docs:
        w, hit, found = LETTERS.findall(low(text)), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k:k + n])]
        out.append((str(doc_id), len(w), len(hit), ",".join(sorted(found)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


@pytest.mark.parametrize("slice_bytes", [1 << 24, 200])
def test_spans_against_brute_force(spark, odd, none, monkeypatch, slice_bytes):
    monkeypatch.setattr(decontamination, "SLICE_BYTES", slice_bytes)
    texts = [r.text for r in odd.orderBy("doc_id").collect() if r.text and len(r.text) < 2000]
    items = [(1, texts[-1][:90]), (2, texts[5] + " more"), (2, texts[6]), (None, texts[4]), (5, None), (6, "..."), (7, "ONE"), (8, texts[3] + " " + texts[3])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.judged(decontamination.removal_spans(odd, benchmark, ["doc_id"])).collect()
    have = sorted((str(r.doc_id), r.n_words, r.n_hit, ",".join(r["items"]), r.contaminated) for r in got)
    assert have == brute_hits([(r.doc_id, r.text) for r in odd.collect()], items)
    clean = decontamination.decontaminate(odd, benchmark)
    assert clean.columns == odd.columns and clean.count() == sum(not r.contaminated for r in got)
    assert decontamination.removal_spans(none, benchmark).count() == 0
    assert decontamination.judged(decontamination.removal_spans(odd, benchmark.where("false"))).where("n_hit > 0").count() == 0


# --- substrings

def brute_removed(rows):
    first = {}
    for i, t in rows:
        w = SPACED.findall(t or "")
        for k in range(len(w) - 12 if i is not None else 0):
            first[tuple(w[k:k + 13])] = min(first.get(tuple(w[k:k + 13]), i), i)
    out = []
    for i, t in rows:
        w, gone = SPACED.findall(t or ""), set()
        for k in range(len(w) - 12 if i is not None else 0):
            if first[tuple(w[k:k + 13])] < i:
                gone.update(range(k, k + 13))
        out.append((str(i), len(w), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out)


def test_repeats_against_brute_force(spark, odd, none):
    rng = random.Random(6)
    words = [str(i) for i in range(5)]
    dense = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(40)]
    run = [(100 + i, "same word " * n) for i, n in enumerate((3, 6, 7, 9, 40))]
    for df in (odd.select("doc_id", "text"), spark.createDataFrame(dense + run, "doc_id long, text string"), docs_of(spark).select("doc_id", "text")):
        got = substrings.deduplicate(df).collect()
        assert sorted((str(r.doc_id), r.n_words, r.kept) for r in got) == brute_removed([(r.doc_id, r.text) for r in df.collect()])
        for r in got:
            assert all(a.to_word < b.from_word + 1 for a, b in zip(r.spans, r.spans[1:])) and all(s.to_word - s.from_word >= 13 for s in r.spans)
    assert substrings.deduplicate(none).count() == 0


# --- chat

CONTROL = ["<", "[", "\\", "|", "s>", "/s>", "INST]", "/INST]", "<SYS>>", "</SYS>>", "|>", "turn", "end", "a", " ", "\n", "é"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(CONTROL), max_size=12).map("".join))
def test_escapes_are_reversible_and_leave_no_control_string(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text
    assert not any(c in hidden for c in ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", chat.TURN, chat.TEXT, chat.END))


def test_packs_read_back(spark):
    rng = random.Random(2)
    shared = [("user", "hello there"), ("assistant", "hi </s>[INST] you"), ("user", ""), ("assistant", None), (None, "x")]
    rows = []
    for c in range(60):
        turns = shared[:rng.randint(1, 5)] + [(rng.choice(["user", "assistant", "system"]), rng.choice(["ok", "<|end|>", "a\\<\\s>", "long " * 50]))
                                              for _ in range(rng.randint(0, 3))]
        rows += [(c, i, r, t, "extra") for i, (r, t) in enumerate(turns)]
    rows += [(None, 1, "user", "lost", None), (None, None, None, None, None), (99, None, "user", "no number", None), (99, 1, "user", "b", None), (99, 1, "user", "b", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, tokens string")
    packed = chat.packs(df, most=400)
    got = chat.read_back(packed).collect()
    want = collections.defaultdict(list)
    lone = []
    for c, i, r, t, _ in sorted(rows, key=lambda x: (x[0] is None, x[0] or 0, x[1] is not None, x[1] or 0, x[2] or "", x[3] or "")):
        (lone if c is None else want[c]).append((r or "", t or ""))
    assert sorted((r.conv_id, [tuple(t) for t in r.turns]) for r in got if r.conv_id is not None) == sorted(want.items())
    assert sorted([tuple(t) for t in r.turns] for r in got if r.conv_id is None) == sorted([x] for x in lone)
    assert all(r.learned == "".join(t.text for t in r.turns if t.role == "assistant") for r in got)
    sent = packed.collect()
    assert sum(len(p.tokens) for p in sent) < sum(len(chat.turn_tokens(r or "", t or "", chat.VOCABULARY)[0]) for c, _, r, t, _ in rows)
    assert chat.packs(df.where("false")).count() == 0


def test_a_token_sees_its_own_conversation_only(spark):
    pack = chat.Pack(chat.VOCABULARY)
    a, b, c = ("user", "a"), ("assistant", "b"), ("assistant", "c")
    pack.add(1, [a, b])
    pack.add(2, [a, c])
    tokens, positions, until, loss, ends = pack.row()
    last = ends[1]["last"]
    seen = [i for i in range(last + 1) if until[i] > last]
    assert [positions[i] for i in seen] == list(range(len(seen)))
    assert chat.parse(chat.decode([tokens[i] for i in seen], chat.VOCABULARY)) == [a, c]


# --- licenses

def test_base_phrases_against_brute_force(spark, odd, none):
    more = spark.createDataFrame([(50, "mit license MIT LICENSE mit. license apache license general public license"), (51, "the mit\nlicenses"),
                                  (52, "Licensed under the Apache License, Version 2.0."), (53, "CC BY-NC 4.0"), (54, "All rights reserved"), (55, "license")],
                                 "doc_id long, text string")
    for df in (odd.select("doc_id", "text"), more, docs_of(spark).select("doc_id", "text")):
        texts = collections.defaultdict(list)
        for r in df.collect():
            texts[r.doc_id].append(r.text)
        for r in licenses.scan(df).collect():
            w = [LETTERS.findall(low(t)) for t in texts[r.doc_id]]
            want = [(len(x), sorted((i, i + len(p.split()), label) for p, label in licenses.BASE for i in range(len(x)) if x[i:i + len(p.split())] == p.split())) for x in w]
            assert (r.n_words, sorted((b.s, b.e, b.label) for b in r.base)) in want
            assert 0 <= r.score <= 1 and {b.label for b in r.base} <= set(r.labels) and r.labels == sorted(set(r.labels))
    assert licenses.scan(none).count() == 0


def test_signatures_against_a_plain_scan(spark):
    """All rules tried everywhere, sorted and swept one by one."""
    texts = ["Licensed under the Apache License, Version 2.0 (the License)", "GPL 2.0 or later; see the GNU General Public License v3", "a BSD 3-Clause License and MIT",
             "This work is licensed under CC BY-SA 4.0", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
             "some license", "released into the public domain", "Mozilla Public License, version 2.0 or Eclipse Public License 2.0", "0BSD", "open rail m license"]
    got = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()
    for r in got:
        norm = " " + " ".join(LETTERS.findall(low(texts[r.doc_id]))) + " "
        found = []
        for n, (priority, _, label, _, pattern) in enumerate(licenses.rules()):
            for m in re.finditer(rf"(?<= )(?:{pattern})(?= )", norm):
                s = norm[:m.start()].count(" ") - 1
                found.append((s, -(s + m.group().count(" ") + 1), priority, n, label))
        kept, till = [], -1
        for s, back, priority, n, label in sorted(found):
            if -back > till:
                kept.append((s, -back, priority, label))
                till = -back
        if any(k[2] < 9 for k in kept):
            kept = [k for k in kept if k[2] < 9]
        assert [(d.first_word, d.end_word, d.label) for d in r.detections] == [(s, e, label) for s, e, _, label in kept], texts[r.doc_id]


def test_keywords_let_both_spellings_through():
    for _, _, label, keyword, pattern in licenses.rules():
        for one, other in (("license", "licence"), ("licence", "license")):
            assert one not in keyword or pattern.replace("licen[sc]e", other).count(other) == pattern.count(other), (label, keyword)


def test_british_spellings_keep_their_labels(spark):
    texts = ["llama 2 community licence", "llama 2 community license", "a commercial licence", "a commercial license"]
    got = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()
    assert {r.doc_id: r.labels for r in got} == {0: ["llama"], 1: ["llama"], 2: ["proprietary"], 3: ["proprietary"]}


def test_there_are_hundreds_of_rules():
    assert len(licenses.rules()) > 200


# --- quality

def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(0)
    lines = np.array([4, 1, 3])
    unary, pairs = rng.normal(size=8), rng.normal(size=(2, 2))
    forward, backward = quality._chain(unary, lines, pairs)
    at = 0
    for n in lines:
        weight = {}
        for path in range(2 ** n):
            s = [path >> i & 1 for i in range(n)]
            weight[tuple(s)] = math.exp(sum(unary[at + i] * x for i, x in enumerate(s)) + sum(pairs[a, b] for a, b in zip(s, s[1:])))
        for i in range(n):
            good = sum(w for s, w in weight.items() if s[i]) / sum(weight.values())
            assert abs(1 / (1 + math.exp(-(forward + backward)[at + i])) - good) < 1e-9
        at += n


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = quality.op9_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) / len(got) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)


def test_odd_documents_and_labels(spark, odd, none):
    labels = spark.createDataFrame([(0, 1), (1, None), (None, 1), (6, 1), (6, 0), (7, 1), (15, 0), (14, 1), (999, 0)], "doc_id long, quality int")
    field = quality.learn(odd, labels)
    got = quality.scored(odd, field, odd.columns)
    assert got.count() == odd.count() and got.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert got.columns == [*odd.columns, "score", "predicted"]
    assert {r.score for r in quality.scored(odd, quality.learn(odd, labels.where("false")), ["doc_id"]).collect()} == {0.5}
    assert quality.scored(none, field, ["doc_id"]).count() == 0
    assert set(quality.filter_good(odd, labels).columns) == set(odd.columns)


def test_nothing_goes_when_nothing_was_learned(odd):
    labels = odd.sparkSession.createDataFrame([(0, None), (None, 1), (999, 0)], "doc_id long, quality int")
    for none_usable in (labels, labels.where("false")):
        kept = quality.filter_good(odd, none_usable)
        assert kept.columns == odd.columns and kept.count() == odd.count()


# --- edit prints

def test_edited_texts_and_prints(spark, odd, none):
    for df in (docs_of(spark).select("doc_id", "text"), odd.select("doc_id", "text"), odd.select("doc_id", "text").limit(1), none.select("doc_id", "text")):
        rows = sorted(((r.doc_id, r.text or "") for r in df.collect()), key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5(r[1].encode()).hexdigest()))
        want = []
        for i, (doc_id, text) in enumerate(rows):
            cut = len(text) // 3
            after = rows[(i + 1) % len(rows)][1]
            edited = text[:len(text) - cut] + after[:cut]
            prints = [edit_prints.print_of(edit_prints.lowest(edit_prints.walk(p)[:-1], p)) for p in map(edit_prints.code_points, (text, edited, after))]
            want.append((str(doc_id), len(text), hashlib.sha256(edited.encode()).hexdigest(), prints[0].hex(), prints[1].hex(),
                         edit_prints.likeness(prints[0], prints[1]), edit_prints.likeness(prints[0], prints[2])))
        got = edit_prints.edit_prints(df).collect()
        assert sorted((str(r.doc_id), *list(r)[1:]) for r in got) == sorted(want)


def test_likeness_falls_with_edits():
    rng = random.Random(5)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(6000))

    def edited(n):
        out = text
        for _ in range(n):
            i = rng.randrange(len(out))
            out = out[:i] + rng.choice("abcxyz") + out[i + rng.randint(0, 1):]
        return out

    def fp(t):
        p = edit_prints.code_points(t)
        return edit_prints.print_of(edit_prints.lowest(edit_prints.walk(p)[:-1], p))
    near = [np.mean([edit_prints.likeness(fp(text), fp(edited(n))) for _ in range(6)]) for n in (0, 3, 40, 1500)]
    assert near[0] == 1 and near[0] > near[1] > near[2] > near[3] and near[1] > 0.7


def test_links_reach_every_near_copy(spark):
    rng = random.Random(9)
    texts = []
    for _ in range(12):
        text = "".join(rng.choice("abcdefghijklmnopqrst ") for _ in range(2000))
        texts += [text] + [text[:i] + "#" + text[i + 1:] for i in rng.sample(range(2000), 6)]
    prints = edit_prints.edit_prints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    by = {r.doc_id: r.fingerprint for r in prints}
    links = edit_prints.near_links(spark.createDataFrame([(f,) for f in by.values()], "fingerprint string")).collect()
    parent = {f: f for f in by.values()}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for r in links:
        assert r.near >= edit_prints.LIKE
        parent[find(r.a)] = find(r.b)
    groups = [{find(by[7 * g + i]) for i in range(7)} for g in range(12)]
    assert sum(len(g) == 1 for g in groups) >= 11 and len(set.union(*groups)) >= 12
    assert edit_prints.near_links(spark.createDataFrame([], "fingerprint string")).count() == 0


def _print(cells):
    return bytes(cells).hex()


def test_all_alike_members_of_a_bucket_are_joined():
    a = [1] * 128
    c = [1] * 100 + [2] * 28
    b = [1] * 72 + [2] * 56  # alike to c, not to a
    names = {_print(x): n for x, n in ((a, "a"), (b, "b"), (c, "c"))}
    assert edit_prints.likeness(bytes(a), bytes(b)) < edit_prints.LIKE <= edit_prints.likeness(bytes(c), bytes(b))
    for order in ("abc", "cab", "acb"):
        found = {frozenset((names[x], names[y])) for x, y, _ in edit_prints._search([p for n in order for p in names if names[p] == n], edit_prints.LIKE)}
        assert found == {frozenset("ac"), frozenset("bc")}


def test_the_query_classes_every_near_copy(spark):
    rng = random.Random(11)
    first = [[rng.randrange(255) for _ in range(128)] for _ in range(60)]
    rows = []
    for g, cells in enumerate(first):
        there = set(rng.sample(range(128), 86))  # the limit: two thirds of the cells stay
        rows += [(10 * g + 5, _print(cells)), (10 * g + 3, _print([x if i in there else (x + 1) % 255 for i, x in enumerate(cells)])), (10 * g + 4, _print(cells))]
    rows += [(9001, _print([255] * 128)), (9000, _print([7] + [255] * 127))]
    df = spark.createDataFrame(rows, "doc_id long, fingerprint string")
    got = {r.doc_id: (r.near_class, r.n_links) for r in edit_prints.with_classes(df).collect()}
    want = {10 * g + i: (10 * g + 3, 1) for g in range(60) for i in (3, 4, 5)} | {9001: (9001, 0), 9000: (9000, 0)}
    assert got == want
    out = edit_prints.op10_edit_prints(spark, SF)
    assert {"near_class", "n_links"} <= set(out.columns) and out.count() == docs_of(spark).count()
