"""Benchmark decontamination with an FM-index over each batch of training texts.

Test phrases are the windows of 13 consecutive words of each benchmark item (a shorter item
is one window).  A task turns a batch of texts into one sequence of word numbers: words
that no item has, and places between words that no item has side by side, end a run, and
only runs as long as the shortest window are kept, so what can't be part of a match is
never indexed.  Over that sequence it builds the suffix array by prefix doubling, the
Burrows-Wheeler transform and a wavelet matrix with rank blocks, searches all windows
backward at once, walks from each match to a sampled suffix position and merges the
matched places of a text into removal spans.

The benchmark is read in slices of bounded bytes (``SLICE_BYTES``): one slice is on the driver
and in the tasks at a time, a larger benchmark takes more passes over the texts, and the
spans of all passes are merged.  Texts never leave their row: no shuffle, no group.

Defined results: a null or wordless text has no words, no spans and isn't contaminated; a
null or wordless item has no windows; an item without an id marks words as hit but can't be
listed; items sharing an id count once; repeated rows give repeated results; an empty
benchmark hits nothing, an empty table gives no rows; kept columns come back unchanged, those
named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.base import query, table

WINDOW = 13
SLICE_BYTES = 16 << 20
BATCH_BYTES = 16 << 20
SAMPLED = 32  # every how many positions a suffix position is kept

#: Bytes of words stay, A-Z lower-cased; all others become blanks.
TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(TO_WORDS).split()


@dataclass
class Phrases:
    """The distinct windows of a slice of the benchmark, as word numbers."""

    vocabulary: dict[bytes, int]
    codes: np.ndarray  # (windows, longest), right-aligned, 0 before the start
    lengths: np.ndarray
    items: list[list[str]]  # ids of each window's items
    pairs: np.ndarray  # sorted codes of words that stand side by side in an item

    @classmethod
    def of(cls, rows: list[tuple[str | None, bytes]], window: int = WINDOW) -> Phrases:
        vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        pairs: set[tuple[int, int]] = set()
        for item, text in rows:
            ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words(text)]
            pairs.update(zip(ids, ids[1:]))
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                owners.setdefault(tuple(ids[i:i + window]), set()).update([item] if item is not None else [])
        longest = max(map(len, owners), default=1)
        codes = np.zeros((len(owners), longest), dtype=np.int64)
        for row, phrase in zip(codes, owners):
            row[longest - len(phrase):] = phrase
        side = np.array(sorted(a << 32 | b for a, b in pairs), dtype=np.int64)
        return cls(vocabulary, codes, np.fromiter(map(len, owners), np.int64, len(owners)), [sorted(x) for x in owners.values()], side)


class Bits:
    """A bit vector with counts before each 64-bit word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(np.concatenate([bits, np.zeros(64 + -len(bits) % 64, dtype=bool)]), bitorder="little").view("<u8")
        self.words = packed
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        at, rest = i >> 6, (i & 63).astype(np.uint64)
        return self.before[at] + np.bitwise_count(self.words[at] & ((np.uint64(1) << rest) - np.uint64(1)))

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)


class FMIndex:
    """Backward search over a sequence of symbols; 0 separates runs and matches nothing."""

    def __init__(self, sequence: np.ndarray, sampled: int = SAMPLED):
        text = np.concatenate([sequence, [0]]).astype(np.int64)
        order = self._suffixes(text)
        n, self.levels = len(text), max(1, int(text.max()).bit_length())
        self.n = n
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=1 << self.levels))])
        last = text[order - 1]
        # a run's first position is always sampled, so no walk ever crosses a separator
        kept = (order % sampled == 0) | (last == 0)
        self.sampled, self.positions = Bits(kept), order[kept]
        self.bits, self.zeros = [], []
        for level in range(self.levels - 1, -1, -1):
            one = (last >> level & 1).astype(bool)
            self.bits.append(Bits(one))
            self.zeros.append(int(n - one.sum()))
            last = np.concatenate([last[~one], last[one]])

    @staticmethod
    def _suffixes(text: np.ndarray) -> np.ndarray:
        """The suffix array by prefix doubling; every separator differs from all others."""
        n, gaps = len(text), text == 0
        rank = np.where(gaps, np.cumsum(gaps) - 1, text + int(gaps.sum()))
        step = 1
        while True:
            after = np.zeros(n, dtype=np.int64)
            after[:n - step] = rank[step:] + 1
            key = rank * (max(n, int(rank.max())) + 2) + np.where(gaps, 0, after)
            order = np.argsort(key, kind="stable")
            new = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
            rank = np.empty(n, dtype=np.int64)
            rank[order] = new
            if new[-1] == n - 1 or step >= n:
                return order
            step *= 2

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, (bits, zeros) in enumerate(zip(self.bits, self.zeros)):
            ones = bits.rank(at)
            at = np.where(symbol >> (self.levels - 1 - level) & 1, zeros + ones, at - ones)
        return at

    def occurrences_before(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place of the transform."""
        return self._down(symbol, at) - self._down(symbol, np.zeros_like(at))

    def search(self, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of ``codes`` that occur, and the suffix interval [low, high) of each."""
        who = np.flatnonzero((codes.max(axis=1, initial=0) < len(self.first) - 1) & (lengths > 0))
        low, high = np.zeros(len(who), dtype=np.int64), np.full(len(who), self.n, dtype=np.int64)
        done = [np.empty(0, dtype=np.int64)] * 3
        for step in range(codes.shape[1]):
            ended = lengths[who] <= step
            done = [np.concatenate([d, x[ended]]) for d, x in zip(done, (who, low, high))]
            who, low, high = who[~ended], low[~ended], high[~ended]
            symbol = codes[who, codes.shape[1] - 1 - step]
            low = self.first[symbol] + self.occurrences_before(symbol, low)
            high = self.first[symbol] + self.occurrences_before(symbol, high)
            there = high > low
            who, low, high = who[there], low[there], high[there]
        return tuple(np.concatenate([d, x]) for d, x in zip(done, (who, low, high)))

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffixes, by walking back to sampled ones."""
        out, left, steps = np.empty(len(rows), dtype=np.int64), np.arange(len(rows)), 0
        at = rows.copy()
        while len(left):
            here = self.sampled.get(at).astype(bool)
            out[left[here]] = self.positions[self.sampled.rank(at[here])] + steps
            left, at = left[~here], at[~here]
            symbol, place = np.zeros(len(at), dtype=np.int64), at
            for bits, zeros in zip(self.bits, self.zeros):
                one, ones = bits.get(place).astype(bool), bits.rank(place)
                place, symbol = np.where(one, zeros + ones, place - ones), symbol << 1 | one
            at = self.first[symbol] + place - self._down(symbol, np.zeros_like(place))
            steps += 1
        return out


def _runs(ids: np.ndarray, starts: np.ndarray, phrases: Phrases) -> np.ndarray:
    """Which words of a batch belong to a run that may hold a window."""
    n = len(ids)
    joined = np.zeros(n + 1, dtype=bool)  # joined[i]: words i - 1 and i stand side by side in an item
    both = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0)) + 1
    code = ids[both - 1] << 32 | ids[both]
    found = np.searchsorted(phrases.pairs, code)
    joined[both] = phrases.pairs[np.minimum(found, len(phrases.pairs) - 1)] == code if len(phrases.pairs) else False
    joined[starts] = False
    joined[0] = False
    edge = np.flatnonzero(~joined)  # run boundaries, 0 and n among them
    long = np.diff(edge) >= phrases.lengths.min()
    return np.repeat(long, np.diff(edge)) & (ids > 0)


def hits(texts: list[bytes | None], phrases: Phrases) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[set[str]]]:
    """For each text: number of words, merged spans [from, to) of hit words, ids of the items found."""
    split = [words(t) for t in texts]
    counts = np.fromiter(map(len, split), np.int64, len(split))
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    items: list[set[str]] = [set() for _ in texts]
    if not len(phrases.lengths) or not counts.sum():
        return counts, spans, items
    starts = np.concatenate([[0], np.cumsum(counts)])
    ids = np.empty(starts[-1], dtype=np.int64)
    for a, b, w in zip(starts, starts[1:], split):
        ids[a:b] = np.fromiter(map(phrases.vocabulary.get, w, repeat(0)), np.int64, b - a)
    del split
    kept = _runs(ids, starts[:-1], phrases)
    place = np.flatnonzero(kept)
    if not len(place):
        return counts, spans, items
    # runs one after another, a separator wherever the next kept word isn't the next word of the same text
    owner = np.searchsorted(starts, place, side="right") - 1
    breaks = np.flatnonzero((np.diff(place) > 1) | (np.diff(owner) > 0)) + 1
    sequence = np.insert(ids[place], breaks, 0)
    where = np.insert(place, breaks, -1)
    index = FMIndex(sequence)
    who, low, high = index.search(phrases.codes, phrases.lengths)
    times = high - low
    if not times.sum():
        return counts, spans, items
    rows = np.repeat(low, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    phrase = np.repeat(who, times)
    begin = where[index.locate(rows)]
    cover = np.zeros(starts[-1] + 1, dtype=np.int64)
    np.add.at(cover, begin, 1)
    np.add.at(cover, begin + phrases.lengths[phrase], -1)
    hit = np.concatenate([[False], np.cumsum(cover[:-1]) > 0, [False]])
    text = np.searchsorted(starts, begin, side="right") - 1
    for t, p in set(zip(text.tolist(), phrase.tolist())):
        items[t].update(phrases.items[p])
    for t in set(text.tolist()):
        part = np.concatenate([[False], hit[starts[t] + 1:starts[t + 1] + 1], [False]])
        turn = np.flatnonzero(part[1:] != part[:-1])
        spans[t] = list(zip(turn[::2].tolist(), turn[1::2].tolist()))
    return counts, spans, items


def merged(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted([*a, *b]):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _pieces(texts: list[bytes | None], most: int = BATCH_BYTES) -> Iterator[slice]:
    """Slices of a batch of about ``most`` bytes, one text at least."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t or b"") > most:
            yield slice(start, i)
            start, size = i, 0
        size += len(t or b"")
    if start < len(texts):
        yield slice(start, len(texts))


def text_of(b: pa.RecordBatch) -> pa.Array:
    """The texts of a batch: a column of their own, or inside the caller's whole rows (``_row``), which then hold them once."""
    return b.column("_text") if "_text" in b.schema.names else pc.struct_field(b.column("_row"), "text")


def _pass(phrases):
    """One pass over the texts: adds what one slice of the benchmark hits to what earlier passes found."""
    span_type = pa.list_(pa.struct([("from_word", pa.int64()), ("to_word", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = phrases.value
        for b in batches:
            texts = text_of(b).cast(pa.binary()).to_pylist()
            old_spans, old_items = b.column("spans").to_pylist(), b.column("items").to_pylist()
            counts, spans, items = [], [], []
            for part in _pieces(texts):
                for out, found in zip((counts, spans, items), hits(texts[part], p)):
                    out.extend(found)
            spans = [[{"from_word": x, "to_word": y} for x, y in merged(new, [(o["from_word"], o["to_word"]) for o in old or ()])]
                     for new, old in zip(spans, old_spans)]
            items = [sorted(new | set(old or ())) for new, old in zip(items, old_items)]
            new = {"n_words": pa.array(counts, pa.int64()), "spans": pa.array(spans, span_type), "items": pa.array(items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([new.get(c, b.column(i)) for i, c in enumerate(b.schema.names)], names=b.schema.names)
    return run


def removal_spans(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, window: int = WINDOW) -> DataFrame:
    """The kept columns with n_words, spans (merged, from_word to to_word) and items (ids as text, sorted)."""
    keep = [c for c in (keep or docs.columns) if c not in ("n_words", "spans", "items", "_text")]
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("text")).where("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(1, -(-size // SLICE_BYTES))
    text = [] if keep == ["_row"] else [F.col("text").alias("_text")]
    out = docs.select(*keep, *text, F.lit(0).cast("long").alias("n_words"),
                      F.expr("CAST(NULL AS array<struct<from_word: bigint, to_word: bigint>>)").alias("spans"),
                      F.expr("CAST(NULL AS array<string>)").alias("items"))
    types = out.schema
    for i in range(slices):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == i).collect()
        phrases = spark.sparkContext.broadcast(Phrases.of([(r.item_id, bytes(r.text)) for r in rows], window))
        out = out.mapInArrow(_pass(phrases), types)
    return out.drop("_text")


def judged(found: DataFrame) -> DataFrame:
    """Add n_hit and contaminated: at least a twentieth of the words is hit."""
    n_hit = F.expr("aggregate(spans, 0L, (a, s) -> a + s.to_word - s.from_word)")
    return found.withColumn("n_hit", n_hit).withColumn("contaminated", F.expr("n_hit > 0 AND 20 * n_hit >= n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the contaminated ones, all columns unchanged."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    found = judged(removal_spans(docs.select(row), benchmark, ["_row"]))
    return found.where("NOT contaminated").select("_row.*")


WORDS_SQL = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


@query("op5_decontamination", f"""
WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
b AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark),
s AS (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 11))) AS p FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, array_to_string(w[p:p + 12], ' ') AS g, least(13, len(w)) AS n FROM s),
sizes AS (SELECT DISTINCT n FROM win),
t AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes WHERE len(w) >= n),
hits AS (SELECT t.doc_id, t.p, t.n, win.item_id FROM t JOIN win ON win.n = t.n AND array_to_string(t.w[t.p:t.p + t.n - 1], ' ') = win.g),
words AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS pos FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""")
def op5_decontamination(spark, sf_dir: str) -> DataFrame:
    found = judged(removal_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"]))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
