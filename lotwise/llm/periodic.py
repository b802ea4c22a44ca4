"""Periodic runs of words: stretches that repeat themselves four times or more.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), at
least ``max(LEAST, TIMES * q)`` words long, that no neighbouring word extends with that period.

Frequency splitting.  A run holds each of its words ``TIMES`` times at least.  So a word that stands
fewer times in a segment belongs to no run inside it and splits it; what is left is split
again by its own counts until every word of every segment is frequent in it.  When a piece is larger
than half of its segment, its counts are the segment's less those of the other pieces, so each
word is counted anew at most log2(n) times however deep the splitting goes.

Lag scan.  A stretch of period q and 4 q words holds three whole blocks in a row, cut at multiples
of q, that are equal.  For every lag the hashes of those aligned blocks (read off
running sums) are compared; three equal ones are extended word by word.  All lags of a segment of
m words cost about m log m.  Lags rise, and blocks inside a known run are passed over: a
stretch of period q there has that run's shorter period (Fine and Wilf).  So
each run is found once, at its smallest period.

Each document is judged in one task by its own words alone: nothing is shuffled, and a long text
costs its own words as numbers (8 bytes each).

Defined results: a null text has no words and no runs; rows without an id and repeated rows are
judged like any other; an empty table gives no rows; columns named ``n_words``, ``runs`` or ``collapsed`` are
replaced, all others stay as they are.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.base import query, table

TIMES, LEAST = 4, 6
PIECE = 1 << 20  # bytes of a text that are cut into words at a time
BLANK = re.compile(rb"[\x20\x09-\x0D]")


def words_of(text: bytes | None) -> tuple[list[int], list[bytes]]:
    """The words as numbers by first appearance, and the word of every number."""
    text, number = text or b"", defaultdict()
    number.default_factory = number.__len__
    codes, at = [], 0
    while at < len(text):
        gap = BLANK.search(text, at + PIECE)
        end = gap.end() if gap else len(text)
        codes.extend(map(number.__getitem__, text[at:end].split()))
        at = end
    return codes, list(number)


def segments(codes: list[int]) -> list[tuple[int, int]]:
    """The stretches left when every word that stands under ``TIMES`` times in its stretch has split it."""
    places: dict[int, list[int]] = {}

    def cuts(start: int, end: int, rare: list[int]) -> list[int]:
        if end - start == len(codes):
            few = set(rare)
            return [i for i, c in enumerate(codes) if c in few]
        if not places:
            for i, c in enumerate(codes):
                places.setdefault(c, []).append(i)
        found = []
        for c in rare:
            first = bisect_left(places[c], start)
            found += [i for i in places[c][first:first + TIMES] if i < end]
        return sorted(found)

    kept = []
    counts = Counter(codes)
    todo = [(0, len(codes), counts, list(counts))] if len(codes) >= LEAST else []
    while todo:
        start, end, counts, suspects = todo.pop()
        rare = [c for c in suspects if 0 < counts[c] < TIMES]
        if not rare:
            kept.append((start, end))
            continue
        edges = [start - 1, *cuts(start, end, rare), end]
        pieces = [(a + 1, z) for a, z in zip(edges, edges[1:]) if z - a > 1]
        if not pieces:
            continue
        largest = max(pieces, key=lambda p: p[1] - p[0])
        if 2 * (largest[1] - largest[0]) > end - start:
            changed = Counter(rare)
            for a, z in pieces:
                if (a, z) != largest:
                    changed.update(codes[a:z])
            for c in rare:
                changed.pop(c)
                del counts[c]
            for c, n in changed.items():
                if c in counts:
                    counts[c] -= n
            todo.append((*largest, counts, list(changed)))
            pieces.remove(largest)
        for a, z in pieces:
            if z - a >= LEAST:
                own = Counter(codes[a:z])
                todo.append((a, z, own, list(own)))
    return sorted(s for s in kept if s[1] - s[0] >= LEAST)


@cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64 and of its inverse, 2**bits of each."""
    out = []
    for x in (0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)):
        p = np.full(1 << bits, np.uint64(x))
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return tuple(out)


def _equal_ahead(w: np.ndarray, i: int, q: int) -> int:
    """How many words from i on equal the word q further."""
    done, step = 0, 64
    while True:
        a, b = w[i + done:i + done + step], w[i + q + done:i + q + done + step]
        a = a[:len(b)]
        differ = np.flatnonzero(a != b)
        if len(differ):
            return done + int(differ[0])
        done += len(b)
        if len(b) < step:
            return done
        step *= 2


def lag_scan(segment: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run inside the words, given as numbers."""
    n = len(segment)
    powers, inverse = _powers(max(10, n.bit_length()))
    mixed = (segment.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(29)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * powers[:n], dtype=np.uint64)])
    backwards = segment[::-1]
    covered = np.zeros(n, dtype=np.int64)  # end of the furthest run that holds the word
    runs = []
    for q in range(1, n // TIMES + 1):
        edge = sums[::q]
        blocks = (edge[1:] - edge[:-1]) * inverse[:n:q][:len(edge) - 1]
        same = blocks[1:] == blocks[:-1]
        hits = np.flatnonzero(same[1:] & same[:-1]) * q
        if not len(hits):
            continue
        done = 0
        for at in hits[covered[hits] < hits + 3 * q].tolist():
            if at < done or covered[at] >= at + 3 * q:
                continue
            ahead = _equal_ahead(segment, at, q)
            start = at - _equal_ahead(backwards, n - at - q, q) if at else 0
            done = at + ahead
            length = at + ahead + q - start
            if length >= max(LEAST, TIMES * q):
                runs.append((start, length, q))
                covered[start:start + length] = np.maximum(covered[start:start + length], start + length)
    return runs


def runs_of(codes: list[int]) -> list[tuple[int, int, int]]:
    """All runs, by start and then period."""
    found = []
    for start, end in segments(codes):
        part = np.fromiter(codes[start:end], dtype=np.int64, count=end - start)
        found += [(start + a, length, q) for a, length, q in lag_scan(part)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(codes: list[int], names: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside runs and each run's first period, joined by one blank."""
    keep = np.ones(len(codes), dtype=bool)
    for start, length, q in runs:
        keep[start + q:start + length] = False
    return b" ".join([names[codes[i]] for i in np.flatnonzero(keep).tolist()] if runs else map(names.__getitem__, codes))


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
NEW = {"n_words": "long", "runs": "array<struct<start: bigint, length: bigint, period: bigint>>", "collapsed": "string"}


def _found(change: Callable | None, text: str, row: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, runs, texts = [], [], []
            keys = b.column(row) if row else None
            for i, t in enumerate(b.column(text)):
                codes, names = words_of(t.cast(pa.binary()).as_py())
                if change:
                    codes = change(codes, keys[i].as_py())
                own = runs_of(codes)
                counts.append(len(codes))
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in own])
                texts.append(collapsed(codes, names, own))
            rest = [i for i, c in enumerate(b.schema.names) if c not in (text, *NEW)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in rest), pa.array(counts, pa.int64()), pa.array(runs, RUNS), pa.array(texts, pa.binary()).cast(pa.string())],
                                             names=[*(b.schema.names[i] for i in rest), *NEW])
    return run


def collapse(docs: DataFrame, text: str = "text", change: Callable | None = None, row: str | None = None) -> DataFrame:
    """docs without the text and with ``n_words``, ``runs`` (start, length, period) and ``collapsed`` (the text left).

    ``change`` may rewrite the words (a list of numbers) given the value of column ``row``, before they are judged.
    """
    docs = docs.drop(*(c for c in NEW if c != text))
    types = [f"`{c}` {t}" for c, t in docs.dtypes if c != text] + [f"{c} {t}" for c, t in NEW.items()]
    return docs.mapInArrow(_found(change, text, row), ", ".join(types))


def planted(codes: list[int], doc_id: int | None) -> list[int]:
    """The contract's rewriting: in a tenth of the documents the words from some place on repeat a stretch."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not codes:
        return codes
    g, n = h // 10, len(codes)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return codes[:a] + (codes[a:a + p] * ((n - a) // p + 1))[:n - a]


@query("op13_periodic_runs")
def op13_periodic_runs(spark, sf_dir: str) -> DataFrame:
    found = collapse(table(spark, sf_dir, "documents").select("doc_id", "text"), change=planted, row="doc_id")
    longest = F.expr("""aggregate(runs, CAST(NULL AS struct<start: bigint, length: bigint, period: bigint>),
        (m, r) -> CASE WHEN m IS NULL OR r.length > m.length THEN r ELSE m END)""")
    return found.withColumn("m", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "m.start", "m.length", "m.period",
        F.expr("(1000 * m.length) div m.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
