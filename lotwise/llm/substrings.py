"""Substring dedup by seed and extend.

A repeat is a run of at least ``WINDOW`` words that also stands in a document with a smaller
id; every window of that length inside it does too.  The steps:

1. Seeds.  Words are hashed, every run of ``SEED`` words gets a hash, and of any
   ``WINDOW - SEED + 1`` consecutive ones the smallest is an anchor (winnowing).  A window's
   anchor depends on its words alone, so documents that share a window share an anchor.
2. Join.  Anchors are grouped over all documents; those that two different texts or more hold
   are shared.  They reach the tasks as a bitmap of ``SEED_BITS`` bits (16 MB, whatever the
   input): a bit set by chance only lets some more windows into the next step.
3. Extension.  Each shared anchor is extended both ways over all windows that hold it; the
   windows, named by 96 bits of two hashes, meet by an aggregate that keeps the smallest id.
4. Maximal repeats.  Windows of a document that started in a smaller one are merged into
   maximal spans, which are removed.

Nothing is compared pairwise: a passage in a third of all documents costs one row per
document and window, combined before the shuffle.  Exact copies are settled by two hashes of
the text: only the smallest id of a text takes part in step 3, its copies lose every word (if
they have a window at all).  Texts move only for copies and for documents that lose words; a
second bitmap (``TEXT_BITS``) tells which, and one that is full only moves more of them.  With far
more shared anchors than bits nearly all windows take part: the result is the same, at the
cost of shuffling a row per word.

Defined results: a null text has no words; a document without an id neither loses words nor
makes others lose them; rows of one id don't affect each other; repeated rows give the same
result each; an empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.base import landed, query, small_batches, table

WINDOW, SEED = 13, 5
SEED_BITS, TEXT_BITS = 1 << 27, 1 << 24
BUCKET = 1 << 15  # bits per row of Spark's bitmap aggregate
BLOCK = 1 << 16  # bytes hashed at a time
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd; any would do
BLANK = np.zeros(256, dtype=bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number modulo 2**64, and of its inverse."""
    base = 0x9E3779B97F4A7C15
    out = []
    for x in (base, pow(base, -1, 1 << 64)):
        p = np.full(n, np.uint64(x))
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return tuple(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, one after the other, and each text's number of words.

    A word's hash is a polynomial of its bytes, read off running sums over a block.
    """
    whole = np.frombuffer(b" ".join(t or b"" for t in texts) + b" ", dtype=np.uint8)
    blank = BLANK[whole]
    blanks = np.flatnonzero(blank)
    starts, hashes, at = [], [], 0
    while at < len(whole):  # blocks that end after a blank
        end = int(blanks[min(np.searchsorted(blanks, at + BLOCK), len(blanks) - 1)]) + 1
        turn = np.flatnonzero(blank[at + 1:end] != blank[at:end - 1]) + 1
        if not blank[at]:
            turn = np.concatenate([[0], turn])
        begin, after = turn[::2], turn[1::2]
        powers, inverse = _powers(1 << max(10, (end - at).bit_length()))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((whole[at:end].astype(np.uint64) + np.uint64(1)) * powers[:end - at], dtype=np.uint64)])
        hashes.append(_mixed((sums[after] - sums[begin[:len(after)]]) * inverse[begin[:len(after)]]))
        starts.append(begin[:len(after)] + at)
        at = end
    starts, hashes = np.concatenate(starts), np.concatenate(hashes)
    edges = np.cumsum([0] + [len(t or b"") + 1 for t in texts])
    return hashes, np.diff(np.searchsorted(starts, edges))


def _grams(hashes: np.ndarray, n: int, multiplier: int) -> np.ndarray:
    """A 64-bit hash of every run of n words, mixed so that its order is random."""
    count = max(len(hashes) - n + 1, 0)
    out = np.zeros(count, dtype=np.uint64)
    for i in range(n if count else 0):
        out = out * np.uint64(multiplier) + hashes[i:i + count]
    return _mixed(out)


def _anchors(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all seeds, and positions of the anchors: the leftmost smallest seed of every window inside one text."""
    seeds, width = _grams(hashes, SEED, MULTIPLIERS[0]), WINDOW - SEED + 1
    n = len(seeds) - width + 1
    if n <= 0:
        return seeds, np.empty(0, dtype=np.int64)
    least, offset = seeds[:n].copy(), np.zeros(n, dtype=np.int64)
    for i in range(1, width):
        less = seeds[i:i + n] < least
        least[less] = seeds[i:i + n][less]
        offset[less] = i
    left = np.repeat(np.cumsum(counts), counts)[:n] - np.arange(n)  # words from a start to the end of its text
    at = (offset + np.arange(n))[left >= WINDOW]
    return seeds, at[np.concatenate([[True], at[1:] != at[:-1]])] if len(at) else at


def _slices(column: pa.Array, most: int = 4 * BLOCK) -> Iterator[tuple[slice, list[bytes | None]]]:
    """The texts of a column, about ``most`` bytes at a time and one text at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy().astype(np.int64))
    start = 0
    while start < len(column):
        stop = max(start + 1, int(np.searchsorted(ends, most + (ends[start - 1] if start else 0), side="right")))
        yield slice(start, stop), column.slice(start, stop - start).cast(pa.binary()).to_pylist()
        start = stop


def _seed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text_key, text) -> (seed, text_key)."""
    for b in batches:
        keys = b.column(0).to_numpy()
        for part, texts in _slices(b.column(1)):
            hashes, counts = word_hashes(texts)
            seeds, at = _anchors(hashes, counts)
            yield pa.RecordBatch.from_arrays([pa.array(seeds[at].view(np.int64)), pa.array(np.repeat(keys[part], counts)[at])], names=["seed", "text_key"])


def _has(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values & (len(bitmap) * 8 - 1)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _bitmap(values: DataFrame, bits: int) -> np.ndarray:
    """One column of longs -> a bitmap of their lowest bits, built in Spark; ``bits`` / 8 bytes reach the driver."""
    at = F.col(values.columns[0]).bitwiseAND(F.lit(bits - 1)) + 1
    out = np.zeros(bits // 8, dtype=np.uint8).reshape(-1, BUCKET // 8)
    rows = values.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("part"))
    for r in rows.toArrow().to_pylist():
        out[r["bucket"] - 1] = np.frombuffer(r["part"], dtype=np.uint8)
    return out.ravel()


def _window_rows(shared):
    """(doc_id, text_key, text) -> (w1, w2, doc_id, text_key, start): the windows around shared anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, keys = b.column("doc_id").to_numpy(), b.column("text_key").to_numpy()
            for part, texts in _slices(b.column("text")):
                hashes, counts = word_hashes(texts)
                grams, at = _anchors(hashes, counts)
                at = at[_has(shared.value, grams[at].view(np.int64))]
                text = np.repeat(np.arange(len(counts)), counts)
                first = np.cumsum(counts) - counts
                last = (first + counts - WINDOW)[text[at]]
                cover = np.zeros(len(hashes) + 1, dtype=np.int64)
                np.add.at(cover, np.maximum(at - (WINDOW - SEED), first[text[at]]), 1)
                np.add.at(cover, np.minimum(at, last) + 1, -1)
                start = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
                one, two = (_grams(hashes, WINDOW, m)[start].view(np.int64) for m in MULTIPLIERS)
                own = text[start]
                yield pa.RecordBatch.from_arrays([pa.array(one), pa.array((two >> 32).astype(np.int32)), pa.array(ids[part][own]), pa.array(keys[part][own]),
                                                  pa.array((start - first[own]).astype(np.int32))], names=["w1", "w2", "doc_id", "text_key", "start"])
    return run


def spans_of(starts: np.ndarray, window: int = WINDOW) -> list[tuple[int, int]]:
    """Maximal spans covered by windows that begin at the sorted starts."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > window) + 1
    begin, end = np.concatenate([[0], cut]), np.concatenate([cut, [len(starts)]]) - 1
    return [(int(starts[a]), int(starts[z]) + window) for a, z in zip(begin, end)]


def _chunks(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, so that a task holds little beside the one it was given."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def _in_bitmap(bitmap, inside: bool, then=None):
    """The rows (doc_id, text_key, ...) whose text_key is in the bitmap, or the others; handed on to ``then`` in the same task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _chunks(batches):
            chosen = _has(bitmap.value, b.column("text_key").to_numpy())
            yield b.filter(pa.array(chosen if inside else ~chosen))
    return run if then is None else lambda batches: then(run(batches))


SPANS = pa.list_(pa.struct([("from_word", pa.int64()), ("to_word", pa.int64())]))
RESULT = "doc_id long, n_words long, spans array<struct<from_word: bigint, to_word: bigint>>, kept string"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, copy, starts) -> the result row: words outside the maximal spans are kept; all without the last two columns."""
    for b in _chunks(batches):
        ids, texts = b.column("doc_id"), b.column("text").cast(pa.binary()).to_pylist()
        judged = "copy" in b.schema.names
        copies = b.column("copy").to_pylist() if judged else [False] * len(texts)
        starts = b.column("starts") if judged else pa.nulls(len(texts))
        counts, spans, kept = [], [], []
        for i, (t, copy) in enumerate(zip(texts, copies)):
            words = (t or b"").split()
            if copy:
                own = [(0, len(words))] if len(words) >= WINDOW else []
            else:
                own = spans_of(np.sort(starts[i].values.to_numpy(zero_copy_only=False))) if starts[i].is_valid else []
            counts.append(len(words))
            for a, z in reversed(own):
                del words[a:z]
            spans.append([{"from_word": a, "to_word": z} for a, z in own])
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays([ids, pa.array(counts, pa.int64()), pa.array(spans, SPANS), pa.array(kept, pa.binary()).cast(pa.string())],
                                         names=["doc_id", "n_words", "spans", "kept"])


def deduplicate(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_words, spans (removed, from_word to to_word), kept (the words left, blank-joined)."""
    broadcast = docs.sparkSession.sparkContext.broadcast
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"),
                       F.xxhash64(F.lit(1), "text").alias("second_key"), "text")
    types = "doc_id long, text_key long, second_key long, text string"
    named = docs.where("doc_id IS NOT NULL")
    copied = landed(named.groupBy("text_key", "second_key").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "copied")
    copies = broadcast(_bitmap(copied.select("text_key"), TEXT_BITS))
    smallest = (named.mapInArrow(_in_bitmap(copies, True), types).join(copied, ["text_key", "second_key"], "left")
                .where("doc_id = coalesce(first, doc_id)").select("doc_id", "text_key", "text"))

    seeds = named.select("text_key", "text").mapInArrow(_seed_rows, "seed long, text_key long")
    shared = seeds.groupBy("seed").agg(F.min("text_key").alias("lo"), F.max("text_key").alias("hi")).where("lo < hi").select("seed")
    with small_batches(docs.sparkSession):
        bitmap = _bitmap(shared, SEED_BITS)
    find, window = _window_rows(broadcast(bitmap)), "w1 long, w2 int, doc_id long, text_key long, start int"
    windows = (named.select("doc_id", "text_key", "text").mapInArrow(_in_bitmap(copies, False, find), window)
               .unionByName(smallest.mapInArrow(find, window)))
    least = windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n")
    with small_batches(docs.sparkSession):
        removed = landed(windows.join(least, ["w1", "w2"]).where("doc_id > least")
                         .groupBy("doc_id", "text_key").agg(F.collect_set("start").alias("starts")), "removed")

    losing = broadcast(_bitmap(removed.select("text_key").unionByName(copied.select("text_key")), TEXT_BITS))
    rest = docs.select("doc_id", "text_key", "text").mapInArrow(_in_bitmap(losing, False, _cut), RESULT)
    cut = (docs.mapInArrow(_in_bitmap(losing, True), types).join(copied, ["text_key", "second_key"], "left").join(removed, ["doc_id", "text_key"], "left")
           .select("doc_id", "text", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).alias("copy"), "starts"))
    return rest.unionByName(cut.mapInArrow(_cut, RESULT))


@query("op6_substrings", r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, p, array_to_string(w[p:p + 12], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM d)),
f AS (SELECT gram, min(doc_id) AS least FROM g GROUP BY gram),
r AS (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS at FROM g JOIN f USING (gram) WHERE doc_id > least),
x AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS at FROM d),
k AS (SELECT x.doc_id, count(r.at) AS n_removed, string_agg(word, ' ' ORDER BY x.at) FILTER (WHERE r.at IS NULL) AS kept
      FROM x LEFT JOIN r ON r.doc_id = x.doc_id AND r.at = x.at GROUP BY x.doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)""")
def op6_substrings(spark, sf_dir: str) -> DataFrame:
    found = deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", F.expr("aggregate(spans, 0L, (a, s) -> a + s.to_word - s.from_word)").alias("n_removed"),
                        F.sha2("kept", 256).alias("kept_sha256"))
