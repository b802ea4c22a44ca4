"""Phrase collocations counted with broadcast double-array tries.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends, and pieces into words.
A phrase is 2 to ``LONGEST`` words in a row inside a piece; everything is counted by language.

1. Words are counted; those that stand ``LEAST`` times become numbers, all else a gap (0).
   Gaps in a row are one, so the corpus shrinks to stretches of frequent words, written once.
2. Level k = 2, 3, ...: a phrase can be frequent only if its first and its last k - 1 words are.  Places
   where that holds (all adjacent words at level 2) are safe.  Candidates are the distinct phrases at safe places
   whose hash bucket is full enough; bucket counts travel as packed blocks, one for each part of the
   buckets, are summed part by part, and the full buckets reach the tasks as a bitmap (16 MB at most; one that is too small lets more candidates through,
   never fewer).
3. Candidates are dealt into blocks of some ``CANDIDATES``.  Each block becomes a double-array trie that is
   broadcast: from state s the word c leads to cell base[s] + c if check there is s.  Tasks advance the states
   of all safe places by one word at a time, count the accepting states, and Spark sums the
   tasks' counts.  Another pass marks where frequent phrases start, which gives the safe places of level k + 1.
4. A phrase's score is the least, over its cuts into two parts, of 1000 a n / (l r) rounded down
   (a, l, r: counts of phrase and parts, n: words of the language), computed in decimals.
   Phrases that a longer one with the same count contains are dropped.  (A longer phrase stands no more
   often, and any phrase between the two as often, so phrases one word longer decide.)

What the driver and every task hold is bounded by a block, the bitmap and ``WORDS`` dictionary entries;
more words or candidates mean more passes over the numbered corpus.

Defined results: a null text has no words; a null language is ``und``; rows without an id count; repeated
rows count each time; an empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotwise.llm.base import landed, query, small_batches, table
from lotwise.llm.substrings import _bitmap, _has

LONGEST, LEAST, TOP = 5, 100, 2000
WORDS, CANDIDATES = 1 << 20, 1 << 19
MOST_BITS = 1 << 27
BLOB, BLOBS = 1 << 18, 16  # numbers in a row of the corpus, rows a task is handed at a time
COUNTED = 1 << 22  # places a task counts at a time
HELD = 1 << 17  # distinct words or phrases a task holds before it hands them on
BREAKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", b"\n" * 10)


def _clean(text: pa.Scalar) -> bytes:
    return (text.cast(pa.binary()).as_py() or b"").lower().translate(BREAKS)


# --- words and numbers

def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) -> lang, word, f, already summed over much of the task."""
    def rows(held: dict[str, Counter]) -> pa.RecordBatch:
        langs = [lang for lang, c in held.items() for _ in range(len(c))]
        words = pa.array([w for c in held.values() for w in c], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), words, pa.array([n for c in held.values() for n in c.values()], pa.int64())], names=["lang", "word", "f"])

    held: dict[str, Counter] = {}
    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text")):
            held.setdefault(lang, Counter()).update(_clean(text).split())
            if sum(map(len, held.values())) > HELD:
                yield rows(held)
                held = {}
    if held:
        yield rows(held)


def _squeezed(numbers: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the kept numbers with one gap after each stretch, and whether a place is kept."""
    edge = np.append(keep[1:] < keep[:-1], False)
    at = np.flatnonzero(keep | np.concatenate([[False], edge[:-1]]))
    return at, keep[at]


def _numbered(dictionary, last: bool):
    """(lang, text, numbers) -> the same with the numbers of the dictionary's words filled in; at last blobs of safe stretches."""
    def fill(b: pa.RecordBatch) -> Iterator[np.ndarray]:
        for lang, text, old in zip(b.column("lang").to_pylist(), b.column("text"), b.column("numbers").to_pylist()):
            known, out = dictionary.value.get(lang, {}), []
            for piece in _clean(text).split(b"\n"):
                out.extend([known.get(w, 0) for w in piece.split()])
                out.append(0)
            new = np.array(out, dtype=np.int32)
            yield new if old is None else np.maximum(new, np.frombuffer(old, np.int32))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("text"), pa.array([x.tobytes() for x in fill(b)], pa.binary())], names=["lang", "text", "numbers"])

    def blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for numbers in fill(b):
                held.append(numbers)
                size += len(numbers)
                if size >= BLOB:
                    yield from _blobs(np.concatenate(held))
                    held, size = [], 0
        if held:
            yield from _blobs(np.concatenate(held))
    return blobs if last else rows


def _blobs(numbers: np.ndarray) -> Iterator[pa.RecordBatch]:
    pairs = (numbers[1:] > 0) & (numbers[:-1] > 0)
    first = np.append(pairs, False)
    yield from _blob_rows(numbers, first, 2)


def _blob_rows(numbers: np.ndarray, first: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """numbers and the safe places, where phrases of k words may start -> words, safe, marks: only what safe phrases cover."""
    cover = np.zeros(len(numbers) + k, dtype=bool)
    for i in range(k):
        cover[i:i + len(first)] |= first
    at, kept = _squeezed(numbers, cover[:len(numbers)])
    words, safe = np.where(kept, numbers[at], 0).astype(np.int32), first[at] & kept
    if len(words):
        yield pa.RecordBatch.from_arrays([pa.array([words.tobytes()], pa.binary()), pa.array([safe.tobytes()], pa.binary()), pa.array([bytes(len(words))], pa.binary())],
                                         names=["words", "safe", "marks"])


BLOB_TYPE = "words binary, safe binary, marks binary"


def _read(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for words, safe, marks in zip(*(b.column(c).to_pylist() for c in ("words", "safe", "marks"))):
        yield np.frombuffer(words, np.int32), np.frombuffer(safe, bool), np.frombuffer(marks, bool)


# --- candidates

def _bucket_of(words: np.ndarray, at: np.ndarray, k: int, bits: int) -> np.ndarray:
    h = np.zeros(len(at), dtype=np.uint64)
    for i in range(k):
        h = (h ^ words[at + i].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h & np.uint64(bits - 1)).astype(np.int64)


def _planes(x: np.ndarray) -> bytes:
    """Numbers of 32 bits as their first bytes, then their second ones, ...: what is mostly small packs well."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _count_blocks(keys: np.ndarray, counts: np.ndarray, span: int) -> pa.RecordBatch:
    """Rising keys and their counts -> part, block: a packed block for every stretch of ``span`` keys."""
    there, first = np.unique(keys // span, return_index=True)
    blocks = []
    for part, own, n in zip(there.tolist(), np.split(keys, first[1:]), np.split(counts, first[1:])):
        blocks.append(zlib.compress(_planes(np.diff(own, prepend=part * span)) + _planes(n), 1))
    return pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(blocks, pa.binary())], names=["part", "block"])


def _block_sums(span: int, least: int):
    """Blocks, those of a part in one task -> key, f of the keys that reach ``least`` in all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for part, block in zip(b.column("part").to_pylist(), b.column("block")):
                planes = zlib.decompress(block.as_buffer())
                total = sums.setdefault(part, np.zeros(span, dtype=np.int64))
                total[np.cumsum(_numbers(planes[:len(planes) // 2]))] += _numbers(planes[len(planes) // 2:])
        for part, total in sums.items():
            key = np.flatnonzero(total >= least)
            yield pa.RecordBatch.from_arrays([pa.array(key + part * span), pa.array(total[key])], names=["key", "f"])
    return run


def _summed(counted: DataFrame, size: int, parts: int, least: int) -> DataFrame:
    """Blocks of counts of the keys 0 to size - 1 -> key, f of those that reach ``least``."""
    return counted.repartition(parts, "part").mapInArrow(_block_sums(_span(size, parts), least), "key long, f long")


def _span(size: int, parts: int) -> int:
    return -(-size // parts)


def _bucket_counts(k: int, bits: int, parts: int):
    """Blobs -> blocks of how often phrases at safe places fall into each bucket."""
    def blocks(held: list[np.ndarray]) -> pa.RecordBatch:
        return _count_blocks(*np.unique(np.concatenate(held), return_counts=True), _span(bits, parts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for words, safe, _ in _read(b):
                held.append(_bucket_of(words, np.flatnonzero(safe), k, bits))
                size += len(held[-1])
                if size > COUNTED:
                    yield blocks(held)
                    held, size = [], 0
        if size:
            yield blocks(held)
    return run


def _unique_rows(rows: np.ndarray) -> np.ndarray:
    """The distinct rows; pairs are compared as one number."""
    if rows.shape[1] == 2:
        return np.unique(np.ascontiguousarray(rows, dtype=np.int32).view(np.int64)).view(np.int32).reshape(-1, 2)
    return np.unique(rows, axis=0)


def _distinct(k: int, bits: int, full, parts: int):
    """Blobs -> part, windows: the distinct phrases at safe places with full buckets, a block of them for each part."""
    def blocks(held: list[np.ndarray]) -> pa.RecordBatch:
        rows = _unique_rows(np.concatenate(held))
        part = _bucket_of(rows.ravel(), np.arange(len(rows)) * k, k, 1 << 32) % parts
        order = np.argsort(part, kind="stable")
        there, first = np.unique(part[order], return_index=True)
        return pa.RecordBatch.from_arrays([pa.array(there), pa.array([x.tobytes() for x in np.split(rows[order], first[1:])], pa.binary())], names=["part", "windows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for b in batches:
            for words, safe, _ in _read(b):
                at = np.flatnonzero(safe)
                at = at[_has(full.value, _bucket_of(words, at, k, bits))]
                if len(at):
                    held.append(_unique_rows(words[at[:, None] + np.arange(k)]))
                    if sum(map(len, held)) > HELD:
                        held = [_unique_rows(np.concatenate(held))]
                    if len(held[0]) > HELD:
                        yield blocks(held)
                        held = []
        if held:
            yield blocks(held)
    return run


def _merged(k: int):
    """Blocks of windows -> w0, ..., one row for every distinct one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, fresh, size = np.zeros((0, k), np.int32), [], 0
        for b in batches:
            for block in b.column("windows"):
                fresh.append(np.frombuffer(block.as_buffer(), np.int32).reshape(-1, k))
                size += len(fresh[-1])
                if size > max(HELD, len(held)):
                    held, fresh, size = _unique_rows(np.concatenate([held, *fresh])), [], 0
        held = _unique_rows(np.concatenate([held, *fresh]))
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in held.T], names=[f"w{i}" for i in range(k)])
    return run


class DoubleArray:
    """A trie over phrases (rows of k numbers, sorted and distinct): base, check, and the row of each accepting state."""

    def __init__(self, phrases: np.ndarray):
        self.symbols = np.unique(phrases)  # the trie's own alphabet: 1 to len(symbols)
        self.depth = phrases.shape[1]
        self.check = np.full(len(self.symbols) + 2, -1, dtype=np.int64)
        self.base = np.zeros(len(self.check), dtype=np.int64)
        self.check[0] = 0  # the root
        rows = len(phrases)
        state = np.zeros(rows, dtype=np.int64)  # of each row's prefix so far
        fresh = np.arange(rows) == 0
        local = np.searchsorted(self.symbols, phrases) + 1
        for d in range(self.depth):
            parent_starts = np.flatnonzero(fresh) if d else np.zeros(1, dtype=np.int64)
            if d == 0:
                fresh = np.arange(rows) == 0
            fresh = fresh | np.concatenate([[True], phrases[1:, d] != phrases[:-1, d]])
            child = np.flatnonzero(fresh)
            first = np.searchsorted(child, parent_starts)
            sizes = np.diff(np.append(first, len(child)))
            cells = np.zeros(len(child), dtype=np.int64)
            self.low, most = 1, 1 << 31
            for g in sorted(np.flatnonzero(sizes > 1).tolist(), key=lambda g: -sizes[g]):
                if 2 * sizes[g] <= most:  # groups of about one size go on where the last was placed
                    self.low, most = 1, sizes[g]
                own = slice(first[g], first[g] + sizes[g])
                cells[own] = self._place(int(state[parent_starts[g]]), local[child[own], d], at_root=d == 0)
            singles = first[sizes == 1]
            if len(singles):
                cells[singles] = self._place_singles(state[child[singles]], local[child[singles], d])
            state = cells[np.cumsum(fresh) - 1]
        self.row = np.full(len(self.check), -1, dtype=np.int64)
        self.row[state] = np.arange(rows)
        self.base, self.check, self.row = (x.astype(np.int32) for x in (self.base, self.check, self.row))
        self.symbols = self.symbols.astype(np.int32)

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.check = np.append(self.check, np.full(more, -1, dtype=np.int64))
            self.base = np.append(self.base, np.zeros(more, dtype=np.int64))

    def _place(self, parent: int, symbols: np.ndarray, at_root: bool) -> np.ndarray:
        """Cells for the children of a state: the first offset at which all are free."""
        ahead, width = symbols - symbols[0], 32
        at = int(symbols[0]) if at_root else self.low
        while True:
            self._grow(at + width + int(ahead[-1]) + 1)
            starts = at + np.flatnonzero(self.check[at:at + width] < 0)
            free = (self.check[starts[:, None] + ahead] < 0).all(axis=1)
            if free.any():
                break
            at, width = at + width, min(2 * width, max(32, 65_536 // len(symbols)))
        self.low = int(starts[int(np.argmax(free))])
        cells = self.low + ahead
        self.base[parent], self.check[cells] = cells[0] - symbols[0], parent
        return cells

    def _place_singles(self, parents: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        self._grow(len(self.check) + len(parents))
        cells = np.flatnonzero(self.check < 0)[:len(parents)]
        self.base[parents], self.check[cells] = cells - symbols, parents
        return cells

    def accepted(self, words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the phrases that start at the given places: the places accepted and their rows."""
        local = np.searchsorted(self.symbols, words).astype(np.int32)
        local = np.where(self.symbols[np.minimum(local, len(self.symbols) - 1)] == words, local + 1, 0)
        state = np.zeros(len(at), dtype=np.int32)
        for d in range(self.depth):
            c = local[at + d]
            to = self.base[state] + c
            ok = (c > 0) & (to >= 0) & (to < len(self.check))
            ok[ok] = self.check[to[ok]] == state[ok]
            at, state = at[ok], to[ok]
        return at, self.row[state]


def _trie_counts(trie, rows: int, parts: int):
    """Blobs -> blocks of the accepting states' counts over the whole task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(rows, dtype=np.int64)
        for b in batches:
            for words, safe, _ in _read(b):
                total += np.bincount(trie.value.accepted(words, np.flatnonzero(safe))[1], minlength=rows)
        index = np.flatnonzero(total)
        if len(index):
            yield _count_blocks(index, total[index], _span(rows, parts))
    return run


def _marked(trie, frequent, last: bool):
    """Blobs with marks where frequent phrases of this block start; at last the blobs of the next level."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for words, safe, marks in _read(b):
                at, row = trie.value.accepted(words, np.flatnonzero(safe))
                marks = marks.copy()
                marks[at[frequent.value[row]]] = True
                if last:
                    yield from _blob_rows(words, marks & np.append(marks[1:], False), trie.value.depth + 1)
                else:
                    yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (words, safe, marks)], names=["words", "safe", "marks"])
    return run


def _blocks(df: DataFrame, columns: list[str], most: int) -> list[DataFrame]:
    """The rows in parts of about ``most`` by a hash of the columns."""
    n = max(1, math.ceil(df.count() / most))
    return [df.where(F.pmod(F.xxhash64(*columns), F.lit(n)) == i) for i in range(n)]


def _level(corpus: DataFrame, k: int, bits: int, least: int, mark: bool) -> tuple[list[DataFrame], DataFrame]:
    """The frequent phrases of k words (p, f) in parts, and the corpus of the next level."""
    spark = corpus.sparkSession
    columns, parts = [f"w{i}" for i in range(k)], int(spark.conf.get("spark.sql.shuffle.partitions"))
    with small_batches(spark, BLOBS):
        full = _summed(corpus.mapInArrow(_bucket_counts(k, bits, parts), "part int, block binary"), bits, parts, least)
        full = spark.sparkContext.broadcast(_bitmap(full.select("key"), bits))
        windows = corpus.mapInArrow(_distinct(k, bits, full, parts), "part long, windows binary").repartition(parts, "part")
        candidates = landed(windows.mapInArrow(_merged(k), ", ".join(f"{c} int" for c in columns)), "candidates")
    found = []
    blocks = _blocks(candidates, columns, CANDIDATES)
    for i, block in enumerate(blocks):
        rows = block.toArrow()
        if rows.num_rows:
            phrases = np.stack([rows.column(c).to_numpy() for c in columns], axis=1)
            phrases = phrases[np.lexsort(phrases.T[::-1])]
            trie = spark.sparkContext.broadcast(DoubleArray(phrases))
            with small_batches(spark, BLOBS):
                counted = corpus.mapInArrow(_trie_counts(trie, len(phrases), parts), "part int, block binary")
                counts = landed(_summed(counted, len(phrases), parts, least), "counts")
            counts = counts.toArrow()
            index, f = counts.column("key").to_numpy(), counts.column("f")
            if len(index):
                found.append(landed(spark.createDataFrame(pa.table({"p": pa.array(list(phrases[index]), pa.list_(pa.int32())), "f": f})), "phrases"))
            frequent = np.zeros(len(phrases), dtype=bool)
            frequent[index] = True
        elif i == len(blocks) - 1 and mark:
            trie, frequent = spark.sparkContext.broadcast(DoubleArray(np.full((1, k), -1, dtype=np.int32))), np.zeros(1, dtype=bool)
        else:
            continue
        if mark:
            with small_batches(spark, BLOBS):
                corpus = landed(corpus.mapInArrow(_marked(trie, spark.sparkContext.broadcast(frequent), i == len(blocks) - 1), BLOB_TYPE), "marked")
    return found, corpus


def _dictionary(docs: DataFrame, words: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(number, lang, word, f) of the frequent words, and the numbered corpus."""
    spark = docs.sparkSession
    corpus = docs.withColumn("numbers", F.lit(None).cast("binary"))
    blocks = _blocks(words.where(F.col("f") >= least), ["lang", "word"], WORDS)
    named, before = [], 0
    for i, block in enumerate(blocks):
        rows = block.toArrow()
        numbers = np.arange(before + 1, before + 1 + rows.num_rows, dtype=np.int32)
        before += rows.num_rows
        if rows.num_rows:
            named.append(landed(spark.createDataFrame(rows.append_column("number", pa.array(numbers))), "dictionary"))
        known: dict[str, dict[bytes, int]] = {}
        for lang, word, number in zip(rows.column("lang").to_pylist(), rows.column("word").cast(pa.binary()).to_pylist(), numbers.tolist()):
            known.setdefault(lang, {})[word] = number
        last = i == len(blocks) - 1
        corpus = landed(corpus.mapInArrow(_numbered(spark.sparkContext.broadcast(known), last), BLOB_TYPE if last else "lang string, text string, numbers binary"), "corpus")
    return _union(named, spark, "lang string, word string, f long, number int"), corpus


def _union(parts: list[DataFrame], spark, schema: str) -> DataFrame:
    out = parts[0] if parts else spark.createDataFrame([], schema)
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def scored(counts: DataFrame) -> DataFrame:
    """a, l, r, n -> the same and ``score``, exact for up to 10**15 words."""
    whole = lambda c, digits: F.col(c).cast(f"decimal({digits},0)")
    above, under = F.lit(1000).cast("decimal(4,0)") * whole("a", 17) * whole("n", 15), whole("l", 18) * whole("r", 18)
    return counts.withColumn("_above", above).withColumn("_under", under).withColumn("score", F.expr("_above div _under")).drop("_above", "_under")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """docs (lang, text) -> lang, phrase, a, l, r, n, score: every frequent phrase that no longer one replaces."""
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    with small_batches(docs.sparkSession):
        words = landed(docs.mapInArrow(_word_counts, "lang string, word string, f long").groupBy("lang", "word").agg(F.sum("f").alias("f")), "words")
        dictionary, corpus = _dictionary(docs, words, least)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    bits = 1 << min(max((words.agg(F.sum("f")).first()[0] or 1) // 8, 1 << 16).bit_length(), MOST_BITS.bit_length() - 1)
    found = []
    for k in range(2, longest + 1):
        parts, corpus = _level(corpus, k, bits, least, mark=k < longest)
        found += parts
    phrases = _union(found, docs.sparkSession, "p array<int>, f long")
    known = dictionary.select(F.array("number").alias("p"), "f").unionByName(phrases)

    longer = phrases.where("size(p) > 2").select(F.explode(F.expr("array(slice(p, 1, size(p) - 1), slice(p, 2, size(p) - 1))")).alias("p"), "f")
    kept = phrases.join(longer, ["p", "f"], "left_anti")
    cuts = kept.select("p", F.col("f").alias("a"), F.explode(F.expr("sequence(1, size(p) - 1)")).alias("k"))
    parts = (cuts.withColumn("left", F.expr("slice(p, 1, k)")).withColumn("right", F.expr("slice(p, k + 1, size(p) - k)"))
             .join(known.select(F.col("p").alias("left"), F.col("f").alias("l")), "left").join(known.select(F.col("p").alias("right"), F.col("f").alias("r")), "right"))
    langs = parts.join(dictionary.select(F.col("number"), "lang"), F.col("p")[0] == F.col("number")).join(totals, "lang")
    best = scored(langs).groupBy("p").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"), F.first("a").alias("a"), F.first("n").alias("n"), F.first("lang").alias("lang"))
    spelled = (kept.select("p", F.posexplode("p").alias("at", "number")).join(dictionary.select("number", "word"), "number")
               .groupBy("p").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase")))
    return best.join(spelled, "p").select("lang", "phrase", "a", "b.l", "b.r", "n", F.col("b.score").alias("score"))


def strongest(found: DataFrame, top: int = TOP) -> DataFrame:
    """The first of every language by score, count and spelling, with their rank."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).withColumn("rank", F.col("rank").cast("long"))


@query("op11_phrases", r"""
WITH t AS (SELECT doc_id, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM t)),
grams AS (SELECT lang, unnest(flatten([list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1]) FOR k IN [1, 2, 3, 4, 5]])) AS p FROM pieces),
f AS MATERIALIZED (SELECT lang, p, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
n AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang),
longer AS (SELECT DISTINCT lang, unnest([p[1:len(p) - 1], p[2:len(p)]]) AS p, f FROM f WHERE len(p) > 2),
c AS (SELECT lang, p, f AS a FROM f WHERE len(p) > 1 AND NOT EXISTS (SELECT 1 FROM longer WHERE longer.lang = f.lang AND longer.p = f.p AND longer.f = f.f)),
cuts AS (SELECT lang, p, a, unnest(range(1, len(p))) AS k FROM c),
s AS (SELECT cuts.lang, cuts.p, a, k, x.f AS l, y.f AS r, n, CAST(1000::HUGEINT * a * n // (x.f::HUGEINT * y.f) AS BIGINT) AS score
      FROM cuts JOIN n USING (lang) JOIN f x ON x.lang = cuts.lang AND x.p = cuts.p[1:k] JOIN f y ON y.lang = cuts.lang AND y.p = cuts.p[k + 1:len(cuts.p)]),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank, array_to_string(p, ' ') AS phrase,
  a, l, r, CAST(n AS BIGINT) AS n, score
FROM b QUALIFY rank <= 2000""")
def op11_phrases(spark, sf_dir: str) -> DataFrame:
    return strongest(collocations(table(spark, sf_dir, "documents"))).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
